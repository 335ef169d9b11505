"""A toxicity classifier that is penalised for scores that hang on identity terms.

Features are a text's distinct words, and the first letters of its words with levels of how often
and how densely they occur, as a rare stem in a long text says little. Every labelled text is also seen with its identity terms swapped for another of their group; the difference of the two
scores is penalised, so that the weight of a term that merely names a group is shared by all
names of the group and driven towards what the label owes to none of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlark.llm.common import broadcast, written
from ledgerlark.llm.langid import text_slices

WORD = re.compile(r"[^\W\d_]+")
LEVEL = re.compile(r"[*%]")

# Names of groups whose mention alone is neutral; a term is swapped within its line.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("immigrants", "refugees", "natives"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)


@dataclass(frozen=True)
class Setup:
    """The classifier is fitted on at most ``sample`` labelled rows, those of the smallest id
    hash, with at most ``features`` features besides the identity terms."""

    sample: int = 20_000
    features: int = 512
    least: int = 3
    stem: int = 4
    longest: int = 32
    penalty: float = 1.0
    decay: float = 1e-5
    steps: int = 600
    rate: float = 1.0


# A stem's levels: it occurs this often, and this often in a hundred words.
COUNTS, SHARES = (1, 2, 4), (1, 3)


def levels(stem: str, n: int, size: int) -> list[str]:
    """The level features of a stem that occurs ``n`` times among ``size`` words."""
    often = [f"{stem}*{c}" for c in COUNTS if n >= c]
    return often + [f"{stem}%{c}" for c in SHARES if 100 * n >= c * size]


def features_of(words: Sequence[str], setup: Setup) -> set[str]:
    """Words as they are, stem levels with a mark that no word holds."""
    counted = Counter(words)
    found = {w for w in counted if len(w) <= setup.longest}
    for stem, n in stems_of(counted, setup.stem).items():
        found.update(levels(stem, n, len(words)))
    return found


def stems_of(counted: Counter[str], length: int, among: set[str] | None = None) -> Counter[str]:
    """How often each stem occurs, given how often each word does; only those ``among``, if given."""
    stems: Counter[str] = Counter()
    for word, n in counted.items():
        stem = word[:length]
        if len(word) >= length and (among is None or stem in among):
            stems[stem] += n
    return stems


def swaps(groups: Sequence[Sequence[str]]) -> dict[str, str]:
    """Each term to the next one of its group."""
    return {a: b for g in groups for a, b in zip(g, [*g[1:], g[0]])}


class Classifier:
    def __init__(self, features: list[str], weights: np.ndarray, bias: float, setup: Setup):
        self.place = {f: i for i, f in enumerate(features)}
        self.weights, self.bias, self.setup = weights, bias, setup
        self.words = {f for f in features if not LEVEL.search(f)}
        self.stems = {LEVEL.split(f)[0] for f in features if LEVEL.search(f)}

    def found(self, text: str | None) -> list[int]:
        """Places of the features in the text."""
        words = WORD.findall(text.lower()) if text else []
        counted = Counter(words)
        hit = counted.keys() & self.words
        for stem, n in stems_of(counted, self.setup.stem, self.stems).items():
            hit.update(f for f in levels(stem, n, len(words)) if f in self.place)
        return sorted(self.place[f] for f in hit)

    def score(self, text: str | None) -> float:
        margin = self.bias + float(self.weights[self.found(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def fit(x: np.ndarray, swapped: np.ndarray, y: np.ndarray, setup: Setup) -> tuple[np.ndarray, float]:
    """Logistic regression with ``penalty`` on the squared change of the margin under the swap."""
    n, m = x.shape
    w, rate = np.zeros(m), y.mean() if n else 0.0
    bias = float(np.log((rate * n + 0.5) / ((1 - rate) * n + 0.5)))
    moved = np.flatnonzero((x != swapped).any(axis=1))
    change = (x[moved] - swapped[moved]).astype(np.float64)
    grown, grown_bias = np.full(m, 1e-3), 1e-3
    for _ in range(setup.steps if n and 0 < rate < 1 else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -40, 40)))
        off = p - y
        slope = x.T @ off / n + setup.decay * w
        if len(moved):
            slope += setup.penalty * (change.T @ (change @ w)) / len(moved)
        slope_bias = off.mean()
        grown += slope * slope
        grown_bias += slope_bias * slope_bias
        w -= setup.rate * slope / np.sqrt(grown)
        bias -= 0.1 * setup.rate * slope_bias / np.sqrt(grown_bias)
    return w, bias


def learn(
    docs: DataFrame, labels: DataFrame, groups: Sequence[Sequence[str]] = IDENTITY_TERMS, setup: Setup = Setup()
) -> Classifier:
    """Fit on ``docs`` (id, text) with ``labels`` (id, toxic).

    Labels of an id are averaged and rounded. The sample is bounded, so it is broadcast to the
    scan of the texts, which are not shuffled; texts of the same features count once.
    """
    known = labels.filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.avg("toxic").alias("t"))
    sample = (
        known.select("id", (F.col("t") >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(setup.sample)
    )
    swap = swaps(groups)
    schema = "toxic int, features array<string>, swapped array<string>"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = [WORD.findall((t or "").lower()) for t in texts]
            own = [sorted(features_of(w, setup)) for w in found]
            other = [sorted(features_of([swap.get(x, x) for x in w], setup)) for w in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(own, pa.list_(pa.string())), pa.array(other, pa.list_(pa.string()))],
                names=["toxic", "features", "swapped"],
            )

    given = docs.join(F.broadcast(sample), "id").select("toxic", "text").mapInArrow(extract, schema)
    rows = written(given.groupBy("features", "swapped").agg(F.max("toxic").alias("toxic")), "toxic-sample")
    size, positive = rows.agg(F.count("toxic"), F.sum("toxic")).first()
    if not size:
        return Classifier([], np.zeros(0), -40.0, setup)
    share = positive / size
    seen = rows.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.count("toxic").alias("n"), F.sum("toxic").alias("k")
    )
    off = F.col("k") - F.col("n") * share
    strong = (
        seen.filter(F.col("n") >= setup.least)
        .select("f", (off * off / F.col("n")).alias("z")).orderBy(F.desc("z"), "f").limit(setup.features)
    )
    marks = {f for t in swap for f in features_of([t], setup)}
    names = marks | {r["f"] for r in strong.collect()}
    features = sorted(names)
    wanted = F.array(*[F.lit(f) for f in features])
    few = rows.select(
        "toxic", F.array_intersect("features", wanted).alias("a"), F.array_intersect("swapped", wanted).alias("b")
    ).toPandas()
    place = {f: i for i, f in enumerate(features)}
    x = np.zeros((len(few), len(features)), np.float32)
    other = np.zeros_like(x)
    for into, column in ((x, few["a"]), (other, few["b"])):
        for i, found in enumerate(column):
            into[i, [place[f] for f in found]] = 1
    # Rows in a fixed order, so that sums round alike on every run.
    order = np.lexsort(np.concatenate([x.T, few["toxic"].to_numpy()[None]])) if len(few) else []
    w, bias = fit(x[order], other[order], few["toxic"].to_numpy(np.float64)[order], setup)
    return Classifier(features, w, bias, setup)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    keep: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    cut: float = 0.7,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    setup: Setup = Setup(),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) packed in ``doc``, with ``held_out, score, predicted``.

    Learns from the labels of the rows where ``held_out`` (over the id column, which both
    tables have) is false. An empty or null text has the score of a text without features; without any
    labelled text all scores are next to 0. Rows are scored one by one, whole and repeated rows alike, so
    there are no ties to break; an empty table gives no rows.
    """
    held = F.coalesce(held_out, F.lit(False))
    mine = labels.filter(~held).select(F.col(doc_id).alias("id"), F.col(toxic).cast("double").alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    model = broadcast(docs.sparkSession, learn(texts, mine, groups, setup))
    # A text that is among the kept columns is sent to the workers once.
    kept = keep or docs.columns
    inside = text if text in kept and docs.schema[text].dataType == T.StringType() else None
    apart = [] if inside else [F.col(text).cast("string").alias("text")]
    lines = docs.select(F.struct(*kept).alias("doc"), held.alias("held_out"), *apart)
    schema = lines.select("doc", "held_out").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, some in text_slices(batches, inside):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("held_out"), pa.array([model.value.score(t) for t in some], pa.float64())],
                names=["doc", "held_out", "score"],
            )

    return lines.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))
