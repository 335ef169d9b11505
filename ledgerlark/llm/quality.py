"""Document quality from lines: a linear-chain conditional random field over a text's lines.

A line is described by measures, such as its share of capitals or of repeated words, each compared with
fixed steps; its own steps and those of the lines before and after it speak for or against it, and a transition says
how labels of neighbours go together. The marginals of being good come from forward and
backward products of 2 x 2 matrices, found by doubling for all lines of many texts at once: a text's first line has
a matrix of equal rows, which forgets whatever stood before. A document's score is the mean of its
lines' marginals, weighted by their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlark.llm.common import WordHasher, broadcast, gram_hashes, portions, rows_of, slices, written

# Kinds of bytes that lines are told apart by.
KINDS = ("blank", "small", "capital", "digit", "stop", "exclamation", "bar", "symbol", "beyond")
STOPS, SYMBOLS = b".,;:'\"()-?", b"#$%&*+/<=>@[\\]^_`{}~"

SHARES = (0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
# Each measure of a line and the steps it is compared with.
STEPS = {
    "words": (2, 4, 8, 16, 32, 64, 128, 256),
    "bytes a word": (2, 3, 4, 5, 6, 8, 10, 14, 20),
    "capitals among letters": SHARES,
    "symbols among signs": SHARES,
    "digits among signs": SHARES,
    "bars a word": SHARES,
    "exclamations a word": SHARES,
    "stops a word": SHARES,
    "words like the one before": SHARES,
    "repeated words": SHARES,
    "repeated word triples": SHARES,
    "lines like it in the text": (2, 3, 5, 10),
}
WIDTH = sum(map(len, STEPS.values()))
EVERY = 1 << 20


@dataclass(frozen=True)
class Setup:
    """The field is fitted on at most ``sample`` labelled documents, those of the smallest id
    hash, and at most ``segments`` runs of ``span`` of their lines; scores read every line."""

    sample: int = 6_000
    segments: int = 12_000
    span: int = 32
    steps: int = 300
    rate: float = 0.1
    decay: float = 1e-5


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, KINDS.index("symbol"), np.uint8)
    for name, members in (
        ("small", range(97, 123)), ("capital", range(65, 91)), ("digit", range(48, 58)), ("blank", (32, *range(9, 14), *range(32))),
        ("stop", STOPS), ("exclamation", b"!"), ("bar", b"|"), ("symbol", SYMBOLS), ("beyond", range(128, 256)),
    ):
        kinds[list(members)] = KINDS.index(name)
    return kinds


class Measurer:
    """Measures of the lines of many texts at once."""

    def __init__(self):
        self.kinds, self.hasher = byte_kinds(), WordHasher(limit=EVERY)

    def counts(self, lines: list[bytes]) -> np.ndarray:
        """(lines, kinds): bytes of each kind."""
        data = np.frombuffer(b"\n".join([*lines, b""]), np.uint8)
        out, at = np.zeros((len(lines), len(KINDS)), np.int64), 0
        for a, b in slices(len(data), EVERY):
            part = data[a:b]
            line = np.cumsum(part == 10) - (part == 10)
            n = int(line[-1]) + 1
            found = np.bincount(line * len(KINDS) + self.kinds[part], minlength=n * len(KINDS)).reshape(n, -1)
            out[at : at + n] += found[: len(out) - at]
            at += int((part == 10).sum())
        return out

    def repeats(self, lines: list[bytes]) -> np.ndarray:
        """(lines, 4): words, words like the one before, words and word triples seen before in the line."""
        words = self.hasher.of(lines)
        n = np.diff(words.starts)
        of = np.repeat(np.arange(len(lines)), n)
        same = np.zeros(len(of), bool)
        same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (of[1:] == of[:-1])
        triples, owner = gram_hashes(words.hashes, 3), of[: max(len(of) - 2, 0)]
        whole = owner == of[2:] if len(of) > 2 else np.zeros(0, bool)
        return np.stack(
            [n, np.bincount(of, same, len(lines)), again(words.hashes, of, len(lines)), again(triples[whole], owner[whole], len(lines))],
            axis=1,
        )

    def steps(self, lines: list[bytes], copies: list[int]) -> np.ndarray:
        """(lines, WIDTH) of 0 and 1: which steps each measure of a line reaches."""
        kind = dict(zip(KINDS, self.counts(lines).T.astype(float)))
        words, like, seen, triples = self.repeats(lines).T
        one = lambda x: np.maximum(x, 1)
        signs = sum(kind[k] for k in KINDS if k != "blank")
        measures = {
            "words": words,
            "bytes a word": signs / one(words),
            "capitals among letters": kind["capital"] / one(kind["capital"] + kind["small"]),
            "symbols among signs": kind["symbol"] / one(signs),
            "digits among signs": kind["digit"] / one(signs),
            "bars a word": kind["bar"] / one(words),
            "exclamations a word": kind["exclamation"] / one(words),
            "stops a word": kind["stop"] / one(words),
            "words like the one before": like / one(words),
            "repeated words": seen / one(words),
            "repeated word triples": triples / one(words - 2),
            "lines like it in the text": np.array(copies, float),
        }
        return np.concatenate([measures[m][:, None] >= np.array(s) for m, s in STEPS.items()], axis=1).astype(np.uint8)


def again(hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """How many hashes of each owner are not the first of their value."""
    order = np.lexsort((hashes, of))
    h, o = hashes[order], of[order]
    repeated = np.zeros(len(h), bool)
    repeated[1:] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o, repeated, n)


def lines_of(text: bytes) -> tuple[list[int], list[bytes]]:
    """Numbers and bytes of the lines that are not blank."""
    found = [(i, line) for i, line in enumerate(text.split(b"\n")) if line and not line.isspace()]
    return [i for i, _ in found], [line for _, line in found]


class Lines:
    """The lines of several texts: ``starts[i]`` to ``starts[i + 1]`` are those of text ``i``."""

    def __init__(self, texts: list[bytes], measurer: Measurer):
        self.numbers, flat, copies, starts = [], [], [], [0]
        for text in texts:
            numbers, lines = lines_of(text)
            counted = Counter(lines)
            self.numbers += numbers
            flat += lines
            copies += [counted[x] for x in lines]
            starts.append(len(flat))
        self.starts = np.array(starts)
        self.length = np.array([len(x) for x in flat], float)
        self.x = measurer.steps(flat, copies) if flat else np.zeros((0, WIDTH), np.uint8)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices, (2, 2, n), scaled to a greatest entry of 1."""
    out = np.stack([[a[i, 0] * b[0, j] + a[i, 1] * b[1, j] for j in (0, 1)] for i in (0, 1)])
    return out / out.max(axis=(0, 1))


def scanned(m: np.ndarray, longest: int, forward: bool) -> np.ndarray:
    """At each place the product of the matrices up to it (or from it on), by doubling.

    Matrices of equal rows stand at most ``longest`` apart, so products of that many are enough.
    """
    p, step = m / m.max(axis=(0, 1)), 1
    while step < longest:
        q = p.copy()
        if forward:
            q[:, :, step:] = product(p[:, :, :-step], p[:, :, step:])
        else:
            q[:, :, :-step] = product(p[:, :, :-step], p[:, :, step:])
        p, step = q, 2 * step
    return p


class Field:
    """Weights of a line's own steps, of those of the lines before and after it; bias, transitions, beginnings."""

    def __init__(self, prior: float = 0.5):
        self.w = np.zeros((WIDTH, 3))
        self.bias = np.zeros(1)
        self.move = np.zeros((2, 2))
        self.begin = np.zeros(2)
        self.prior = prior

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.bias, self.move, self.begin]

    def margins(self, x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """What each line's features say for it being good."""
        own, before, after = (x @ self.w.astype(np.float32)).T.astype(float)
        out = own + self.bias
        out[1:] += np.where(first[1:], 0, before[:-1])
        out[:-1] += np.where(last[:-1], 0, after[1:])
        return np.clip(out, -30, 30)

    def chain(self, margins: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A line's matrix over (label before, label): equal rows where a text begins."""
        m = np.repeat(np.exp(self.move)[:, :, None], len(margins), axis=2)
        m[:, :, first] = np.exp(self.begin)[None, :, None]
        m[:, 0] *= np.exp(np.minimum(-margins, 0))
        m[:, 1] *= np.exp(np.minimum(margins, 0))
        return m

    def marginals(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of good, (2, 2, lines) of label pairs with the line before) of every line."""
        n, sizes = len(x), np.diff(starts)
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        first[starts[:-1][sizes > 0]] = True
        last[starts[1:][sizes > 0] - 1] = True
        m = self.chain(self.margins(x, first, last), first)
        longest = int(sizes.max(initial=1))
        alpha = scanned(m, longest, True)[0]
        beta = np.ones((2, n))
        beta[:, :-1] = scanned(m, longest + 1, False)[:, :, 1:].sum(axis=1)
        beta[:, last] = 1
        good = alpha * beta
        pairs = np.zeros((2, 2, n))
        pairs[:, :, 1:] = alpha[:, None, :-1] * m[:, :, 1:] * beta[None, :, 1:]
        pairs /= np.maximum(pairs.sum(axis=(0, 1)), 1e-300)
        pairs[:, :, first] = 0
        return good[1] / good.sum(axis=0), pairs

    def slopes(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Mean gradient of the log-likelihood of line labels ``y``, one for each part."""
        n = len(x)
        good, pairs = self.marginals(x, starts)
        first = np.zeros(n, bool)
        first[starts[:-1]] = True
        off = y - good
        from_next, from_last = np.zeros(n), np.zeros(n)
        from_next[:-1] = np.where(first[1:], 0, off[1:])
        from_last[1:] = np.where(first[1:], 0, off[:-1])
        w = x.T @ np.stack([off, from_next, from_last], axis=1).astype(np.float32)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:-1][~first[1:]].astype(int), y[1:][~first[1:]].astype(int)), 1)
        begin = off[first].sum()
        return [g / n for g in (w, np.array([off.sum()]), seen - pairs.sum(axis=2), np.array([-begin, begin]))]

    def score(self, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
        """(score of each text, probability of good of each line)."""
        n = len(lines.starts) - 1
        good = self.marginals(lines.x.astype(np.float32), lines.starts)[0] if len(lines.x) else np.zeros(0)
        of = np.repeat(np.arange(n), np.diff(lines.starts))
        length = np.bincount(of, lines.length, n)
        mean = np.bincount(of, lines.length * good, n) / np.maximum(length, 1)
        return np.where(length > 0, np.clip(mean, 0, 1), self.prior), good


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, prior: float, setup: Setup) -> Field:
    """Climbs the penalised likelihood with a step size of its own for every weight."""
    field = Field(prior)
    x, first = x.astype(np.float32), [np.zeros_like(p) for p in field.parts()]
    second = [np.zeros_like(p) for p in field.parts()]
    for step in range(1, setup.steps + 1):
        slopes = field.slopes(x, starts, y)
        for p, g, f, s in zip(field.parts(), slopes, first, second):
            g = g - setup.decay * p
            f += 0.1 * (g - f)
            s += 0.01 * (g * g - s)
            p += setup.rate * (f / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return field


SEGMENT = "place bigint, good int, lines binary"
SEGMENT_ARROW = pa.schema([("place", pa.int64()), ("good", pa.int32()), ("lines", pa.binary())])


def learn(docs: DataFrame, labels: DataFrame, setup: Setup = Setup()) -> Field:
    """The field from ``docs`` (id, text) with ``labels`` (id, quality): every line has its document's label.

    Labels of an id are averaged and rounded. The sample of ids is bounded, so it is broadcast to
    the scan; equal segments of one label count once.
    """
    known = labels.filter("id IS NOT NULL AND quality IS NOT NULL").groupBy("id").agg(F.avg("quality").alias("q"))
    sample = known.select("id", (F.col("q") >= 0.5).cast("int").alias("good")).orderBy(F.xxhash64("id"), "id").limit(setup.sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer()
        for batch, texts in portions(batches):
            lines = Lines(texts, measurer)
            out = []
            for i, (place, good) in enumerate(zip(batch.column("place").to_pylist(), batch.column("good").to_pylist())):
                for a in range(lines.starts[i], lines.starts[i + 1], setup.span):
                    b = min(a + setup.span, lines.starts[i + 1])
                    out.append((place, good, np.packbits(lines.x[a:b]).tobytes()))
            if out:
                yield rows_of(SEGMENT_ARROW, [list(c) for c in zip(*out)])

    met = docs.join(F.broadcast(sample), "id").select(F.xxhash64("id").alias("place"), "good", "text")
    segments = met.mapInArrow(extract, SEGMENT).groupBy("good", "lines").agg(F.min("place").alias("place"))
    rows = written(segments.orderBy("place", F.xxhash64("lines"), "lines").limit(setup.segments), "quality-segments").toPandas()
    known_good = sample.agg(F.avg("good")).first()[0]
    prior = 0.5 if known_good is None else float(known_good)
    if not len(rows) or rows["good"].nunique() < 2:
        return Field(prior) if not len(rows) else constant(prior)
    rows = rows.sort_values(["place", "good", "lines"])  # a fixed order, so that sums round alike on every run
    bits = [np.unpackbits(np.frombuffer(b, np.uint8)) for b in rows["lines"]]
    parts = [b[: len(b) // WIDTH * WIDTH].reshape(-1, WIDTH) for b in bits]
    sizes = [len(p) for p in parts]
    return fit(np.concatenate(parts), np.cumsum([0, *sizes]), np.repeat(rows["good"].to_numpy(float), sizes), prior, setup)


def constant(prior: float) -> Field:
    """A field that finds every line as good as the one label there is."""
    field = Field(prior)
    field.begin[1], field.move[:, 1] = (30, 30) if prior > 0.5 else (-30, -30)
    return field


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    keep: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    cut: float = 0.3,
    setup: Setup = Setup(),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) packed in ``doc``, with ``held_out, score, predicted, bad_lines``.

    Learns from the labels of the rows where ``held_out`` (over the id column, which both tables
    have) is false. Lines end at a line feed; blank ones are passed over. ``bad_lines`` has the numbers, from 0, of the
    lines that are rather bad than good. A null, empty or blank text has no lines and gets the share of good
    documents in the sample, 0.5 without labelled rows; without any labels every text scores 0.5, with labels of one
    value close to that value. Every line of a text counts, however long it is; rows are scored one by one, so repeated
    rows score alike. An empty table gives no rows.
    """
    held = F.coalesce(held_out, F.lit(False))
    mine = labels.filter(~held).select(F.col(doc_id).alias("id"), F.col(quality).cast("double").alias("quality"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    model = broadcast(docs.sparkSession, learn(texts, mine, setup))
    lines = docs.select(
        F.struct(*(keep or docs.columns)).alias("doc"), held.alias("held_out"), F.col(text).cast("string").alias("text")
    )
    schema = lines.select("doc", "held_out").schema.add("score", "double").add("bad_lines", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer()
        for batch, some in portions(batches):
            found = Lines(some, measurer)
            score, good = model.value.score(found)
            numbers = np.array(found.numbers, np.int64)
            bad = [numbers[a:b][good[a:b] < 0.5].tolist() for a, b in zip(found.starts[:-1], found.starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("held_out"), pa.array(score), pa.array(bad, pa.list_(pa.int32()))],
                names=["doc", "held_out", "score", "bad_lines"],
            )

    return lines.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))
