"""Language identification by bit-sliced Bloom filters of character n-grams.

Up to 64 languages share one filter: each of its slots is a word with one bit a language, and
an n-gram sets its languages' bits in every slot it hashes to. The AND over the slots gives at
once all languages that may hold the n-gram. More languages take more filters, each as large
as the n-grams of its own languages need; their number is not limited. A document's count for a language is the number
of its n-grams with the language's bit, less what false positives account for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlark.llm.common import U64, broadcast, mix, rows_of, written

UNKNOWN = "und"
BLOCK = 64  # bits of a slot
PORTION = 500_000  # characters looked at together
GAP = 0x0A


@dataclass(frozen=True)
class Setup:
    """An n-gram belongs to a language if it is at least ``least`` of the language's n-grams,
    which bounds the filter at ``1 / least`` entries a language, and has at least ``against``
    times the share it has in any other language."""

    n: int = 3
    least: float = 2e-5
    against: float = 0.1
    probes: int = 3
    slots_per_entry: int = 8


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def text_grams(
    texts: list[str], n: int, more: list[str] | None = None, joined: list[bool] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every n-gram of letters and word gaps of the lower-cased texts.

    ``more`` is what follows each text where it was cut off from a longer one: n-grams may reach
    into it, but none begins there. ``joined`` tells texts that begin inside a word: no gap is there.
    """
    own = [t.lower() for t in texts]
    ahead = [t.lower() for t in more or [""] * len(texts)]
    lengths = np.array([(len(a), len(b)) for a, b in zip(own, ahead)], np.int64).reshape(-1)
    points = np.frombuffer("".join(x for pair in zip(own, ahead) for x in pair).encode("utf-32-le", "replace"), np.uint32)
    del own, ahead
    of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths.reshape(-1, 2).sum(axis=1))
    is_letter = letters()[points]
    # A gap stands before a word's first letter and after its last one.
    prior = np.append(False, is_letter[:-1]) & np.append(False, of[1:] == of[:-1])
    first = is_letter & ~prior
    places = np.cumsum(is_letter.astype(np.int8) + first, dtype=np.int32) - 1  # of letters in the packed text
    size = int(is_letter.sum() + first.sum()) + 1
    packed = np.full(size, GAP, np.uint32)
    packed[places[is_letter]] = points[is_letter]
    owner = np.zeros(size, np.int32)
    owner[places[is_letter]] = of[is_letter]
    owner[places[first] - 1] = of[first]
    owner[-1] = len(texts)
    begins = np.ones(size, bool)
    if more:
        foreign = np.repeat(np.arange(len(lengths)) % 2 == 1, lengths)
        begins[places[is_letter & foreign]] = False
        begins[places[first & foreign] - 1] = False
        start = (np.cumsum(lengths) - lengths)[::2][np.array(joined, bool)]
        begins[places[start[is_letter[start]]] - 1] = False
        del foreign
    del points, of, is_letter, prior, first, places
    m = size - n + 1
    if m <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    key = np.zeros(m, U64)
    for j in range(n):
        key = (key << U64(21)) | packed[j : j + m].astype(U64) if n <= 3 else mix(key + packed[j : j + m].astype(U64), j)
    # An n-gram is of the text of its first place; it must not reach into another text,
    # except for the gap that closes its last word.
    last = owner[n - 1 : n - 1 + m]
    inside = (owner[:m] == last) | ((packed[n - 1 : n - 1 + m] == GAP) & (owner[n - 2 : n - 2 + m] == owner[:m]))
    inside &= begins[:m]
    return key[inside], owner[:m][inside]


def pieces(texts: list[str | None], n: int, size: int) -> Iterator[tuple[list[int], list[str], list[str], list[bool]]]:
    """The texts in lots of about ``size`` characters: text numbers, pieces, what follows each, and whether it
    begins inside a word.

    A text beyond ``size`` is cut where it has no letter, if there is such a place, and each piece knows the
    characters up to the n-th letter after it, so that its n-grams are those of the whole text.
    """
    lot, held = [], 0
    for i, text in enumerate(texts):
        text, a, inside = text or "", 0, False
        while a < len(text):
            b = min(a + size, len(text))
            cut = b
            while b < len(text) and cut > a and text[cut - 1].isalpha():
                cut -= 1
            b = cut if cut > a else b
            seen, c = 0, b
            while c < len(text) and seen < n:
                seen += text[c].isalpha()
                c += 1
            lot.append((i, text[a:b], text[b:c], inside))
            held += b - a
            a, inside = b, text[b - 1].isalpha()
            if held >= size:
                yield tuple(map(list, zip(*lot)))
                lot, held = [], 0
    if lot:
        yield tuple(map(list, zip(*lot)))


class BlockFilter:
    """Bit-sliced Bloom filter of at most 64 languages: ``slots[h] >> language & 1``."""

    def __init__(self, keys: np.ndarray, masks: np.ndarray, n_languages: int, setup: Setup):
        self.setup = setup
        self.bits = max(10, int(np.ceil(np.log2(max(len(keys), 1) * setup.slots_per_entry))))
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(t).bits >= max(n_languages, 1))
        self.slots = np.zeros(1 << self.bits, kind)
        for place in self.places(keys):
            np.bitwise_or.at(self.slots, place, masks.astype(kind))
        filled = np.array([((self.slots >> kind(i)) & kind(1)).mean() for i in range(n_languages)])
        self.false = filled**setup.probes

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(self.setup.probes):
            yield (mix(keys, k + 1) >> U64(64 - self.bits)).astype(np.int64)

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """The languages that may hold each n-gram, as bits."""
        out = None
        for place in self.places(keys):
            out = self.slots[place] if out is None else out & self.slots[place]
        return out


class LanguageFilter:
    """One filter for each block of 64 languages; ``masks`` has a word for each block."""

    def __init__(self, keys: np.ndarray, masks: np.ndarray, languages: list[str], shares: np.ndarray, setup: Setup):
        self.languages, self.setup, self.shares = languages, setup, shares
        masks = masks.reshape(len(keys), max(1, -(-len(languages) // BLOCK)))
        self.blocks = []
        for b, own in enumerate(masks.T):
            held = own != 0
            self.blocks.append(BlockFilter(keys[held], own[held], min(len(languages) - b * BLOCK, BLOCK), setup))

    def masks(self, keys: np.ndarray, block: int = 0) -> np.ndarray:
        """The languages of a block that may hold each n-gram, as bits."""
        return self.blocks[block].masks(keys)

    def hits(self, keys: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
        """(texts, languages) numbers of n-grams with the language's bit."""
        out = np.zeros((n_texts, len(self.languages)), np.int64)
        for b, block in enumerate(self.blocks):
            masks = block.masks(keys)
            for i in range(len(block.false)):
                has = (masks >> masks.dtype.type(i)) & masks.dtype.type(1) == 1
                out[:, b * BLOCK + i] = np.bincount(of[has], minlength=n_texts)
        return out

    def corrected(self, hits: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Shares of the n-grams that are the language's, less false positives."""
        false = np.concatenate([block.false for block in self.blocks])
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - false) / np.maximum(1 - false, 1e-9), 0, 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; the score is the share its n-grams that are the language's."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, hits = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.languages)), np.int64)
        for numbers, own, more, joined in pieces(texts, self.setup.n, PORTION):
            keys, of = text_grams(own, self.setup.n, more, joined)
            of = np.array(numbers, np.int64)[of]
            low, high = numbers[0], numbers[-1] + 1
            total[low:high] += np.bincount(of - low, minlength=high - low)
            hits[low:high] += self.hits(keys, of - low, high - low)
        seen, counts = total > 0, self.corrected(hits, total)
        # Ties go to the language of more training text, then to the first by name.
        best = np.lexsort((np.broadcast_to(self.shares, counts.shape), counts), axis=1)[:, ::-1]
        top = best[:, 0]
        score = counts[np.arange(len(texts)), top]
        names = [self.languages[i] if s else UNKNOWN for i, s in zip(top.tolist(), seen.tolist())]
        return names, np.where(seen, score, 0.0)


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str | None = None, size: int = PORTION
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches of about ``size`` bytes of text, with the texts of each, made when it is its turn.

    The texts are the column ``text``, or the field of that name of the column ``doc``.
    """
    for batch in batches:
        column = batch.column("doc").field(text) if text else batch.column("text")
        length = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).cumsum()
        begin = 0
        while begin < batch.num_rows:
            before = length[begin - 1] if begin else 0
            end = min(int(np.searchsorted(length, before + size)) + 1, batch.num_rows)
            yield batch.slice(begin, end - begin), column.slice(begin, end - begin).to_pylist()
            begin = end
    pa.default_memory_pool().release_unused()  # a worker lives on, with the tasks of the next stage


GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def learn(train: DataFrame, setup: Setup = Setup()) -> LanguageFilter:
    """The filter from ``train`` (text, lang), every row with both counted.

    Tasks count the n-grams of each language, Spark adds them up and keeps those that reach the
    shares of ``setup``; so at most ``1 / least`` rows a language come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch, texts in text_slices(batches):
            names, number = np.unique(batch.column("lang").to_pylist(), return_inverse=True)
            for numbers, own, more, joined in pieces(texts, setup.n, PORTION):
                keys, of = text_grams(own, setup.n, more, joined)
                spoken = number[np.array(numbers)[of]]
                for i, lang in enumerate(names.tolist()):
                    found, n = np.unique(keys[spoken == i], return_counts=True)
                    if lang in held:
                        found, back = np.unique(np.concatenate([held[lang][0], found]), return_inverse=True)
                        n = np.bincount(back, np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = (found, n)
                if sum(len(k) for k, _ in held.values()) > 1_000_000:
                    yield from emit(held)
                    held = {}
        yield from emit(held)

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, (keys, n) in held.items():
            for a in range(0, len(keys), 50_000):
                part = keys[a : a + 50_000]
                yield rows_of(GRAMS, [[lang] * len(part), part.view(np.int64), n[a : a + 50_000]])

    rows = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    partial = rows.mapInArrow(count, "lang string, gram bigint, n bigint")
    counts = written(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row a language
    if not totals:
        return LanguageFilter(np.empty(0, U64), np.empty(0, U64), [], np.empty(0), setup)
    languages = sorted(totals, reverse=True)  # the first by name wins the last tie
    named = train.sparkSession.createDataFrame(
        [(lang, i, float(totals[lang])) for i, lang in enumerate(languages)], "lang string, bit int, total double"
    )
    shares = counts.join(F.broadcast(named), "lang").select("gram", (F.col("n") / F.col("total")).alias("share"), "bit")
    per_gram = (
        shares.filter(F.col("share") >= setup.least)
        .groupBy("gram").agg(F.collect_list(F.struct("bit", "share")).alias("in"), F.max("share").alias("most"))
    )
    kept = per_gram.select(
        "gram", F.transform(F.filter("in", lambda x: x["share"] >= setup.against * F.col("most")), lambda x: x["bit"]).alias("bits")
    ).toPandas()
    keys = kept["gram"].to_numpy(np.int64).view(U64) if len(kept) else np.empty(0, U64)
    masks = np.zeros((len(kept), -(-len(languages) // BLOCK)), U64)
    if len(kept):
        bits = np.concatenate(kept["bits"].to_list()).astype(np.int64)
        of = np.repeat(np.arange(len(kept)), kept["bits"].map(len))
        np.bitwise_or.at(masks, (of, bits // BLOCK), U64(1) << (bits % BLOCK).astype(U64))
    return LanguageFilter(keys, masks, languages, np.array([totals[x] for x in languages], float), setup)


def identify(
    docs: DataFrame, held_out: Column, keep: list[str] | None = None, text: str = "text", lang: str = "lang",
    setup: Setup = Setup(),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) packed in ``doc``, with ``held_out, lang_pred, score``.

    Learns from the rows where ``held_out`` is false and both text and language are known. A
    text that is null or has no letter is ``und`` with score 0; so is every text if there is
    nothing to learn from. A text with letters that no language holds gets the language of
    most training text, with score 0; ties go the same way, then to the first by name. The whole text counts, a very long
    one piece by piece; rows do not meet each other, so repeated rows get the same result, and an empty table gives
    no rows. A text that is among the kept columns is sent to the workers once.
    """
    held = F.coalesce(held_out, F.lit(False))
    train = docs.filter(~held).select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    model = broadcast(docs.sparkSession, learn(train, setup))
    kept = keep or docs.columns
    inside = text if text in kept and docs.schema[text].dataType == T.StringType() else None
    apart = [] if inside else [F.col(text).cast("string").alias("text")]
    lines = docs.select(F.struct(*kept).alias("doc"), held.alias("held_out"), *apart)
    schema = lines.select("doc", "held_out").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, inside):
            names, score = model.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc", "held_out", "lang_pred", "score"],
            )

    return lines.mapInArrow(run, schema)
