"""Benchmark decontamination by winnowing.

Of every ``window`` consecutive words a fingerprint is kept: the smallest hash of the shorter
k-grams in it, the rightmost of equal ones. A window that a document and a benchmark item
share has the same smallest k-gram in both, so the two have a fingerprint in common there: no
shared span of a window's length goes unseen. Fingerprints of both sides are joined, and every
match is extended word by word to the windows around it.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ledgerlark.llm.common import U64, WordHasher, Words, bitmap_of, broadcast, gram_hashes, mix, portions, rows_of, written

KEPT = string.digits + string.ascii_letters
# Other ASCII characters part words, capitals become small; bytes of other characters stay.
TABLE = bytes(ord(chr(b).lower()) if b >= 128 or chr(b) in KEPT else 32 for b in range(128)) + bytes(range(128, 256))


def kept_grams(words: Words, window: int, k: int) -> np.ndarray:
    """Places of the k-grams kept: the rightmost smallest of each window's ``window - k + 1``."""
    m = len(words.hashes) - window + 1
    if m <= 0:
        return np.empty(0, np.int64)
    grams = mix(gram_hashes(words.hashes, k), 5)
    best, place = grams[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, window - k + 1):
        other = grams[j : j + m]
        lower = other <= best
        best[lower], place[lower] = other[lower], j
    kept = np.zeros(len(grams), bool)
    inside = text_ends(words)[:m] >= np.arange(m) + window  # the window ends in its own text
    kept[(np.arange(m) + place)[inside]] = True
    return np.flatnonzero(kept)


def text_ends(words: Words) -> np.ndarray:
    """For each word, where its text ends."""
    return np.repeat(words.starts[1:], np.diff(words.starts))


def around(words: Words, places: np.ndarray, reach: int, span: int) -> np.ndarray:
    """Hashes of the words from ``reach`` before each place to ``span`` after it; 0 outside its text."""
    at = places[:, None] + np.arange(-reach, span)
    of = np.searchsorted(words.starts, places, side="right") - 1
    inside = (at >= words.starts[of][:, None]) & (at < words.starts[of + 1][:, None])
    return np.where(inside, words.hashes[np.clip(at, 0, len(words.hashes) - 1)], U64(0))


PRINTS_SQL = "key bigint, size int, at int, print bigint, context array<bigint>"
PRINTS = pa.schema([
    ("key", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("print", pa.int64()), ("context", pa.list_(pa.int64()))
])


def prints_of(words: Words, size: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) for windows of ``size`` words; a short window is its own k-gram."""
    places = kept_grams(words, size, size if size < window else k)
    return places, mix(gram_hashes(words.hashes, size if size < window else k)[places], size)


def emitted(keys: np.ndarray, words: Words, size: int, window: int, k: int, places: np.ndarray, prints: np.ndarray):
    """The fingerprints with their texts' keys, their places there and the words around them."""
    of = np.searchsorted(words.starts, places, side="right") - 1
    context = around(words, places, size - (size if size < window else k), size)
    for a in range(0, len(places), 1000):
        s = slice(a, a + 1000)
        n = len(places[s])
        yield rows_of(PRINTS, [
            keys[of[s]], np.full(n, size, np.int32), (places[s] - words.starts[of[s]]).astype(np.int32),
            prints[s].view(np.int64), list(context[s].view(np.int64)),
        ])


def hits(docs: DataFrame, items: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(windows of the rows ``docs`` (row, doc, text) that occur in ``items`` (item, text), (row, doc, n_words)).

    The windows are (row, begin, size, item). ``items`` has one row an item. ``docs`` is read in one
    job, which writes a row's number with all that belongs to it.
    """
    spark = docs.sparkSession

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(TABLE)
        for part, texts in portions(batches):
            for key, text in zip(part.column("item").to_pylist(), texts):
                words = hasher.of([text])
                size = min(window, len(words.hashes))
                if size:
                    yield from emitted(np.array([key]), words, size, window, k, *prints_of(words, size, window, k))

    bench = written(items.select("item", "text").mapInArrow(of_items, PRINTS_SQL), "item-prints")
    maybe = broadcast(spark, bitmap_of(bench.select("print").distinct(), "print", bits=24))
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most ``window``

    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(TABLE)
        for part, texts in portions(batches):
            rows, words = part.column("row").to_numpy(), hasher.of(texts)
            for size in sizes:
                places, prints = prints_of(words, size, window, k)
                seen = maybe.value.has(prints)
                for found in emitted(rows, words, size, window, k, places[seen], prints[seen]):
                    yield with_doc(found, pa.nulls(found.num_rows, part.column("doc").type))
            # A row of size 0 has the document and tells the number of words.
            n = len(rows)
            yield with_doc(rows_of(PRINTS, [
                rows, np.zeros(n, np.int32), np.diff(words.starts).astype(np.int32), pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.list_(pa.int64())),
            ]), part.column("doc"))

    def with_doc(found: pa.RecordBatch, doc: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*found.columns, doc], names=schema.names)

    schema = StructType.fromDDL(PRINTS_SQL).add("doc", docs.schema["doc"].dataType)
    prints = written(docs.select("row", "doc", "text").mapInArrow(of_docs, schema), "doc-prints")
    counted = prints.filter("size = 0").select(F.col("key").alias("row"), "doc", F.col("at").alias("n_words"))
    left = prints.filter("size > 0").select(F.col("key").alias("row"), "size", "at", "print", "context")
    right = bench.select(F.col("key").alias("item"), "size", "print", F.col("context").alias("of_item"))
    windows = (
        left.join(right, ["size", "print"])
        .select("row", "item", "size", F.posexplode(shared_windows("context", "of_item", "size")).alias("j", "ok"), "at", "context")
        .filter("ok")
    )
    # A context begins as many words before its fingerprint as it is longer than a window.
    begin = F.col("at") - (F.size("context") - F.col("size")) + F.col("j")
    return windows.select("row", "item", "size", begin.alias("begin")).distinct(), counted


def shared_windows(a: str, b: str, size: str) -> Column:
    """For each window of ``size`` words inside the two contexts, whether all its words agree."""
    same = F.zip_with(a, b, lambda x, y: (x == y) & (x != 0))
    starts = F.sequence(F.lit(0), F.size(a) - F.col(size))
    return F.transform(starts, lambda i: F.forall(F.slice(same, i + 1, F.col(size)), lambda s: s))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    k: int = 5,
    keep: list[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all but the text) packed in ``doc``, with ``n_words, n_hit, items``.

    ``n_hit`` counts the words of a row inside any occurrence of a window of an item: any
    ``window`` consecutive words of it, or all of an item with fewer. ``items`` lists the ids, as text and sorted, of
    the items with an occurrence. Null and empty texts have no words; an item without words
    has no window; repeated rows and items are each judged alike, items of a null id are
    counted as the id ''.
    """
    if not 1 <= k <= window:
        raise ValueError("a k-gram must fit into the window")
    lines = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"),
        F.struct(*(keep or [c for c in docs.columns if c != text])).alias("doc"),
    )
    items = written(benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"),
        F.col(text).cast("string").alias("text"),
    ), "items")
    found, counted = hits(lines, items, window, k)
    found = written(found, "hit-windows")
    names = found.select("row", "item").distinct().join(items.select("item", "name"), "item")
    listed = names.groupBy("row").agg(F.sort_array(F.collect_set("name")).alias("items"))
    # Words covered by the union of a row's windows, from left to right.
    ends = found.groupBy("row", "begin").agg((F.col("begin") + F.max("size")).alias("end"))
    before = Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("begin"), reached), F.lit(0))
    covered = ends.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    dirty = written(covered.join(listed, "row"), "hit-rows")  # its size is known, so few rows go to the documents
    nothing = F.array().cast("array<string>")
    return (
        counted.join(dirty, "row", "left")
        .select("doc", F.col("n_words").cast("long").alias("n_words"),
                F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", nothing).alias("items"))
    )
