"""What several operators share: row keys, words, hashes, small bitmaps, written tables."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.session import fresh_path

U64 = np.uint64


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers that start in another folder of this machine import the package.

    On a cluster the package is shipped or installed as usual; the path is then of no effect.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def is_remainder(doc_id: Column, modulus: int, value: int) -> Column:
    """Whether the id falls on ``value``; false for a null id."""
    return F.coalesce(remainder(doc_id, modulus) == value, F.lit(False))


WITH_TEXTS = {"numbered-texts", "shingle-sets"}  # tables


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared work folder, read back.

    It cuts the lineage, so a lost executor costs a reread and not the work before it. Tables
    that hold whole texts are packed by zstd.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd"} if name in WITH_TEXTS else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside sends its rows to Python in batches of at most ``rows``, or of fewer if the session says so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def rows_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def binary_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def slices(n: int, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, n, size):
        yield start, min(start + size, n)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANKS = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    ``table`` maps bytes: what parts words becomes a blank, capitals become small. With running
    sums of ``value[byte] * BASE ** place`` a word's hash is a difference of two sums, shifted back to
    place 0, whatever its length; long input is cut at blanks, so that memory stays bounded.
    """

    def __init__(self, table: bytes = BLANKS, limit: int = 1 << 18):
        self.table, self.limit = table, limit
        self.values = mix(np.arange(1, 257, dtype=U64), 3)
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            steps = np.full(n, BASE, U64), np.full(n, INVERSE, U64)
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.cumprod(step, dtype=U64) for step in steps)

    def of(self, texts: list[bytes]) -> "Words":
        data = b" ".join([*texts, b""]).translate(self.table)
        begins, ends, hashes, at = [], [], [], 0
        while at < len(data):
            cut = len(data)
            if cut - at > self.limit:
                cut = data.rfind(b" ", at, at + self.limit) + 1 or data.find(b" ", at) + 1
            b, e, h = self.part(data[at:cut])
            begins.append(b + at)
            ends.append(e + at)
            hashes.append(h)
            at = cut
        begin, end, h = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (begins, ends, hashes))
        offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
        return Words(data, begin, end, h.astype(U64), np.searchsorted(begin, offsets))

    def part(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = np.frombuffer(data, np.uint8)
        blank = np.concatenate([[True], points == 32, [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        begin, end = edges[::2], edges[1::2]
        self.powers(len(points))
        sums = np.zeros(len(points) + 1, U64)
        np.cumsum(self.values[points] * self.up[: len(points)], out=sums[1:])
        return begin, end, mix((sums[end] - sums[begin]) * self.down[begin], 1)


class Words:
    """Words of several texts: places in ``data``, hashes, and ``starts``: text ``i`` has the
    words from ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, data: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, starts: np.ndarray):
        self.data, self.begin, self.end, self.hashes, self.starts = data, begin, end, hashes, starts

    def text(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def portions(batches: Iterable[pa.RecordBatch], size: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``size`` bytes of text, and their texts (null: empty)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        begin = held = 0
        for i, n in enumerate(sizes.tolist()):
            held += n
            if held >= size or i + 1 == len(sizes):
                part = batch.slice(begin, i + 1 - begin)  # only these texts become objects
                yield part, [t or b"" for t in binaries(part, "text")]
                begin, held = i + 1, 0
    pa.default_memory_pool().release_unused()  # a worker lives on, with the tasks of the next stage


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; each seed gives another one."""
    h = h + U64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` consecutive word hashes that begin at each position."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, U64)
    h = mix(words[:size])
    for j in range(1, n):
        h = mix(h + words[j : j + size], j)
    return h


class Bitmap:
    """A Bloom filter of fixed size over 64-bit hashes: ``2 ** bits`` bits, ``probes`` probes."""

    def __init__(self, bits: int = 23, probes: int = 3, data: np.ndarray | None = None):
        self.bits, self.probes = bits, probes
        self.data = np.zeros(1 << (bits - 3), np.uint8) if data is None else data

    def places(self, hashes: np.ndarray) -> Iterable[np.ndarray]:
        for k in range(self.probes):
            yield mix(hashes, k + 101) >> U64(64 - self.bits)

    def add(self, hashes: np.ndarray) -> None:
        for place in self.places(hashes):
            np.bitwise_or.at(self.data, (place >> U64(3)).astype(np.int64), np.uint8(1) << (place & U64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for place in self.places(hashes):
            out &= (self.data[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1
        return out


def bitmap_of(hashes: DataFrame, column: str, bits: int = 23, probes: int = 3) -> Bitmap:
    """The fixed-size Bloom filter of a long column, built in the tasks.

    Every task sends its bitmap in pieces; pieces are united where they meet, one row of a
    few KB per piece comes to the driver, ``2 ** (bits - 3)`` bytes in all at any input size.
    """
    piece = 1 << 13

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bitmap(bits, probes)
        for b in batches:
            own.add(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
        return pieces(own.data.reshape(-1, piece), lambda x: x.any())

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, np.uint8)
                held[at] = held[at] | part if at in held else part
        return pieces_of(held)

    parts = hashes.select(F.col(column).cast("long").alias("h")).filter("h IS NOT NULL").mapInArrow(build, PIECE)
    whole = parts.repartition("piece").mapInArrow(unite, PIECE)
    out = Bitmap(bits, probes)
    for row in whole.collect():
        view = out.data[row["piece"] * piece : (row["piece"] + 1) * piece]
        view |= np.frombuffer(row["data"], np.uint8)
    return out


PIECE = "piece int, data binary"
PIECE_ARROW = pa.schema([("piece", pa.int32()), ("data", pa.binary())])


def pieces(parts: np.ndarray, wanted) -> Iterator[pa.RecordBatch]:
    return pieces_of({i: p for i, p in enumerate(parts) if wanted(p)})


def pieces_of(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield rows_of(PIECE_ARROW, [list(parts), [p.tobytes() for p in parts.values()]])


def broadcast(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)
