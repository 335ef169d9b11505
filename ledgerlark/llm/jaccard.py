"""N-gram Jaccard join: prefix filters under several global token orders.

Two sets of a Jaccard similarity of at least ``t`` share a token among the first
``n - ceil(t * n) + 1`` of each, whatever global order the tokens are put in. So the same must
hold under every order: candidates are the pairs that share a prefix token, at a place that
still leaves room for the overlap, under one order, and pass the prefix test under the others
before their sets are compared.

The first order puts frequent tokens last, by a fixed-size sketch of all tokens' counts, so a
passage that many documents share gives few candidates. Equal sets are one class from the
start. Candidates are first taken against one leader a prefix token; links found so make
components, and then only pairs of different components are left. So a large group of near
copies costs about one comparison a member, and no link between components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ledgerlark.llm.common import U64, WordHasher, batches_of, bitmap_of, broadcast, gram_hashes, mix, portions, rows_of, written
from ledgerlark.llm.components import connected

SKETCH_BITS = 21
SKETCH_PIECE = 1 << 15
ORDERS = 3
TEXTS = 2000  # a batch: it lies in the JVM and in the worker at once


FINE, COARSE = 512, 16  # parts of a signature


def shingle_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches and, of each text, the distinct hashes of its ``n``-word shingles, ascending.

    A text of fewer words has one shingle, all of it; a text without words has none.
    """
    hasher = WordHasher()
    for part, texts in portions(batches):
        words = hasher.of(texts)
        grams, sets = gram_hashes(words.hashes, n), []
        for a, b in zip(words.starts[:-1].tolist(), words.starts[1:].tolist()):
            own = grams[a : b - n + 1] if b - a >= n else gram_hashes(words.hashes[a:b], b - a) if b > a else grams[:0]
            own = np.sort(own)
            sets.append(own[np.append(True, own[1:] != own[:-1])] if len(own) > 1 else own)
        yield part, sets


def signature(tokens: np.ndarray, parts: int) -> np.ndarray:
    """How many tokens fall on each of the parts of the hash range, 255 at most.

    These counts of two sets differ by no more than the sets do, and linked sets differ by
    (100 - percent) / (100 + percent) of their sizes at most.
    """
    counts = np.bincount((tokens & U64(parts - 1)).astype(np.int64), minlength=parts)
    return np.minimum(counts, 255).astype(np.uint8)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(64 - SKETCH_BITS)).astype(np.int64)


def levels_of(load: np.ndarray) -> np.ndarray:
    """0 for a bucket no fuller than chance has it, and one more for every doubling beyond that."""
    usual = load.mean() + 6 * np.sqrt(load.mean()) + 4
    return np.where(load > usual, 1 + np.log2(np.maximum(load, 1) / usual), 0).astype(np.uint8)


def prefix(tokens: np.ndarray, percent: int, order: int, levels: np.ndarray | None) -> np.ndarray:
    """The first tokens under a global order: by level if given, then by the order's own hash."""
    key = mix(tokens, 31 + order)
    if levels is not None:
        key = (levels[bucket(tokens)].astype(U64) << U64(58)) | (key >> U64(6))
    size = min(prefix_size(len(tokens), percent), len(tokens))
    few = np.argpartition(key, size - 1)[:size]
    return tokens[few[np.argsort(key[few])]]


def token_levels(lines: DataFrame, n: int) -> np.ndarray:
    """The level of every sketch bucket, from the counts of all shingles of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load, held, size = np.zeros(1 << SKETCH_BITS, np.uint32), [], 0
        for _, sets in shingle_sets(batches, n):
            held += [bucket(s) for s in sets]
            size += sum(map(len, sets))
            if size > 1 << 18:
                np.add.at(load, np.concatenate(held), np.uint32(1))
                held, size = [], 0
        if held:
            np.add.at(load, np.concatenate(held), np.uint32(1))
        yield packed({i: p for i, p in enumerate(load.reshape(-1, SKETCH_PIECE)) if p.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(data), np.uint32)
                held[at] = held[at] + part if at in held else part
        yield packed(held)

    schema = "piece int, data binary"
    parts = lines.select("text").mapInArrow(count, schema).repartition("piece").mapInArrow(add, schema)
    load = np.zeros(1 << SKETCH_BITS)
    for row in parts.collect():  # one row a piece: the sketch, of fixed size
        at = row["piece"] * SKETCH_PIECE
        load[at : at + SKETCH_PIECE] = np.frombuffer(zlib.decompress(row["data"]), np.uint32)
    return levels_of(load)


def packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    schema = pa.schema([("piece", pa.int32()), ("data", pa.binary())])
    return rows_of(schema, [list(parts), [zlib.compress(p.tobytes(), 1) for p in parts.values()]])


SETS_SQL = "n bigint, digest binary, low bigint, high bigint, fine binary, rare int, prefix array<bigint>"
SETS = pa.schema([
    ("n", pa.int64()), ("digest", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("fine", pa.binary()), ("rare", pa.int32()),
    ("prefix", pa.list_(pa.int64())),
])


def described(lines: DataFrame, n: int, percent: int, levels) -> DataFrame:
    """Per row: its number, ``doc`` and id, size, digest and signature of its set, and its prefix
    under the first order.

    A row's number holds only in the job that gave it: it is written with all that belongs to it.
    """
    own = ("row", "doc", "id")
    schema = StructType([*lines.select(*own).schema, *StructType.fromDDL(SETS_SQL)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in shingle_sets(batches, n):
            rows = part.column("row").to_pylist()
            first = [prefix(s, percent, 0, levels.value) if len(s) else s for s in sets]
            rare = [int((levels.value[bucket(f)] == 0).sum() * 10_000 // max(len(s), 1)) for f, s in zip(first, sets)]
            # Empty sets are equal to nothing: each has a digest of its own.
            digests = [digest(s) if len(s) else b"%d" % row for row, s in zip(rows, sets)]
            coarse = np.concatenate([signature(s, COARSE) for s in sets]).view(np.int64).reshape(-1, 2)
            found = rows_of(SETS, [
                [len(s) for s in sets], digests, coarse[:, 0], coarse[:, 1],
                [signature(s, FINE).tobytes() for s in sets], rare, [f.view(np.int64) for f in first],
            ])
            yield pa.RecordBatch.from_arrays([*map(part.column, own), *found.columns], names=schema.names)

    return lines.select(*own, "text").mapInArrow(run, schema)


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def sets_of(lines: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(id, tokens as bytes) of the classes ``wanted`` (id, digest), from the texts.

    A bitmap of fixed size tells which texts may be wanted, so only these are shuffled; a task
    sends each set once, however many copies it has.
    """
    key = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    maybe = broadcast(lines.sparkSession, bitmap_of(wanted.select(key.alias("h")), "h", bits=24))
    schema = pa.schema([("digest", pa.binary()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for _, sets in shingle_sets(batches, n):
            digests = [digest(s) for s in sets]
            keys = np.array([int.from_bytes(d[:7], "big") for d in digests], U64)
            out = [i for i in np.flatnonzero(maybe.value.has(keys)).tolist() if len(sets[i]) and digests[i] not in sent]
            out = list({digests[i]: i for i in out}.values())
            sent.update(digests[i] for i in out)
            for a in range(0, len(out), 200):
                some = out[a : a + 200]
                yield rows_of(schema, [[digests[i] for i in some], [sets[i].tobytes() for i in some]])

    found = lines.select("text").mapInArrow(run, "digest binary, tokens binary")
    return wanted.join(found, "digest").groupBy("digest", "id").agg(F.first("tokens").alias("tokens")).drop("digest")


def close_signatures(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose fine signatures do not rule a link out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, FINE).astype(np.int16)
                for c in ("of_a", "of_b")
            ]
            apart = np.abs(counts[0] - counts[1]).sum(axis=1, dtype=np.int64)
            size = batch.column("size").to_numpy()
            good = pa.array(apart * (100 + percent) <= (100 - percent) * size)
            yield rows_of(schema, [batch.column("a").filter(good), batch.column("b").filter(good)])

    ends = [sets.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"of_{x}")) for x in "ab"]
    met = pairs.join(ends[0], "a").join(ends[1], "b")
    return met.select("a", "b", "of_a", "of_b", (F.col("n_a") + F.col("n_b")).alias("size")).mapInArrow(run, "a bigint, b bigint")


def linked(pairs: DataFrame, sets: DataFrame, percent: int, levels) -> DataFrame:
    """The pairs (a, b) that share a prefix token under every order and reach the similarity."""
    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("of_a"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("of_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        for order in range(1, ORDERS):
            by = levels.value if order == 1 else None  # one more order by level, one by hash alone
            first = [prefix(s, percent, order, by) for s in (x, y)]
            if not len(np.intersect1d(*first, assume_unique=True)):
                return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                part = batch.slice(s, 200)
                x = [np.frombuffer(t, U64) for t in part.column("of_a").to_pylist()]
                y = [np.frombuffer(t, U64) for t in part.column("of_b").to_pylist()]
                ids = zip(part.column("a").to_pylist(), part.column("b").to_pylist(), x, y)
                good = [(i, j) for i, j, u, v in ids if alike(u, v)]
                if good:
                    yield rows_of(schema, [[i for i, _ in good], [j for _, j in good]])

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def postings(sets: DataFrame, gone: DataFrame) -> DataFrame:
    """(row, n, rare, at, token) of the prefix tokens that several rows may have, without the rows ``gone``.

    Tokens are counted first. Those of several rows go into a bitmap of fixed size, and only
    what it lets through is shuffled with its row; it may let others through, but drops none.
    Rows and tokens are told by the same Python step: with one for each, a task would hold two workers.
    """
    spark, sides = sets.sparkSession, told(sets, gone)
    counts = (
        kept(sets.select("row", "prefix"), sides).select(F.explode("prefix").alias("token"))
        .groupBy("token").agg(F.count("token").alias("members"))
    )
    several = broadcast(spark, bitmap_of(counts.filter("members > 1").select("token"), "token", bits=25))
    schema = pa.schema([(c, pa.int64()) for c in ("row", "n", "rare", "at", "token")])

    def chosen(held, inside: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pa.array(held.value.has(batch.column("row").to_numpy().view(U64)) == inside))
                column = batch.column("prefix")
                sizes = np.diff(column.offsets.to_numpy())
                token = column.flatten().to_numpy()
                seen = several.value.has(token.view(U64))
                of = np.repeat(np.arange(batch.num_rows), sizes)[seen]
                at = (np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[seen]
                fixed = [batch.column(c).to_numpy()[of] for c in ("row", "n", "rare")]
                yield rows_of(schema, [*fixed, at, token[seen]])

        return sets.mapInArrow(run, "row bigint, n bigint, rare bigint, at bigint, token bigint")

    doubted, wrongly, again = sides
    return written(chosen(doubted, False).unionByName(chosen(again, True).join(wrongly, "row", "left_semi")), "prefix-postings")


def told(rows: DataFrame, gone: DataFrame) -> tuple:
    """What tells the rows whose number ``row`` is not in ``gone``, next to none of which are shuffled.

    A bitmap of fixed size tells the rows that are surely left. The others are told by their
    numbers alone; of those that it took wrongly, a few, there is a table, and a bitmap as well.
    """
    spark = rows.sparkSession
    doubted = broadcast(spark, bitmap_of(gone, "row", bits=25))
    wrongly = written(rows.select("row").filter(found_in(doubted)).join(gone, "row", "left_anti"), "rows-left")
    return doubted, wrongly, broadcast(spark, bitmap_of(wrongly, "row", bits=25))


def found_in(held) -> Column:
    return F.arrow_udf(lambda row: pa.array(held.value.has(row.to_numpy().view(U64))), "boolean")("row")


def kept(rows: DataFrame, sides: tuple) -> DataFrame:
    doubted, wrongly, again = sides
    return rows.filter(~found_in(doubted)).unionByName(rows.filter(found_in(again)).join(wrongly, "row", "left_semi"))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose number ``row`` is not in ``gone``; next to none of them are shuffled.

    ``rows`` is read twice, so it must be a written table.
    """
    return kept(rows, told(rows, gone))


def room(x: str, y: str, percent: int) -> Column:
    """Whether two postings leave room for a link: sizes near enough, and at least the needed
    overlap left from either token's place on."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    left = F.least(nx - F.col(f"{x}.at"), ny - F.col(f"{y}.at"))
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (left * (100 + percent) >= percent * (nx + ny))


def coarsely_close(x: str, y: str, percent: int) -> Column:
    """Whether the coarse signatures, eight counts a long, leave a link possible."""
    apart = F.lit(0)
    for half in ("low", "high"):
        for shift in range(0, 64, 8):
            p, q = (F.shiftrightunsigned(f"{side}.{half}", shift).bitwiseAND(F.lit(255)) for side in (x, y))
            apart = apart + F.abs(p - q)
    return apart * (100 + percent) <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
    kept_only: bool = False,
) -> DataFrame:
    """Classes of documents linked by the Jaccard similarity of their ``n``-word shingles.

    Words are cut at ASCII blanks, A-Z lower-cased; a text of fewer words is one shingle. Two
    documents link if 100 * intersection >= ``percent`` * union. Returns the columns ``keep`` of ``docs`` (all
    but the text) packed in ``doc``, with ``n_shingles``, ``component_id`` (the smallest id reachable by links,
    its own included; null ids count last) and ``kept``: true for one row of each component,
    that of the smallest id, of several the first read. With ``kept_only`` only these rows come back, and what they
    keep is not shuffled. A null or empty text has no shingles
    and links with nothing; repeated rows link with each other. ``docs`` must be a table scan or a
    deterministic selection from one, since its texts are read again; rows are numbered once.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    keep = keep or [c for c in docs.columns if c != text]
    lines = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("doc"), F.col(doc_id).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    with batches_of(docs.sparkSession, TEXTS):
        return classes_of(lines, n, percent, kept_only)


def classes_of(lines: DataFrame, n: int, percent: int, kept_only: bool) -> DataFrame:
    """``near_duplicates`` of the numbered rows ``lines`` (row, doc, id, text)."""
    spark = lines.sparkSession
    levels = broadcast(spark, token_levels(lines, n))
    sets = written(described(lines, n, percent, levels), "shingle-sets")
    first = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    classes = sets.groupBy("digest").agg(F.min("row").alias("class"), F.max("n").alias("n"), F.min(first).alias("first"), F.count(F.lit(1)).alias("members"))
    classes = written(classes, "shingle-classes")

    again = sets.select("row", "digest").join(classes.filter("members > 1").select("digest", "class"), "digest")
    copies = written(again.filter("row <> class").select("row"), "class-copies")
    tokens = postings(sets.filter("n > 0").select("row", "n", "rare", "prefix"), copies)
    leaders = (
        tokens.groupBy("token").agg(F.count("row").alias("members"), F.min(F.struct("rare", "row", "n", "at")).alias("l"))
        .filter("members > 1").select("token", F.col("l.row").alias("leader"), F.col("l.n").alias("leader_n"), F.col("l.at").alias("leader_at"))
    )
    blocks = written(tokens.join(leaders, "token").select(
        "token", F.struct("row", "n", "at").alias("x"),
        F.struct(F.col("leader").alias("row"), F.col("leader_n").alias("n"), F.col("leader_at").alias("at")).alias("y"),
    ), "shingle-blocks")

    names = classes.select(F.col("class").alias("id"), "digest")

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(close_signatures(pairs, sets, percent), f"{name}-close")
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        found = written(sets_of(lines, written(names.join(ends, "id"), f"{name}-wanted"), n), f"{name}-sets")
        return written(linked(pairs, found, percent, levels), f"{name}-links")

    pair = (F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b"))
    star = blocks.filter("x.row <> y.row").filter(room("x", "y", percent)).select(*pair).distinct()
    star = written(star, "star-pairs")
    links = compared(star, "star")
    roots = connected(links)

    # A leader has met all members of its blocks; the others are left to meet each other.
    members = blocks.filter("x.row <> y.row").select("token", "x")
    placed = members.join(roots, F.col("x.row") == F.col("node"), "left")
    coarse = sets.select(F.col("row").alias("of"), "low", "high")
    placed = placed.select("token", "x", F.coalesce("root", "x.row").alias("root"))
    placed = placed.join(coarse, F.col("x.row") == F.col("of"))
    open_ = written(placed.select("token", F.struct("x.*", "root", "low", "high").alias("x")), "open-blocks")
    crossing = (
        (F.col("o.token") == F.col("p.token")) & (F.col("o.x.row") < F.col("p.x.row"))
        & (F.col("o.x.root") != F.col("p.x.root")) & room("o.x", "p.x", percent) & coarsely_close("o.x", "p.x", percent)
    )
    ends = (F.col("o.x.row").alias("a"), F.col("p.x.row").alias("b"))
    # Smaller rows first in a and b: the same order as in the first pairs.
    rest = open_.alias("o").join(open_.alias("p"), crossing).select(*ends).distinct().join(star, ["a", "b"], "left_anti")
    more = compared(written(rest, "cross-pairs"), "cross")
    roots = connected(links.union(more).union(roots.select("node", "root")))

    joined = classes.join(roots, F.col("class") == F.col("node"), "left")
    joined = joined.select("digest", "first", "members", F.coalesce("root", "class").alias("root"))
    tops = joined.groupBy("root").agg(F.min("first").alias("top"), F.sum("members").alias("rows"))
    # A row that is alone is its own component and needs no look-up.
    named = written(joined.join(tops.filter("rows > 1"), "root").select("digest", "top"), "shingle-components")
    if kept_only:
        members = sets.select("row", "digest").join(named, "digest")
        gone = written(members.filter(F.col("row") != F.col("top.row")).select("row"), "rows-gone")
        left = without(sets.select("row", "id", "doc", "n"), gone)
        # A kept row has the smallest id of its component.
        return left.select("doc", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    alone = F.col("top").isNull()
    return sets.select("row", "id", "doc", "n", "digest").join(named, "digest", "left").select(
        "doc", F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("component_id"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"),
    )
