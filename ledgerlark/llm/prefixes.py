"""The trie of conversation prefixes, from sorted turn sequences and range minima.

A conversation is the sequence of its turns' 16-byte digests. Sequences are sorted by range over
the cluster, equal ones become one row, and neighbours get the length of their longest common prefix
(LCP). The conversations below a prefix of depth d are then the widest interval of rows around it whose
LCPs are all at least d. Each candidate prefix finds both ends on its own: a sparse table has
the least LCP of every span of a power of two rows, and a binary search doubles its way out. Every
other figure of a node is a difference of running sums over its interval.

Sorted rows are cut into blocks of bounded size. A block knows the last row before it and the first
one after it, so that every prefix is new in one block only and the parts of a node that spans
several blocks can simply be added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.llm.common import rows_of, written

WIDTH = 16  # bytes of a turn's digest
BLOCK_CELLS = 250_000  # prefixes a block should hold
SEARCH_CELLS = 1 << 17  # candidates that search at once
IDS_A_PIECE = 100_000
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

MARKS = "array<struct<digest:string,words:bigint>>"


def turn_marks(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a conversation: ``conv_id, marks``, a digest of role and text and the words of each turn.

    In the order of ``turn``, null first; turns of one number are ordered by digest. A null role or text counts
    as empty. Rows without a conversation id belong to none and are left out; a repeated row is a repeated
    turn. Texts are not shuffled: of each turn 16 bytes and its number of words remain.
    """
    role, text = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    entry = F.struct(
        F.col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words")
    )
    whole = turns.filter(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).cast("bigint").alias("conv_id"))
    ordered = whole.agg(F.sort_array(F.collect_list(entry)).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("marks"))


def shared_openings(marked: DataFrame, group: int, turns: Column, most: int) -> DataFrame:
    """Conversations that open with the first ``turns`` turns of the first one of their group of ids.

    Conversation c takes these (all, if fewer) of conversation c - c % ``group``, none if it is absent, then
    its own turns after as many. ``turns`` is an expression over ``conv_id`` of at most ``most``.
    """
    nothing = F.array().cast(MARKS)
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = marked.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first"), F.slice("marks", 1, most).alias("head")
    )
    met = marked.select("conv_id", "marks", first.alias("first"), turns.cast("int").alias("h")).join(heads, "first", "left")
    opening = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))
    rest = F.slice("marks", F.col("h") + 1, F.greatest(F.size("marks") - F.col("h"), F.lit(0)))
    return met.select("conv_id", F.concat(opening, rest).alias("marks"))


SEQUENCE = "key binary, conv_id bigint, n bigint, ids string, words array<bigint>"
SEQUENCE_ARROW = pa.schema([
    ("key", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ids", pa.string()), ("words", pa.list_(pa.int64()))
])


def pieces_of_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal sequences as rows with up to 100,000 comma-joined ids; rows come sorted by key and id."""
    key, words, ids = None, None, []

    def row() -> list:
        return [key, ids[0], len(ids), ",".join(map(str, ids)), words]

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("key", "conv_id", "words")]
        for k, i, w in zip(*columns):
            if ids and (k != key or len(ids) == IDS_A_PIECE):
                out.append(row())
                ids = []
            key, words = k, w
            ids.append(i)
        if out:
            yield rows_of(SEQUENCE_ARROW, [list(c) for c in zip(*out)])
    if ids:
        yield rows_of(SEQUENCE_ARROW, [[c] for c in row()])


DISTINCT = "block int, key binary, conv_id bigint, n bigint, ends string, words array<bigint>"
DISTINCT_ARROW = pa.schema([
    ("block", pa.int32()), ("key", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string()),
    ("words", pa.list_(pa.int64())),
])


def distinct_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of equal sequences, in the order of their ids, as one row with the hash over all ids.

    The hash is fed piece by piece, so no group is ever held.
    """
    last, ends = None, None

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("block", "key", "conv_id", "n", "ids", "words")]
        for block, key, conv_id, n, ids, words in zip(*columns):
            if last is not None and key == last[1]:
                last[3] += n
                ends.update(b"," + ids.encode())
                continue
            if last is not None:
                out.append([*last[:4], ends.hexdigest(), last[4]])
            last, ends = [block, key, conv_id, n, words], hashlib.sha256(ids.encode())
        if out:
            yield rows_of(DISTINCT_ARROW, [list(c) for c in zip(*out)])
    if last is not None:
        yield rows_of(DISTINCT_ARROW, [[c] for c in (*last[:4], ends.hexdigest(), last[4])])


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two sequences share at their beginning."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // WIDTH
    x, y = np.frombuffer(a, np.uint8, size), np.frombuffer(b, np.uint8, size)
    return int((x != y).argmax()) // WIDTH


class SparseTable:
    """The least value of every span of a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(half[:-step], half[step:]))

    def least(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The minimum from ``begin`` to ``end``, both included."""
        level = np.frexp((end - begin + 1).astype(np.float64))[1] - 1
        out = np.empty(len(begin), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.levels[k][begin[at]], self.levels[k][end[at] - (1 << k) + 1])
        return out

    def reach(self, start: np.ndarray, floor: np.ndarray, forward: bool) -> np.ndarray:
        """How far one can go from each ``start`` over values that are all at least ``floor``."""
        at, size = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            step = 1 << k
            begin = at if forward else at - step
            room = (begin + step <= size) & (begin >= 0)
            go = np.zeros(len(at), bool)
            go[room] = self.levels[k][begin[room]] >= floor[room]
            at[go] += step if forward else -step
        return at


class Block:
    """Sorted distinct sequences, with what is next to them on either side (None: nothing)."""

    def __init__(self, keys: list[bytes], ids, copies, ends: list[str], words: list[list[int]], before, after):
        m = len(keys)
        self.keys, self.ends = keys, ends
        self.ids, self.copies = np.array(ids, np.int64), np.array(copies, np.int64)
        self.size = np.array([len(k) // WIDTH for k in keys], np.int64)
        self.lcp = np.array([-1 if before is None else common_turns(before, keys[0])]
                            + [common_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)
        self.after = -1 if after is None else common_turns(keys[-1], after)
        # Cell begin[i] + d is the prefix of row i with d turns.
        self.begin = np.concatenate([[0], np.cumsum(self.size + 1)])
        self.row = np.repeat(np.arange(m), self.size + 1)
        self.depth = np.arange(self.begin[-1]) - self.begin[self.row]
        said = np.zeros(self.begin[-1], np.int64)
        said[self.depth > 0] = np.concatenate([np.array(w, np.int64) for w in words]) if self.size.any() else 0
        running = np.cumsum(said)
        self.upto = running - running[self.begin[self.row]]  # words of a prefix

    def extents(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last row of the block below each candidate prefix."""
        table, n = SparseTable(self.lcp[1:]), len(self.row)
        left, right = np.empty(n, np.int64), np.empty(n, np.int64)
        for a in range(0, n, SEARCH_CELLS):
            b = a + SEARCH_CELLS
            left[a:b] = table.reach(self.row[a:b], self.depth[a:b], forward=False)
            right[a:b] = table.reach(self.row[a:b], self.depth[a:b], forward=True)
        return left, right

    def nodes(self) -> dict:
        """The part of every node that lies in this block, as columns."""
        m, row, depth, begin = len(self.keys), self.row, self.depth, self.begin
        left, right = self.extents()
        owned = np.flatnonzero(left == row)
        i, d, r = row[owned], depth[owned], right[owned]

        def sums(values: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(values)])

        def within(running: np.ndarray) -> np.ndarray:
            return running[r + 1] - running[i]

        whole = self.upto[begin[1:] - 1]
        shared = np.maximum(self.lcp, 0)
        fresh = whole - self.upto[begin[:-1] + shared]  # words of the prefixes that are new in a row
        following = np.append(self.lcp[1:], self.after)
        n_convs = within(sums(self.copies))
        above = np.maximum(d - 1, 0)
        own_new = whole[i] - self.upto[begin[i] + np.maximum(above, shared[i])]
        later_new = sums(fresh)[r + 1] - sums(fresh)[i + 1]
        said = within(sums(self.copies * whole)) - n_convs * self.upto[begin[i] + above]

        parent = np.full(len(row), -1)  # cell where the parent's interval begins
        below = depth > 0
        parent[below] = begin[left[np.flatnonzero(below) - 1]] + depth[below] - 1
        is_new = below & (depth > self.lcp[row])
        children = np.bincount(parent[is_new], minlength=len(row))

        is_open = ((left == 0) & (self.lcp[0] >= depth)) | ((right == m - 1) & (self.after >= depth))
        least = np.zeros(len(row), np.int64)
        least[owned] = SparseTable(self.ids).least(i, r)
        up = parent[owned]
        known = (up >= 0) & ~is_open[up]
        names: dict[int, bytes] = {}

        def name(cell: int) -> bytes:
            if cell not in names:
                names[cell] = hashlib.md5(self.keys[row[cell]][: WIDTH * depth[cell]]).digest()
            return names[cell]

        return {
            "node": [name(c) if is_open[c] else None for c in owned.tolist()],
            "parent": [name(c) if c >= 0 and is_open[c] else None for c in up.tolist()],
            "conv_id": least[owned],
            "depth": d,
            "parent_conv_id": pa.array(least[up], pa.int64(), mask=~known),
            "n_convs": n_convs,
            "n_children": children[owned],
            "n_leaves": within(sums((following < self.size).astype(np.int64))),
            "saved_tokens": said - own_new - later_new,
            "ends_sha256": [self.ends[x] if n == self.size[x] else None for x, n in zip(i.tolist(), d.tolist())],
        }


NODE = (
    "node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
NODE_ARROW = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
])
NODE_ROWS = 20_000


def nodes_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each block; rows come sorted by block and key, neighbours of a block marked -1 and 1."""

    def finish(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        before = next((r[1] for r in rows if r[6] < 0), None)
        after = next((r[1] for r in rows if r[6] > 0), None)
        _, keys, ids, copies, ends, words, _ = zip(*(r for r in rows if r[6] == 0))
        found = Block(list(keys), ids, copies, list(ends), list(words), before, after).nodes()
        n = len(found["depth"])
        for a in range(0, n, NODE_ROWS):
            yield rows_of(NODE_ARROW, [found[f.name][a : a + NODE_ROWS] for f in NODE_ARROW])

    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("block", "key", "conv_id", "n", "ends", "words", "side")]
        for r in zip(*columns):
            if held and held[0][0] != r[0]:
                yield from finish(held)
                held = []
            held.append(r)
    if held:
        yield from finish(held)


def prefix_trie(marked: DataFrame) -> DataFrame:
    """The nodes of the trie over ``marked`` (conv_id, marks), see :func:`turn_marks`.

    A node is a distinct sequence of first turns, from the root without turns; conversations that begin with
    it are its members, one without turns is a member of the root. Returns ``conv_id`` (the smallest
    member), ``depth, parent_conv_id`` (the parent's, null for the root), ``n_convs, n_children, n_leaves`` (childless nodes of
    the subtree, itself included), ``saved_tokens`` (over the subtree: members less one, times the words of the
    node's last turn) and ``ends_sha256`` (over the comma-joined ids, ascending, of members that end here). Ids
    must be unique. Without conversations there are no nodes. Equal conversations, however many, are one row in the
    search; their ids pass a hash piece by piece. A conversation's digests must fit a row. The list of blocks, two
    sequences each, passes one task.
    """
    key = F.unhex(F.array_join(F.transform("marks", lambda m: m["digest"]), ""))
    lines = written(marked.select(key.alias("key"), "conv_id", F.transform("marks", lambda m: m["words"]).alias("words")), "turn-sequences")
    ordered = lines.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    copies = written(ordered.mapInArrow(pieces_of_copies, SEQUENCE), "sequence-pieces")
    cells = copies.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    n_blocks = max(1, -(-cells // BLOCK_CELLS))
    sorted_pieces = copies.repartitionByRange(n_blocks, "key").sortWithinPartitions("key", "conv_id")
    numbered = sorted_pieces.withColumn("block", F.spark_partition_id())
    rows = written(numbered.mapInArrow(distinct_sequences, DISTINCT), "sequences")

    edges = rows.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    line = Window.orderBy("block")
    beside = edges.select(
        "block", F.lag("last").over(line).alias("before"), F.lead("first").over(line).alias("after")
    )

    def neighbours(column: str, side: int) -> DataFrame:
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (("conv_id", "bigint"), ("n", "bigint"), ("ends", "string"), ("words", "array<bigint>"))]
        return beside.filter(F.col(column).isNotNull()).select("block", F.col(column).alias("key"), *nothing, F.lit(side).alias("side"))

    blocks = rows.withColumn("side", F.lit(0)).unionByName(neighbours("before", -1)).unionByName(neighbours("after", 1))
    whole = blocks.repartition("block").sortWithinPartitions("block", "key")
    parts = written(whole.mapInArrow(nodes_of_blocks, NODE), "trie-parts")

    # Nodes of several blocks are added up; there are at most the prefixes of two rows a block.
    figures = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    spanning = parts.filter("node IS NOT NULL").groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("parent_conv_id").alias("parent_conv_id"), *figures, F.max("ends_sha256").alias("ends_sha256"),
    )
    merged = written(spanning, "trie-spanning")
    all_nodes = parts.filter("node IS NULL").unionByName(merged)
    named = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("_up"))
    looked_up = all_nodes.filter("parent IS NOT NULL").join(named, "parent", "left").withColumn("parent_conv_id", F.col("_up"))
    out = all_nodes.filter("parent IS NULL").unionByName(looked_up.drop("_up"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
