"""Exact top-k by inner product: a KD-tree per shard, searched best first.

Rows are dealt to shards of bounded size. A shard's tree halves its rows at the median of the
widest dimension; every node has a tight box, and no row of a box scores higher for a query
than the box's corner does. Blocks of queries meet every shard in the cells of a grid: a task holds the trees of
some shards and lets some blocks pass by, so that blocks travel once for many shards and nothing is joined.
In a first pass each query looks into the best leaf of a tree only; the highest k-th score over the cells is a bound
that no answer may fall below, and is carried to all shards for the second pass, which visits boxes from the best
downwards and drops those below the bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.llm.common import batches_of, rows_of, written

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 512, 128
# A cell of the grid of shards and blocks: shards and bytes of them that a task holds, searches it makes; how many cells there are at least.
HELD, HELD_BYTES, SEARCHES, CELLS = 32, 1 << 28, 1 << 14, 24
BATCH = 8  # packed rows sent to Python at once


def quantised(vectors: DataFrame, scale: float, vec_id: str, vector: str) -> DataFrame:
    """(row, vec_id, dim, vec): floor(scale * component) as 64-bit integers, packed.

    Vectors that are null or hold a null or non-finite component, and rows without an id, are
    left out. A component beyond 2**53 after scaling is refused, as sums would not be exact.
    """
    lines = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"),
    ).filter("vec_id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            rows, ids, dims, packed = batch.column("row").to_pylist(), batch.column("vec_id").to_pylist(), [], []
            out = []
            for i in range(batch.num_rows):
                v = flat[ends[i] : ends[i + 1]]
                if np.isfinite(v).all():
                    v = np.floor(scale * v)
                    if len(v) and np.abs(v).max() > 2**53:
                        raise ValueError(f"vector {ids[i]}: a component is too large to be scored exactly")
                    out.append(i)
                    dims.append(len(v))
                    packed.append(v.astype(np.int64).tobytes())
            yield rows_of(schema, [[rows[i] for i in out], [ids[i] for i in out], dims, packed])

    return lines.mapInArrow(run, "row bigint, vec_id bigint, dim int, vec binary")


class Tree:
    """Rows of a shard in the order of the leaves, with the boxes of all nodes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS):
        self.children: list[tuple[int, int] | None] = []
        self.span: list[tuple[int, int]] = []
        low, high, order = [], [], np.arange(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            part = rows[order[a:b]]
            node = len(self.span)
            self.span.append((a, b))
            low.append(part.min(axis=0).astype(np.int64))  # rows may be of a small type
            high.append(part.max(axis=0).astype(np.int64))
            self.children.append(None)
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            wide = high[-1] - low[-1]
            if b - a > leaf and len(wide) and wide.max() > 0:
                d, half = int(wide.argmax()), (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, d], half)]
                todo += [(a, a + half, node, 0), (a + half, b, node, 1)]
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high = np.array(low), np.array(high)
        self.leaves = np.array([i for i, c in enumerate(self.children) if c is None])


def largest(values: np.ndarray) -> float:
    return float(max(int(values.max(initial=0)), -int(values.min(initial=0))))


def exact_type(queries: np.ndarray, rows: np.ndarray) -> type:
    """The cheapest number type whose products and sums are exact here."""
    most = largest(queries) * largest(rows) * max(queries.shape[1], 1)
    if most >= 2**62:
        raise ValueError("scores do not fit into 64 bits")
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


class Block:
    """A block of queries and what the shards before have for it."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, least: np.ndarray | None = None):
        self.ids, self.queries = ids, queries
        self.least = np.full(len(ids), -np.inf) if least is None else least.copy()  # no answer scores below
        self.found = [(np.empty(0), np.empty(0, np.int64))] * len(ids)


class Search:
    """One block of queries in one shard."""

    def __init__(self, tree: Tree, block: Block, k: int):
        kind = exact_type(block.queries, tree.rows)
        self.tree, self.k, self.ids = tree, k, block.ids
        self.queries, self.rows = block.queries.astype(kind), tree.rows.astype(kind)
        up, down = np.maximum(self.queries, 0), np.minimum(self.queries, 0)
        self.bound = up @ tree.high.T.astype(kind) + down @ tree.low.T.astype(kind)
        self.least, self.found = block.least, block.found

    def look(self, node: int, active: np.ndarray) -> None:
        """Score the rows of a leaf for the active queries and keep what may be in the answer."""
        a, b = self.tree.span[node]
        scores = self.queries[active] @ self.rows[a:b].T
        scores = np.where(self.tree.ids[a:b] == self.ids[active][:, None], -np.inf, scores.astype(np.float64))
        for i in np.flatnonzero(scores.max(axis=1) >= self.least[active]).tolist():
            q = active[i]
            at = np.flatnonzero((scores[i] >= self.least[q]) & (scores[i] > -np.inf))
            value = np.concatenate([self.found[q][0], scores[i][at]])
            names = np.concatenate([self.found[q][1], self.tree.ids[a:b][at]])
            best = np.lexsort((names, -value))[: self.k]
            self.found[q] = (value[best], names[best])
            if len(best) == self.k:
                self.least[q] = max(self.least[q], value[best[-1]])

    def first_leaves(self) -> None:
        best = self.tree.leaves[self.bound[:, self.tree.leaves].argmax(axis=1)]
        for leaf in np.unique(best):
            self.look(int(leaf), np.flatnonzero(best == leaf))

    def best_first(self) -> None:
        """Nodes from the highest bound of any query that still needs them."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            active = np.flatnonzero(self.bound[:, node] >= self.least)
            if not len(active):
                continue
            if self.tree.children[node] is None:
                self.look(node, active)
            else:
                for child in self.tree.children[node]:
                    heapq.heappush(heap, (-float(self.bound[active, child].max()), child))


PACKED = "dim int, number int, n int, ids binary, rows binary, width int, vecs binary"
PACKED_ARROW = pa.schema([
    ("dim", pa.int32()), ("number", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("width", pa.int32()), ("vecs", pa.binary()),
])


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = largest(values)
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def packed_groups(rows: DataFrame, groups: int) -> DataFrame:
    """One row a group, of bounded size by the number of ``groups``: ids, rows and vectors, packed; vectors in the smallest type."""
    number = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("number")
    pairs = F.sort_array(F.collect_list(F.struct("vec_id", "row", "vec")))
    listed = rows.groupBy("dim", number).agg(pairs.alias("p")).select(
        "dim", "number", F.col("p.vec_id").alias("ids"), F.col("p.row").alias("rows"), F.col("p.vec").alias("vecs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, number = batch.column("dim")[i].as_py(), batch.column("number")[i].as_py()
                ids, own = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "rows"))
                vecs = narrow(np.frombuffer(b"".join(batch.column("vecs")[i].as_py()), np.int64))
                yield rows_of(PACKED_ARROW, [[x] for x in (dim, number, len(ids), ids.tobytes(), own.tobytes(), vecs.itemsize, vecs.tobytes())])

    return listed.mapInArrow(run, PACKED)


def numbers(batch: pa.RecordBatch, name: str, i: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_py(), kind)


def matrix(batch: pa.RecordBatch, i: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[batch.column("width")[i].as_py()]
    return numbers(batch, "vecs", i, kind).reshape(batch.column("n")[i].as_py(), batch.column("dim")[i].as_py())


def in_cells(shards: DataFrame, blocks: DataFrame, down: int, across: int) -> DataFrame:
    """Shards and after them blocks, in the cells of a grid in which each shard meets each block once.

    A shard is in one of ``down`` lines, a block in one of ``across`` columns; each travels once for every cell of it.
    """
    line = F.pmod("number", F.lit(down)) * across
    nothing = F.lit(None).cast("binary")
    there = shards.withColumns({"rows": nothing, "bounds": nothing}).select("*", F.lit(0).alias("kind"), F.explode(F.sequence(line, line + across - 1)).alias("cell"))
    column = F.pmod("number", F.lit(across))
    asked = blocks.select("*", F.lit(1).alias("kind"), F.explode(F.sequence(column, column + F.lit(across * (down - 1)), F.lit(across))).alias("cell"))
    dealt = there.unionByName(asked).repartition(2 * down * across, "cell")
    return dealt.sortWithinPartitions("cell", "kind", "dim", "number")


FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"
FOUND_ARROW = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
BOUNDS = "dim int, number int, bounds binary"
BOUNDS_ARROW = pa.schema([("dim", pa.int32()), ("number", pa.int32()), ("bounds", pa.binary())])


def searched(batches: Iterator[pa.RecordBatch], k: int, search: Callable[[Search], None]) -> Iterator[tuple[Block, pa.RecordBatch, int]]:
    """Each block after all shards of its cell; the shards of a cell come first and are held, one tree each."""
    cell, trees = None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            if cell != (cell := batch.column("cell")[i].as_py()):
                trees = {}
            dim = batch.column("dim")[i].as_py()
            if batch.column("kind")[i].as_py() == 0:
                trees.setdefault(dim, []).append(Tree(numbers(batch, "ids", i), matrix(batch, i)))
            elif dim in trees:
                least = None if batch.column("bounds")[i].as_py() is None else numbers(batch, "bounds", i, np.float64)
                block = Block(numbers(batch, "ids", i), matrix(batch, i), least)
                for tree in trees[dim]:
                    search(Search(tree, block, k))
                yield block, batch, i


def bounded(blocks: DataFrame, bounds: DataFrame) -> DataFrame:
    """Blocks with the highest of their bounds; what belongs to a block meets in its task, without a join."""
    columns = blocks.columns
    own = blocks.select("*", F.lit(None).cast("binary").alias("bounds"))
    lines = own.unionByName(bounds, allowMissingColumns=True).repartition("dim", "number").sortWithinPartitions("dim", "number", F.col("vecs").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = None, None

        def ended() -> Iterator[pa.RecordBatch]:
            if block is not None:
                yield pa.RecordBatch.from_arrays([*block.columns[:-1], pa.array([None if least is None else least.tobytes()], pa.binary())], schema=block.schema)

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("vecs")[i].is_valid:
                    yield from ended()
                    block, least = batch.slice(i, 1), None
                else:
                    own = numbers(batch, "bounds", i, np.float64)
                    least = own if least is None else np.maximum(least, own)
        yield from ended()

    return lines.select(*columns, "bounds").mapInArrow(run, f"{PACKED}, bounds binary")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each query's ``k`` highest integer inner products: ``query_id, rank, vec_id, score``.

    Vectors are turned into floor(``scale`` * component). Candidates are all rows of ``vectors`` of
    the query's length with another id; ties go to the smaller id. A query id that occurs in
    several rows of ``queries`` is answered once a row, a candidate that does is a candidate once a row; answers of fewer
    than ``k`` rows are whole. Null or non-finite vectors and null ids take no part; empty tables
    give no rows.
    """
    spark = vectors.sparkSession
    stored = written(quantised(vectors, scale, vec_id, vector), "vectors")
    asked = written(quantised(queries, scale, vec_id, vector), "queries")
    there, widest = stored.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(0))).first()
    n_shards, n_blocks = max(1, -(-there // SHARD_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    held = max(1, min(HELD, HELD_BYTES // (8 * SHARD_ROWS * max(widest, 1)), n_shards // 12))
    down = -(-n_shards // held)
    across = min(n_blocks, max(-(-CELLS // down), -(-held * n_blocks // SEARCHES)))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch, i in searched(batches, k, Search.first_leaves):
            own = [batch.column(c)[i].as_py() for c in ("dim", "number")]
            yield rows_of(BOUNDS_ARROW, [[x] for x in (*own, block.least.tobytes())])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch, i in searched(batches, k, Search.best_first):
            sizes = [len(f[0]) for f in block.found]
            if sum(sizes):
                yield rows_of(FOUND_ARROW, [
                    np.repeat(numbers(batch, "rows", i), sizes), np.repeat(block.ids, sizes),
                    np.concatenate([f[1] for f in block.found]),
                    np.concatenate([f[0] for f in block.found]).astype(np.int64),
                ])

    with batches_of(spark, BATCH):
        shards = written(packed_groups(stored, n_shards), "vector-shards")
        blocks = written(packed_groups(asked, n_blocks), "query-blocks")
        unbound = blocks.withColumn("bounds", F.lit(None).cast("binary"))
        bounds = written(in_cells(shards, unbound, down, across).mapInArrow(first, BOUNDS), "query-bounds")
        ready = written(bounded(blocks, bounds), "bounded-blocks")
        found = written(in_cells(shards, ready, down, across).mapInArrow(second, FOUND), "answers")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
