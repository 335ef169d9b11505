"""Shards and blocks of the exact top-k: what meets where, and how much of it a task holds."""

from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import topk


def vectors_of(spark, n, dims=5, seed=3):
    r = np.random.default_rng(seed)
    return spark.createDataFrame([(i, r.normal(size=dims).round(2).tolist()) for i in range(n)], "vec_id bigint, embedding array<double>")


def test_blocks_meet_shards_without_a_join(spark, monkeypatch):
    """Blocks repeated for every shard looked small to the planner, which broadcast them: all copies passed the driver."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    df = vectors_of(spark, 400)
    want = sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 20 = 0"), k=3).collect()))

    def refused(*args, **kwargs):
        raise AssertionError("a join")

    monkeypatch.setattr(type(df), "join", refused)
    assert sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 20 = 0"), k=3).collect())) == want and len(want) == 60


@pytest.mark.parametrize("down, across", [(1, 1), (1, 4), (3, 1), (4, 3)])
def test_each_block_meets_each_shard_once(spark, down, across):
    shards, blocks = (topk.packed_groups(topk.quantised(vectors_of(spark, 80), 64, "vec_id", "embedding"), n) for n in (7, 5))
    cells = topk.in_cells(shards, blocks.selectExpr("*", "CAST(NULL AS BINARY) AS bounds"), down, across).select("cell", "kind", "number").collect()
    met = Counter((s["number"], b["number"]) for s in cells if s["kind"] == 0 for b in cells if b["kind"] == 1 and b["cell"] == s["cell"])
    assert met == Counter((s, b) for s in range(7) for b in range(5))
    assert max(Counter(s["cell"] for s in cells if s["kind"] == 0).values()) == -(-7 // down)


@pytest.mark.parametrize("most, kind", [(127, np.int8), (128, np.int16), (40_000, np.int32), (2**40, np.int64)])
def test_vectors_are_packed_in_the_smallest_type(most, kind):
    values = np.array([[-most, most], [0, 1]], np.int64)
    packed = topk.narrow(values)
    assert packed.dtype == kind and (packed == values).all()
    tree = topk.Tree(np.arange(2), packed, leaf=1)
    assert tree.low[0].tolist() == [-most, 1] and tree.high[0].tolist() == [0, most]
