import re

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import merge


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, ticker string, v long")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_keeps_ticker_and_is_idempotent(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 2), (None, "n", 0)])
    source = frame(spark, [(2, "renamed", 20), (3, "c", 30)])
    once = merge.upsert(target, source, ["k"], ["v"])
    assert rows(once) == sorted([(1, "a", 1), (2, "b", 20), (3, "c", 30), (None, "n", 0)], key=str)
    assert rows(merge.upsert(once, source, ["k"], ["v"])) == rows(once)


def test_upsert_can_set_null(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "x", None)])
    assert rows(merge.upsert(target, source, ["k"], ["v"])) == [(1, "a", None)]


def test_null_keys_match_nothing(spark):
    target = frame(spark, [(1, "a", 1), (None, "old", 0)])
    source = frame(spark, [(None, "new", 5), (None, "new", 6), (1, "x", 2)])
    assert rows(merge.upsert(target, source, ["k"], ["v"])) == sorted(
        [(1, "a", 2), (None, "old", 0), (None, "new", 5), (None, "new", 6)], key=str
    )
    narrow = source.drop("ticker")
    assert rows(merge.upsert(target, narrow.filter("k = 1"), ["k"], ["v"])) == sorted([(1, "a", 2), (None, "old", 0)], key=str)


def test_repeated_source_key_fails_or_is_resolved(spark):
    target = frame(spark, [(1, "a", 1)])
    source = frame(spark, [(1, "x", 5), (1, "y", 7)])
    with pytest.raises(Exception, match="repeated key"):
        merge.upsert(target, source, ["k"], ["v"]).collect()
    assert rows(merge.upsert(target, source, ["k"], ["v"], dedupe_by=["v"])) == [(1, "a", 7)]


def test_insert_only(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "x", 9), (2, "b", 2)])
    assert rows(merge.insert_missing(target, source, ["k"])) == [(1, "a", 1), (2, "b", 2)]


def test_append_new_twice_is_once(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "x", 9), (2, "b", 2), (2, "c", 3)])
    fresh = merge.append_new(target, source, ["k"], ["v"])
    assert rows(fresh) == [(2, "c", 3)]
    assert merge.append_new(target.union(fresh), source, ["k"], ["v"]).count() == 0
    loose = frame(spark, [(None, "x", 1)])
    assert merge.append_new(target, loose, ["k"], ["v"]).count() == 1
    assert merge.append_new(target.union(loose), loose, ["k"], ["v"]).count() == 0
    assert tuple(merge.append_counts(target, source, ["k"]).first()) == (3, 1, 2)
    assert tuple(merge.append_counts(target.union(loose), source.union(loose), ["k"]).first()) == (4, 1, 3)
    assert tuple(merge.append_counts(target.limit(0), target.limit(0), ["k"]).first()) == (0, 0, 0)


def test_null_fields_of_a_wide_key_are_equal(spark):
    target, source = frame(spark, [(1, None, 1)]), frame(spark, [(1, None, 9), (1, "a", 5), (None, None, 3)])
    fresh = merge.append_new(target, source, ["k", "ticker"], ["v"])
    assert rows(fresh) == sorted([(1, "a", 5), (None, None, 3)], key=str)


def test_merges_read_each_side_once(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(9).select(F.col("id").alias("k"), F.lit(name).alias("ticker"), F.lit(1).alias("v")).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    for df, shuffles in (
        (merge.upsert(target, source, ["k"], ["v"]), 2),
        (merge.append_new(target, source, ["k"], ["v"]), 2),
        (merge.append_counts(target, source, ["k"]), 2),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 2 and len(re.findall(r"\bExchange hashpartitioning", text)) <= shuffles


def test_null_keys_are_scattered(spark):
    loose = spark.range(1000).selectExpr("cast(null as long) AS k", "cast(id AS string) AS ticker", "id AS v")
    assert merge.spread_null_keys(loose, ["k"]).select(merge.SALT).distinct().count() == 1000
    empty = frame(spark, [])
    assert merge.upsert(empty, loose, ["k"], ["v"]).count() == 1000
    assert merge.upsert(empty, loose, ["k"], ["v"], dedupe_by=["v"]).count() == 1000
    assert merge.insert_missing(loose, loose, ["k"]).count() == 2000
    assert tuple(merge.merge_preview(empty, loose, ["k"]).first()) == (1000, 0, 1000)


def test_preview(spark):
    target, source = frame(spark, [(1, "a", 1)]), frame(spark, [(1, "x", 9), (2, "b", 2), (3, "c", 3)])
    assert tuple(merge.merge_preview(target, source, ["k"]).first()) == (3, 1, 2)
