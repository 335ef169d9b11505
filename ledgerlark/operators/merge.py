"""Upsert, insert-only merge, idempotent append and the dry-run count."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.operators.prices import latest_per_key


def unique_source(
    source: DataFrame, keys: Sequence[str], dedupe_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The merge source with one row per key.

    With ``dedupe_by`` the greatest row wins; without it a repeated key fails the job, as a
    warehouse MERGE does when several source rows match one target row.
    """
    if dedupe_by is not None:
        return latest_per_key(source, keys, dedupe_by)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return source.withColumn("_n", n).filter(_once("_n", keys)).drop("_n")


def _once(n: str, keys: Sequence[str]) -> Column:
    """True where ``n`` is 1; fails the job with the key elsewhere."""
    repeated = F.concat(F.lit("merge source has a repeated key: "), F.to_json(F.struct(*keys)))
    return F.when(F.col(n) == 1, F.lit(True)).otherwise(F.raise_error(repeated).cast("boolean"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    dedupe_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The target after a MERGE: matched rows take ``update_cols``, others are inserted.

    Each side is read once. Rows with a null key match nothing: they are kept or inserted as
    they are, and :func:`spread_null_keys` scatters them over the tasks. The test for repeated
    keys is a window with the join's own distribution and order, so that nothing is shuffled
    or sorted twice. With ``dedupe_by`` the source is an aggregate; its rows with a null key
    are then a second, filtered read of the source.
    """
    on_keys = [*keys, SALT]
    if dedupe_by is None:
        salted = spread_null_keys(source, keys)
        counted = F.count(F.lit(1)).over(Window.partitionBy(*on_keys))
        src = salted.withColumn("_n", F.when(F.col(SALT) == 0, counted).otherwise(1)).filter(_once("_n", keys)).drop("_n")
    else:
        loose = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        best = latest_per_key(source.filter(~loose), keys, dedupe_by).select(*source.columns)
        src = spread_null_keys(best.unionByName(source.filter(loose)), keys)
    t = spread_null_keys(target, keys).withColumn("_old", F.lit(True)).alias("t")
    s = src.withColumn("_hit", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on_keys]
    hit, old = F.col("s._hit").isNotNull(), F.col("t._old").isNotNull()
    out = []
    for c in target.columns:
        if c not in src.columns:
            out.append(F.col(f"t.{c}").alias(c))
        elif c in update_cols:
            out.append(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return t.join(s, on, "full_outer").select(*out)


SALT = "_salt"


def spread_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_salt``: 0 where all keys are set, else a hash of the row.

    Joined on as one more key it changes no match, since a null key has none, but rows that
    would all meet in the task of the null key are scattered.
    """
    loose = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    cells = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.withColumn(SALT, F.when(loose, F.xxhash64(*cells)).otherwise(F.lit(0).cast("bigint")))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after an insert-only MERGE."""
    have = spread_null_keys(target.select(*keys), keys)
    fresh = spread_null_keys(source, keys).join(have, [*keys, SALT], "left_anti")
    return target.unionByName(fresh.drop(SALT))


def append_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedupe_by: Sequence[str | Column],
) -> DataFrame:
    """The source rows an idempotent append would add: one per key, none already present.

    Of a key's rows the greatest by ``dedupe_by`` counts. Null keys are equal here, so that a
    second run adds nothing either: the keys are packed into one struct, whose null fields
    compare as equal. The source is reduced by that struct first and joined on it, so that one
    shuffle serves both and a key of many rows is one row in the join.
    """
    packed = source.select("*", F.struct(*keys).alias("_key"))
    once = latest_per_key(packed, ["_key"], dedupe_by, keep=source.columns)
    have = target.select(F.struct(*keys).alias("_key"))
    return once.join(have, "_key", "left_anti").select(*source.columns)


def merge_preview(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many source rows a merge would update and how many it would insert."""
    have = spread_null_keys(target.select(*keys).distinct(), keys).withColumn("_hit", F.lit(True))
    hit = F.col("_hit").isNotNull()
    return spread_null_keys(source, keys).join(have, [*keys, SALT], "left").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(hit).alias("would_update"),
        F.count_if(~hit).alias("would_insert"),
    )


def append_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows staged, rows an idempotent append adds, and rows in the table afterwards.

    One pass over each side: both are counted per key, and a key that only the source has adds
    one row. Null keys are equal, as in :func:`append_new`.
    """

    def tally(df: DataFrame, here: int) -> DataFrame:
        return df.select(*keys, F.lit(here).cast("bigint").alias("_old"), F.lit(1 - here).cast("bigint").alias("_new"))

    both = tally(target, 1).unionByName(tally(source, 0))
    by_key = both.groupBy(*keys).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    added = F.count_if(F.col("_old") == 0)
    return by_key.agg(
        F.coalesce(F.sum("_new"), F.lit(0)).alias("rows_staged"),
        added.alias("rows_inserted"),
        (F.coalesce(F.sum("_old"), F.lit(0)) + added).alias("rows_total"),
    )
