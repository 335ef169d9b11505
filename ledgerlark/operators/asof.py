"""As-of lookup: the latest right row at or before each left row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.functions import join_same


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Sequence[str],
    bucket: str | None = None,
) -> DataFrame:
    """Every left row, with ``cols`` and ``right_ts`` of its as-of right row (null if none).

    ``right`` must hold one row per (by, right_ts): reduce it with ``latest_per_key`` first.

    The left side is first reduced to its distinct (by, left_ts) pairs, so the ordered
    pass sees at most one probe and one quote per key and instant, however many left rows
    share them; the answers then go back by a plain equi join, where adaptive skew handling
    applies. With dates a key has a few thousand instants at most. With timestamps give
    ``bucket`` ('day', 'hour', ...): the ordered pass then runs per (by, bucket), and the
    last quote of the earlier buckets is carried in from a one-row-per-bucket summary.
    """
    by = list(by)
    value_type = F.struct(F.col(right_ts), *[F.col(c) for c in cols])
    quotes = right.filter(F.col(right_ts).isNotNull()).select(
        *by, F.col(right_ts).alias("_t"), value_type.alias("_v"), F.lit(0).alias("_side")
    )
    null_value = F.lit(None).cast(quotes.schema["_v"].dataType)
    probes = (
        left.filter(F.col(left_ts).isNotNull())
        .select(*by, F.col(left_ts).alias("_t"))
        .distinct()
        .select(*by, "_t", null_value.alias("_v"), F.lit(1).alias("_side"))
    )
    line = probes.unionByName(quotes)
    before = (Window.unboundedPreceding, Window.currentRow)

    if bucket is None:
        w = Window.partitionBy(*by).orderBy("_t", "_side").rowsBetween(*before)
        answers = line.withColumn("_a", F.last("_v", ignorenulls=True).over(w))
    else:
        block = F.date_trunc(bucket, F.col("_t").cast("timestamp_ntz")).alias("_b")
        line = line.select("*", block)
        w_blocks = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            line.groupBy(*by, "_b")
            .agg(F.max_by("_v", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
            .withColumn("_carry", F.last("_last", ignorenulls=True).over(w_blocks))
            .drop("_last")
        )
        w = Window.partitionBy(*by, "_b").orderBy("_t", "_side").rowsBetween(*before)
        inside = line.withColumn("_in", F.last("_v", ignorenulls=True).over(w))
        answers = join_same(inside, carried, [*by, "_b"]).withColumn(
            "_a", F.coalesce("_in", "_carry")
        )

    answers = answers.filter("_side = 1").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col("_t").alias("_kt"), "_a"
    )
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(by)] + [F.col(left_ts) == F.col("_kt")]
    return left.join(answers, _all(on), "left").select(
        *[left[c] for c in left.columns],
        *[F.col(f"_a.{c}").alias(c) for c in (right_ts, *cols)],
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
