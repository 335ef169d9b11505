"""Mix sources to target weights by hash thresholds, without sorting the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.llm.common import written

BLANK_RUN = r"[^\x20\x09-\x0D]+"
DIGITS, LEVELS = 3, 5  # hex digits of the hash a level looks at: 4,096 buckets a source


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(BLANK_RUN)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``sources`` (source, size) with ``target``: shares of the whole size by weight.

    Weights repeat over the sources in code-point order, null last. No target exceeds ``most``
    times its source; the excess goes to the others by weight. That settles at the level
    where ``min(most * size, level * weight)`` adds up to the whole: the sources that stop are
    those of the smallest ``size / weight``, so one pass in that order finds it. The input has
    one row a source, the only rows here that meet in one task.
    """
    if most < 1:
        raise ValueError("targets cannot reach the whole size if most is below 1")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place - 1) % len(weights) + 1)
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    # The level if the sources before this one stop; it holds at the first that does not.
    levels = ranked.withColumn("level", level)
    open_ = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("cap") / F.col("weight")))
    settled = levels.withColumn("settled", open_.over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.coalesce(F.col("settled") * F.col("weight"), F.col("cap")))
    return settled.select("source", "size", "weight", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: float = 3,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Every row of ``docs`` with its size, its source's size and target, and the words taken.

    A target of 2.3 times the source takes every row twice and, for the rest, the rows whose
    hash lies below the source's threshold. The threshold is found in a histogram of the sizes
    by source and leading hash digits: the bucket in which the running sum passes the budget
    is refined by the next digits, and only its rows are read again. The rows at the last
    threshold are taken if that comes nearer to the budget.

    The hash covers id and text, so reruns agree and rows that are alike in both are taken
    alike. A null text has size 0, a null source is a source of its own. No row is taken more
    than ``ceil(most)`` times. Returns ``doc`` (the row without its text), ``size, source_size,
    target, taken``; an empty table gives no rows.
    """
    whole = F.concat_ws("\x1f", F.col(doc_id).cast("string"), F.col(text).cast("string"))
    rest = [c for c in docs.columns if c != text]
    lines = written(
        docs.select(
            F.struct(*rest).alias("doc"), F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"), F.substring(F.md5(whole), 1, DIGITS * LEVELS).alias("hash"),
        ), "mix-sizes",
    )
    sources = lines.groupBy("source").agg(F.sum("size").alias("size"))
    aims = targets(sources, weights, most)
    times = F.floor(F.col("target") / F.col("size"))
    budget = F.col("target") - times * F.col("size")
    state = written(
        aims.filter("size > 0").select(
            F.col("source").alias("of"), F.col("size").alias("source_size"), "target", times.alias("times"),
            budget.alias("budget"), F.lit("").alias("prefix"), F.lit(0).cast("long").alias("below"),
            F.lit(0).cast("long").alias("at"),
        ), "mix-targets",
    )
    inside = lines.filter("size > 0")
    for level in range(1, LEVELS + 1):
        state, inside = refined(state, inside, level)
    nearer = F.col("below") + F.col("at") - F.col("budget") < F.col("budget") - F.col("below")
    limit = state.withColumn("whole_bucket", nearer)
    joined = lines.join(limit, F.col("source").eqNullSafe(F.col("of")), "left")
    below = (F.col("hash") < F.col("prefix")) | ((F.col("hash") == F.col("prefix")) & F.col("whole_bucket"))
    return joined.select(
        "doc", "size", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce(F.col("size") * (F.col("times") + below.cast("long")), F.lit(0)).cast("long").alias("taken"),
    )


def refined(state: DataFrame, inside: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(thresholds one level finer, the rows of their buckets)."""
    # The second key is each source's own bucket, so a large source is spread at level 1 by
    # partial sums and holds a 4,096th of its rows after it.
    own = state.select("of", "prefix")
    if level > 1:
        same = F.col("source").eqNullSafe(F.col("of")) & (F.substring("hash", 1, DIGITS * (level - 1)) == F.col("prefix"))
        inside = inside.join(own, same, "left_semi")
        inside = written(inside, f"mix-bucket-{level}")
    bucket = F.substring("hash", 1, DIGITS * level)
    sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
    running = sums.withColumn("upto", upto)
    found = (
        state.join(running, F.col("source").eqNullSafe(F.col("of")))
        .filter(F.col("below") + F.col("upto") > F.col("budget"))
        .groupBy("of")
        .agg(F.min_by(F.struct("bucket", "n", "upto"), "bucket").alias("first"))
    )
    joined = state.join(found.withColumnRenamed("of", "found_of"), F.col("of").eqNullSafe(F.col("found_of")), "left")
    new = joined.select(
        "of", "source_size", "target", "times", "budget",
        F.coalesce("first.bucket", "prefix").alias("prefix"),
        (F.col("below") + F.coalesce(F.col("first.upto") - F.col("first.n"), F.lit(0))).alias("below"),
        F.coalesce("first.n", "at").alias("at"),
    )
    return written(new, f"mix-threshold-{level}"), inside
