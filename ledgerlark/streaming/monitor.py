"""Windowed error rate, sustained-breach alert and de-duplication, batch and stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerlark.operators.merge import append_new

# Alignment period, hold time and threshold of the alert.
ALIGNMENT, HOLD, THRESHOLD = "60 seconds", "300 seconds", 0


def error_rate(
    events: DataFrame,
    is_error: Column,
    ts: str = "ts",
    by: Sequence[str] = (),
    window: str = ALIGNMENT,
    delay: str = "10 minutes",
) -> DataFrame:
    """Errors and errors per second in tumbling windows, windows without errors left out.

    Works on a stream as on a table; on a stream, rows later than ``delay`` are dropped.
    """
    errors = events.filter(is_error)
    if errors.isStreaming:
        errors = errors.withWatermark(ts, delay)
    bucket = F.window(ts, window)
    counted = errors.groupBy(bucket, *by).agg(F.count(F.lit(1)).alias("errors"))
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counted.withColumn("rate", F.col("errors") / seconds)


def sustained_breach(
    rates: DataFrame,
    by: Sequence[str] = (),
    slots: int = 5,
    window: str = ALIGNMENT,
    hold: str = HOLD,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Hold periods all of whose ``slots`` windows breach the threshold.

    ``rates`` is the output of :func:`error_rate`; ``hold`` must be ``slots`` windows long. In a table every
    breaching window is numbered, with a running sum of errors: a period is held if the numbers of its first and
    last window differ by ``slots`` less one, so that its length costs nothing and the two meet by
    their times. A stream copies each window into the periods that it is part of.
    """
    breaching = rates.filter(F.col("rate") > threshold)
    if breaching.isStreaming:
        span = F.window(F.window_time("window"), hold, window)
        held = breaching.groupBy(span, *by).agg(
            F.count(F.lit(1)).alias("slots"), F.sum("errors").alias("errors")
        )
        return held.filter(F.col("slots") == slots).select(
            *by,
            F.col("window.start").alias("breach_start"),
            F.col("window.end").alias("breach_end"),
            "errors",
        )
    numbered = _numbered(breaching, by)
    key = F.struct(*by, F.col("window.start").alias("at")) if by else F.struct(F.col("window.start").alias("at"))
    step = F.make_dt_interval(secs=F.lit(slots - 1) * (F.unix_timestamp("window.end") - F.unix_timestamp("window.start")))
    back = F.struct(*by, (F.col("window.start") - step).alias("at"))
    first = numbered.select(
        key.alias("_k"), F.col("window.start").alias("breach_start"), F.col("_n").alias("_first"),
        (F.col("_sum") - F.col("errors")).alias("_before"),
    )
    last = numbered.select(*by, back.alias("_k"), F.col("window.end").alias("breach_end"), "_n", "_sum")
    met = last.join(first, "_k").filter(F.col("_n") - F.col("_first") == slots - 1)
    return met.select(*by, "breach_start", "breach_end", (F.col("_sum") - F.col("_before")).alias("errors"))


def _numbered(rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Windows with their number ``_n`` and the running sum of errors ``_sum``, in the order of time.

    Days are numbered and summed first, so no task sorts more than a day of a group, or its days.
    """
    cut = rates.select("*", F.to_date("window.start").alias("_day"), F.struct(*by).alias("_by") if by else F.lit(0).alias("_by"))
    block = F.struct("_by", "_day").alias("_block")
    totals = cut.groupBy(block).agg(F.count(F.lit(1)).alias("_count"), F.sum("errors").alias("_errors"))
    earlier = Window.partitionBy("_block._by").orderBy("_block._day").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(
        "_block",
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_errors").over(earlier), F.lit(0)).alias("_sum0"),
    )
    inside = Window.partitionBy("_block").orderBy("window.start")
    local = cut.select("*", block).select(
        "*", F.row_number().over(inside).alias("_i"), F.sum("errors").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_e")
    )
    running = local.join(opening, "_block").withColumns({"_n": F.col("_n0") + F.col("_i"), "_sum": F.col("_sum0") + F.col("_e")})
    return running.select(*rates.columns, "_n", "_sum")


def count_windows(
    stream: DataFrame, is_error: Column, path: str, checkpoint: str, ts: str = "ts", by: Sequence[str] = (), window: str = ALIGNMENT
) -> None:
    """Run a stream into a table of window counts that holds open windows as well, and late rows whenever they come.

    A micro-batch adds the errors it has seen of each window in partitions (day, batch) of its own and
    overwrites only these, so a batch repeated after a lost driver counts once. Counts of a window add up over the
    batches (:func:`window_rates`): there is no state to keep, and no row is too late.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        counted = batch.filter(is_error).groupBy(F.window(ts, window), *by).agg(F.count(F.lit(1)).alias("errors"))
        (
            counted.select("*", F.to_date("window.start").alias("day"), F.lit(batch_id).cast("bigint").alias("batch"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)
        )

    stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def window_rates(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rates of :func:`error_rate` from the table of :func:`count_windows`."""
    counted = counts.groupBy("window", *by).agg(F.sum("errors").alias("errors"))
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counted.withColumn("rate", F.col("errors") / seconds)


def dedupe(events: DataFrame, keys: Sequence[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop re-delivered rows by key; on a stream, copies that arrive within ``delay``."""
    if events.isStreaming:
        return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return events.dropDuplicates(list(keys))


def append_once(stream: DataFrame, keys: Sequence[str], ts: str, path: str, checkpoint: str) -> None:
    """Run a stream into a table that holds every key once, however late a row comes.

    A micro-batch adds the rows that the days it touches do not hold yet, so a key must come
    back with its own time. It writes partitions (day, batch) of its own and overwrites only these: a
    batch repeated after a lost driver leaves no duplicate. Nothing is dropped for being late.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("day", F.to_date(ts))
        stored = T.StructType([*dated.schema.fields, T.StructField("batch", T.LongType())])
        held = spark.read.schema(stored).parquet(path).filter(F.col("batch") != batch_id)
        touched = held.join(dated.select("day").distinct(), "day", "left_semi")
        fresh = append_new(touched, dated, keys, dedupe_by=[ts])
        (
            fresh.withColumn("batch", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)
        )

    jvm = stream.sparkSession.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(stream.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over everything that is there, into an exactly-once file sink."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
