"""Queries over the event log, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.plans import model
from ledgerlark.plans.registry import query
from ledgerlark.session import fresh_path
from ledgerlark.streaming import monitor


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with instants, which event-time windows need."""
    return model.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _event_stream(spark: SparkSession, sf_dir: str, files_a_batch: int | None = None) -> DataFrame:
    """The table be it a file or a folder: a glob reads either.

    Files of a folder come in no order of time, so aggregates with a watermark take all that
    is there as one batch; a later run adds what came since.
    """
    schema = model.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).options(**({"maxFilesPerTrigger": files_a_batch} if files_a_batch else {}))
    stream = stream.parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _windows(rates: DataFrame, *cols: str) -> DataFrame:
    bounds = [F.col(f"window.{e}").cast("timestamp_ntz").alias(f"window_{e}") for e in ("start", "end")]
    return rates.select(*cols, *bounds, "errors", "rate")


MINUTES = """
SELECT user_id, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS errors, count(*) / 60.0::DOUBLE AS rate
FROM events WHERE event_type = 'error' GROUP BY ALL"""


@query(MINUTES)
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = monitor.error_rate(_events(spark, sf_dir), F.col("event_type") == "error", by=["user_id"])
    return _windows(rates, "user_id")


def _error_windows(spark: SparkSession, sf_dir: str, window: str, *by: str) -> DataFrame:
    """Rates from a stream of several micro-batches, the events dealt to files in no order of time."""
    out, error = fresh_path(spark, "windows"), F.col("event_type") == "error"
    events = _events(spark, sf_dir)
    events.repartition(4, "event_id").write.parquet(f"{out}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/events")
    monitor.count_windows(stream, error, f"{out}/data", f"{out}/checkpoint", by=by, window=window)
    return monitor.window_rates(spark.read.parquet(f"{out}/data"), by)


@query(MINUTES)
def error_rate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rates from a stream, open windows included."""
    return _windows(_error_windows(spark, sf_dir, monitor.ALIGNMENT, "user_id"), "user_id")


HOURS = """
hours AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1
),
breaches AS (
  SELECT a.h AS breach_start, a.h + INTERVAL 5 HOUR AS breach_end, CAST(sum(b.errors) AS BIGINT) AS errors
  FROM hours s JOIN (SELECT DISTINCT h - INTERVAL (k) HOUR AS h FROM hours, range(5) r(k)) a ON s.h = a.h
  JOIN hours b ON b.h >= a.h AND b.h < a.h + INTERVAL 5 HOUR
  GROUP BY a.h HAVING count(*) = 5
)"""


def _held(rates: DataFrame) -> DataFrame:
    held = monitor.sustained_breach(rates, slots=5, window="1 hour", hold="5 hours")
    return held.select(model.ntz("breach_start"), model.ntz("breach_end"), "errors")


@query(f"WITH {HOURS} SELECT * FROM breaches")
def sustained_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _held(monitor.error_rate(_events(spark, sf_dir), F.col("event_type") == "error", window="1 hour"))


@query(f"WITH {HOURS} SELECT * FROM breaches")
def sustained_breach_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts over the window table that a stream keeps."""
    return _held(_error_windows(spark, sf_dir, "1 hour"))


@query("""WITH slots AS (
  SELECT user_id % 3 AS service, time_bucket(INTERVAL 6 HOUR, ts) AS h, count(*) AS errors
  FROM events WHERE event_type = 'error' GROUP BY ALL
),
numbered AS (SELECT *, h - INTERVAL 6 HOUR * row_number() OVER (PARTITION BY service ORDER BY h) AS run FROM slots),
held AS (
  SELECT service, h, errors, count(*) OVER w AS n, CAST(sum(errors) OVER w AS BIGINT) AS errors_held
  FROM numbered WINDOW w AS (PARTITION BY service, run ORDER BY h ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
)
SELECT service, h - INTERVAL 18 HOUR AS breach_start, h + INTERVAL 6 HOUR AS breach_end, errors_held AS errors FROM held WHERE n = 4""")
def sustained_breach_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hold of a whole day for each service."""
    events = _events(spark, sf_dir).withColumn("service", F.col("user_id") % 3)
    rates = monitor.error_rate(events, F.col("event_type") == "error", by=["service"], window="6 hours")
    held = monitor.sustained_breach(rates, by=["service"], slots=4, window="6 hours", hold="1 day")
    return held.select("service", model.ntz("breach_start"), model.ntz("breach_end"), "errors")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice, in any order, through a stream that keeps each once."""
    out = fresh_path(spark, "deduped")
    events = _event_stream(spark, sf_dir, 1).select("event_id", "ts", "user_id", "event_type", "value")
    delivered = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    monitor.append_once(delivered, ["event_id"], "ts", f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data").drop("day", "batch").withColumn("ts", model.ntz("ts"))
