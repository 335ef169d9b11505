"""A stream gives what the batch gives on the same rows."""

from pyspark.sql import functions as F

from ledgerlark.plans import model
from ledgerlark.session import fresh_path
from ledgerlark.streaming import monitor


def events(spark, rows):
    df = spark.createDataFrame(rows, "id long, service string, severity string, at string")
    return df.select("id", "service", "severity", F.col("at").cast("timestamp").alias("ts"))


def test_five_minutes_of_errors_alert(spark):
    rows = [(i, "s", "ERROR", f"2025-01-01 00:0{i}:30") for i in range(6)] + [(9, "s", "INFO", "2025-01-01 00:06:30")]
    rates = monitor.error_rate(events(spark, rows), F.col("severity") == "ERROR", by=["service"])
    assert {r["errors"] for r in rates.collect()} == {1} and rates.first()["rate"] == 1 / 60
    held = monitor.sustained_breach(rates, by=["service"]).orderBy("breach_start").collect()
    assert [str(r["breach_start"]) for r in held] == ["2025-01-01 00:00:00", "2025-01-01 00:01:00"]
    assert [r["errors"] for r in held] == [5, 5]


def test_a_quiet_minute_breaks_the_alert(spark):
    rows = [(i, "s", "ERROR", f"2025-01-01 00:0{i}:30") for i in (0, 1, 3, 4, 5)]
    rates = monitor.error_rate(events(spark, rows), F.col("severity") == "ERROR")
    assert monitor.sustained_breach(rates).count() == 0


def test_stream_equals_batch_over_many_files(spark, sf_dir):
    source = fresh_path(spark, "event-files")
    table = model.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    table.repartitionByRange(4, "ts").write.parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    error = F.col("event_type") == "error"

    def held(df):
        rates = monitor.error_rate(df, error, window="6 hours", delay="40 days")
        return monitor.sustained_breach(rates, slots=2, window="6 hours", hold="12 hours")

    # A closing event far ahead moves the watermark past every window.
    closing = table.limit(1).withColumns({"ts": F.lit("2025-06-01").cast("timestamp"), "event_type": F.lit("error")})
    closing.write.mode("append").parquet(source)
    out = fresh_path(spark, "held")
    monitor.run_to_end(held(stream), f"{out}/data", f"{out}/checkpoint")
    got = spark.read.parquet(f"{out}/data")
    want = held(table).filter("breach_end < '2025-01-01'")
    assert want.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_dedupe_is_the_same_in_batch(spark):
    df = events(spark, [(1, "s", "x", "2025-01-01"), (1, "s", "x", "2025-01-01"), (2, "s", "x", "2025-01-01")])
    assert monitor.dedupe(df, ["id"]).count() == 2


def test_no_late_row_is_lost(spark, sf_dir):
    source, out = fresh_path(spark, "shuffled-events"), fresh_path(spark, "once")
    table = model.table(spark, sf_dir, "events")
    table.unionByName(table).repartition(4).write.parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    monitor.append_once(stream, ["event_id"], "ts", f"{out}/data", f"{out}/checkpoint")
    got = spark.read.parquet(f"{out}/data").select(*table.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, table.collect()))


def test_a_folder_streams_like_a_file(spark, sf_dir, tmp_path):
    from ledgerlark.plans import streams

    table = model.table(spark, sf_dir, "events")
    table.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "events.parquet"))
    one, many = (streams.error_rate_stream(spark, d) for d in (sf_dir, str(tmp_path)))
    assert one.count() > 0 and sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
