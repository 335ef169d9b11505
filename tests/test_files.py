import json
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F, types as T

from ledgerlark.functions import split_list
from ledgerlark.operators import portfolio
from ledgerlark.plans import files as plans_files
from ledgerlark.schemas import BATCH_RECORD, TABLES
from ledgerlark.sinks import file_table, tables
from ledgerlark.sources import files, landing
from ledgerlark.streaming.ingest import IngestPaths, ingest_new_files

HEADER = "timestamp,open,high,low,close,volume,ticker_symbol,exchange_name,country,is_adjusted\n"


def line(day, price="1.5", ticker="AAPL"):
    return f"{day},{price},2.5,0.5,1.75,100,{ticker},NASDAQ,US,false\n"


def land(folder: Path, **contents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in contents.items():
        (folder / f"{name}.csv").write_text(text)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_only_whole_good_files_load(spark, tmp_path, threshold, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    raw = tmp_path / "raw"
    land(
        raw,
        good=HEADER + line("2025-01-02") + line("2025-01-03"),
        bad=HEADER + line("2025-01-02") + line("2025-01-03", "n/a"),
        short=HEADER + "2025-01-02,1.5\n",
        error='{\n "Information": "limit reached"\n}\n',
        empty=HEADER,
    )
    rows, report = files.load_files_atomic(spark, str(raw))
    status = {Path(r[files.FILE]).stem: (r["status"], r["lines"], r["bad_lines"]) for r in report.collect()}
    assert status == {
        "good": ("loaded", 2, 0),
        "bad": ("rejected", 2, 1),
        "short": ("rejected", 1, 1),
        "error": ("rejected", 2, 2),
        "empty": ("loaded", 0, 0),
    }
    assert rows.count() == 2 and rows.agg(F.max("close")).first()[0] == 1.75
    # The verdict does not depend on which columns the caller reads.
    assert rows.select("ticker_symbol").count() == 2


def test_expected_files_that_are_missing_are_reported(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, good=HEADER + line("2025-01-02"), other=HEADER + line("2025-01-02"))
    expected = spark.createDataFrame([(f"file://{raw}/good.csv",), (f"file://{raw}/gone.csv",)], "uri string")
    rows, report = files.load_files_atomic(spark, str(raw), expected=expected)
    status = {Path(r[files.FILE]).stem: r["status"] for r in report.collect()}
    assert status == {"good": "loaded", "gone": "missing"} and rows.count() == 1


def test_typed_scan_is_strict(spark, tmp_path):
    land(tmp_path, bad=HEADER + line("2025-01-02", "n/a"))
    with pytest.raises(Exception, match="MALFORMED"):
        files.scan_prices_csv(spark, str(tmp_path)).collect()


def test_manifest_document_and_missing_manifest(spark, tmp_path):
    listing = {"symbol": "A", "country": "US", "exchange": "N"}
    doc = {"run_date": "2025-10-20", "mode": "daily", "extracted_at": "x",
           "results": {"success": [{**listing, "gcs_uri": "u/a.csv"}], "failed": [listing], "total": 2}}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    got = landing.scan_manifest(spark, str(tmp_path / "m.json")).collect()
    assert [tuple(r) for r in got] == [("2025-10-20", "daily", "A", "US", "N", "u/a.csv")]
    assert landing.scan_manifest(spark, str(tmp_path / "none.json")).count() == 0


def test_written_manifest(spark, tmp_path):
    rows = [("2025-01-02", "daily", f"s{i}", "US", "N", f"u{i}" if i % 2 else None) for i in range(10)]
    status = spark.createDataFrame(rows, "run_date string, mode string, symbol string, country string, exchange string, uri string")
    path = str(tmp_path / "manifest")
    tables.write_manifest(status, path, F.lit("2025-01-02T10:00:00"), n_documents=4)
    docs = spark.read.json(path)
    assert docs.count() > 1 and {r[0] for r in docs.select("results.total").collect()} == {10}
    assert docs.select(F.explode("results.failed")).count() == 5
    got = landing.scan_manifest(spark, path, layout="lines")
    assert sorted(r["uri"] for r in got.collect()) == sorted(f"u{i}" for i in range(10) if i % 2)


def test_batches_count_what_they_insert(spark, tmp_path):
    paths = IngestPaths(*[str(tmp_path / p) for p in ("raw", "facts", "reports", "checkpoint")], files_a_batch=2)
    raw = Path(paths.landing)
    land(raw / "one", a=HEADER + line("2025-01-02") + line("2025-01-03"), bad=HEADER + line("2025-01-02", "n/a"), bare=HEADER)
    counts = ingest_new_files(spark, paths)
    assert [c.files for c in counts] == [2, 1] and sum(c.inserted for c in counts) == 2
    assert sum(c.bytes for c in counts) == sum(f.stat().st_size for f in raw.rglob("*.csv"))
    assert ingest_new_files(spark, paths) == []
    land(raw / "two", worse=HEADER + line("2025-01-02", "n/a"))
    assert [tuple(c)[1:] for c in ingest_new_files(spark, paths)] == [(1, (raw / "two" / "worse.csv").stat().st_size, 0)]


def test_chosen_days_read_their_partitions_only(spark, tmp_path):
    """Files of all other days are no Parquet: the join fails if it reads one."""
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 30).cast("int"))
    fact = spark.range(300).select((F.col("id") % 7).alias("asset_key"), day.alias("snapshot_date"), "id")
    path, dates = str(tmp_path / "fact"), str(tmp_path / "dates")
    tables.append_fact(fact, path)
    fact.select(F.col("snapshot_date").alias("full_date"), F.dayofweek("snapshot_date").alias("day_of_week")).distinct().coalesce(1).write.parquet(dates)
    for file in Path(path).rglob("*.parquet"):
        if file.parent.name not in {f"snapshot_date=2025-01-{d:02}" for d in (6, 13, 20, 27)}:
            file.write_text("no parquet" * 5000)  # a fact is larger than its days, so the days are what is broadcast
    stored = spark.read.schema("asset_key long, id long, snapshot_date date").parquet(path)
    days = spark.read.schema("full_date date, day_of_week int").parquet(dates).filter("day_of_week = 2")
    found = portfolio.enrich_chosen_days(stored, fact.select("asset_key").distinct(), days, "snapshot_date")
    assert "dynamicpruning" in found._jdf.queryExecution().toString()
    assert sorted(r["id"] for r in found.collect()) == [i for i in range(300) if i % 30 in (5, 12, 19, 26)]


def test_incremental_ingest(spark, tmp_path):
    paths = IngestPaths(*[str(tmp_path / p) for p in ("raw", "facts", "reports", "checkpoint", "archive")])
    raw = Path(paths.landing)

    def run():
        ingest_new_files(spark, paths, F.lit("2025-01-05 00:00:00"))
        return spark.read.parquet(paths.facts).count()

    land(raw / "one", a=HEADER + line("2025-01-02") + line("2025-01-03"), bad=HEADER + line("2025-01-02", "n/a"), bare=HEADER)
    assert run() == 2
    assert run() == 2
    land(raw / "two", b=HEADER + line("2025-01-04"))
    assert run() == 3
    reports = spark.read.parquet(paths.reports)
    assert {Path(r[files.FILE]).stem: r["status"] for r in reports.collect()} == {"a": "loaded", "bad": "rejected", "b": "loaded", "bare": "loaded"}
    assert {p.stem for p in raw.rglob("*.csv")} == {"bad"}
    assert {str(p.relative_to(paths.archive)) for p in Path(paths.archive).rglob("*.csv")} == {"one/a.csv", "one/bare.csv", "two/b.csv"}
    fact = spark.read.parquet(paths.facts).filter("snapshot_date = '2025-01-04'").first()
    assert (fact["data_source"], fact["is_adjusted"], float(fact["close_price"])) == ("alphavantage", False, 1.75)


@pytest.mark.parametrize("kind", sorted(TABLES))
def test_tables_are_created_once(spark, tmp_path, kind):
    name = f"t_{kind}"
    for _ in range(2):
        tables.ensure_table(spark, name, kind, str(tmp_path / kind))
    schema, partitions, _ = TABLES[kind]
    assert set(spark.table(name).columns) == set(schema.fieldNames())
    assert {c.name for c in spark.catalog.listColumns(name) if c.isPartition} == set(partitions)
    spark.sql(f"DROP TABLE {name}")


def test_append_fact_layout_and_counts(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.range(40).select((F.col("id") % 10).alias("asset_key"),
                                F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") / 10).cast("int")).alias("snapshot_date"))
    tables.append_fact(df.filter("asset_key < 5"), path)
    counts = tables.append_observed(spark, df, path, ["asset_key", "snapshot_date"], "snapshot_date", ["asset_key"])
    assert counts == {"staged": 40, "inserted": 20}
    assert tables.append_observed(spark, df, path, ["asset_key", "snapshot_date"], "snapshot_date", ["asset_key"])["inserted"] == 0
    assert spark.read.parquet(path).count() == 40
    assert len(list(Path(path).glob("snapshot_date=*"))) == 4
    one = spark.read.parquet(path).filter("snapshot_date = date'2025-01-02'")
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().toString()


def test_partition_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.createDataFrame([(1, 1, "2025-01-01"), (2, 2, "2025-01-01"), (1, 3, "2025-01-02")], "asset_key long, v long, d string")
    df = df.select("asset_key", "v", F.col("d").cast("date").alias("snapshot_date"))
    tables.append_fact(df, path)
    untouched = {p.name for p in Path(path, "snapshot_date=2025-01-02").iterdir()}
    change = spark.sql("select 1L asset_key, 10L v, date'2025-01-01' snapshot_date union all select 3L, 30L, date'2025-01-01'")
    tables.upsert_partitions(spark, change, path, ["asset_key", "snapshot_date"], ["v"], "snapshot_date")
    got = sorted((r["asset_key"], r["v"], str(r["snapshot_date"])) for r in spark.read.parquet(path).collect())
    assert got == [(1, 3, "2025-01-02"), (1, 10, "2025-01-01"), (2, 2, "2025-01-01"), (3, 30, "2025-01-01")]
    assert {p.name for p in Path(path, "snapshot_date=2025-01-02").iterdir()} == untouched


def test_a_merge_rewrites_only_files_with_a_match(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.range(60).select("id", (F.col("id") % 6).cast("int").alias("part"), F.col("id").alias("v"))
    file_table.create(df.filter("id < 57"), path, "part", ["id"])
    before = file_table.files(spark, path)
    assert {n.split("/")[0] for n in before} == {f"part={i}" for i in range(6)}
    change = spark.sql("select 8L id, 2 part, 80L v union all select 58L, 4, 580L union all select cast(null as long), 1, 7L")
    report = file_table.merge_files(spark, change, path, ["part", "id"], ["v"], "part")
    assert {n.split("/")[0] for n in report["rewritten"]} == {"part=2"} and {n.split("/")[0] for n in report["new"]} == {"part=1", "part=2", "part=4"}
    assert set(report["kept"]) == {n for n in before if "part=2" not in n} and set(report["kept"]) < set(file_table.files(spark, path))
    got = {r["id"]: r["v"] for r in file_table.read(spark, path).collect()}
    assert got == {i: i for i in range(57)} | {8: 80, 58: 580, None: 7}
    assert file_table.version(spark, path) == 2 and file_table.files(spark, path, at=1) == before
    assert file_table.read(spark, path, file_table.files(spark, path, at=1)).count() == 57
    none = file_table.merge_files(spark, change.filter("id = 0"), path, ["part", "id"], ["v"], "part")
    assert not none["rewritten"] and not none["new"]


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.sql("select 1 part, 1 v")
    file_table.create(df, path, "part", ["v"])
    with pytest.raises(Exception, match="already exists"):
        file_table._commit(spark, path, 1, ["other"])


def test_files_are_narrow_in_both_cluster_columns(spark, tmp_path):
    import pyarrow.parquet as pq

    n, path = 40_000, str(tmp_path / "fact")
    df = spark.range(n).select(
        F.lit("2025-01-01").cast("date").alias("snapshot_date"), F.format_string("user%04d", F.xxhash64("id") % 500 + 500).alias("user_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("asset_key"),
    )
    bounds = tables.cluster_bounds(df, ["user_id", "asset_key"], 16)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = Observation()
        tables.append_fact(df, path, cluster=["user_id", "asset_key"], bounds=bounds, cells=16, observation=seen)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert seen.get["inserted"] == n == spark.read.parquet(path).count()
    ranges = {"user_id": [], "asset_key": []}
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                if column.path_in_schema in ranges:
                    ranges[column.path_in_schema].append((column.statistics.min, column.statistics.max))
    assert len(ranges["asset_key"]) >= 8
    for column, value in (("asset_key", 123), ("user_id", "user0700")):
        hit = sum(low <= value <= high for low, high in ranges[column])
        assert hit <= len(ranges[column]) / 2, (column, hit, len(ranges[column]))


def test_ranks_interleave(spark):
    rows = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x long, y long")
    z = tables.interleaved([tables.quantile_rank(rows, c, [1, 2, 3]) for c in ("x", "y")], 2)
    got = {(r["x"], r["y"]): r["z"] for r in rows.select("*", z.alias("z")).collect()}
    assert sorted(got.values()) == list(range(16))
    assert [got[p] for p in ((0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0), (3, 3))] == [0, 1, 2, 3, 4, 8, 15]
    names = spark.createDataFrame([("",), ("a",), ("ab",), ("b",), ("é",), (None,)], "s string")
    numbers = [r[0] for r in names.select(tables.ordered_number(names, "s")).collect()]
    assert numbers[:5] == sorted(numbers[:5]) and len(set(numbers[:5])) == 5 and numbers[5] is None


def test_a_fact_is_written_from_one_read(spark, tmp_path):
    count = spark.sparkContext.accumulator(0)
    source = spark.range(1000).select(F.col("id").alias("asset_key"), F.lit("2025-01-01").cast("date").alias("snapshot_date"))

    def look(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b

    tables.append_fact(source.mapInArrow(look, source.schema), str(tmp_path / "fact"))
    assert count.value == 1000


def test_transactions_export(spark, tmp_path):
    header = ",".join(["transaction_id", "user_id", "asset_key", "transaction_timestamp", "transaction_date",
                       "transaction_type", "quantity", "price_per_unit", "commission", "currency_code", "notes",
                       "source", "created_at", "synced_at"])

    def row(i, kind="BUY", quantity="10", asset="1"):
        return f"t{i},u,{asset},2025-01-02T10:00:00Z,2025-01-02,{kind},{quantity},5.5,0.1,USD,,IMPORT,,"

    lines = [header, row(1), row(2, kind="GIFT"), row(3, quantity="0"), row(4, quantity="many"), row(5, asset="")]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, rejected = files.load_transactions(spark, str(tmp_path))
    assert [r["transaction_id"] for r in good.collect()] == ["t1"]
    assert good.select("transaction_id").count() == 1
    reasons = {r["transaction_id"]: r["reject_reason"] for r in rejected.collect()}
    assert reasons == {"t2": "invalid_type", "t3": "invalid_quantity", "t4": "corrupt_line", "t5": "missing_asset_key"}


def test_raw_csv_and_ndjson_round_trip(spark, tmp_path):
    rows = [("US", "N", "A", 1, 1.5), ("US", "N", "B", 2, None)]
    df = spark.createDataFrame(rows, "country string, exchange string, symbol string, volume long, close double")
    tables.write_raw_csv(df, str(tmp_path / "csv"), ["country", "exchange", "symbol"])
    assert (tmp_path / "csv" / "country=US" / "exchange=N" / "symbol=A").is_dir()
    back = spark.read.option("header", True).schema("volume long, close double, country string, exchange string, symbol string")
    assert sorted(r["symbol"] for r in back.csv(str(tmp_path / "csv")).collect()) == ["A", "B"]
    tables.write_ndjson(df, str(tmp_path / "json"))
    lines = [json.loads(t) for p in (tmp_path / "json").glob("*.json") for t in p.read_text().splitlines()]
    assert {"country": "US", "exchange": "N", "symbol": "B", "volume": 2, "close": None} in lines
    assert files.scan_ndjson(spark, str(tmp_path / "json"), df.schema).count() == 2


def test_positional_and_inferred_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("AAPL,42.0,US,2025-06-10\n")
    row = files.scan_positional_csv(spark, str(tmp_path / "p.csv"), BATCH_RECORD).first()
    assert (row["ticker"], row["price"], str(row["date"])) == ("AAPL", 42.0, "2025-06-10")
    (tmp_path / "i.csv").write_text("date_key,is_weekend,holiday_markets\n20250101,false,US|AR\n20250102,false,\n")
    df = files.scan_csv_infer(spark, str(tmp_path / "i.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "boolean", "string"]
    assert [r[0] for r in df.select(split_list("holiday_markets")).collect()] == [["US", "AR"], []]


def test_a_daily_run_lands_packs_not_a_file_a_symbol(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(plans_files, "fresh_path", lambda _, name: f"{tmp_path}/{name}")
    n = plans_files.daily_pipeline(spark, sf_dir).count()
    landed = list((tmp_path / "daily" / "landed").rglob("*.csv"))
    assert n > 8 >= len(landed)


def test_members_of_a_pack_are_loaded_or_left_out_alone(spark, tmp_path):
    (tmp_path / "pack.csv").write_text("n,own\n1,a b\n2,a b\nx,c\n3,c\n4,d\n")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("own", T.StringType())])
    where = f"file:{tmp_path}/pack.csv#"
    expected = spark.createDataFrame([(where + "a b",), (where + "c",), (where + "e",)], "uri string")
    rows, report = files.load_files_atomic(spark, str(tmp_path / "pack.csv"), schema, expected, "own")
    assert sorted(r["n"] for r in rows.collect()) == [1, 2]
    got = {r[files.FILE].rsplit("#", 1)[1]: r["status"] for r in report.collect()}
    assert got == {"a%20b": "loaded", "c": "rejected", "e": "missing"}
