"""Properties of the plans: what they must not contain, and what must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerlark.operators import portfolio, prices
from ledgerlark.plans import QUERIES, model

# Queries that run jobs while they are built.
EAGER = {"csv_typed_scan", "file_atomic_load", "file_report", "manifest_scan", "ndjson_scan", "csv_infer_scan",
         "positional_csv", "fact_append_roundtrip", "merge_partitions", "dim_date_roundtrip", "table_roundtrip",
         "incremental_file_ingest", "landed_files", "daily_pipeline", "snapshot_store", "history_increments", "merge_files", "ingest_counts", "fact_chosen_days", "transactions_load", "error_rate_stream", "sustained_breach_stream", "stream_dedupe"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(queries()["symbol_universe"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(p_size,5\)", text)
    assert "p_retailprice" not in text
    lines = plan(queries()["holdings_asof"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^]]*LessThan\w*\(o_orderdate", lines)
    assert "o_totalprice" not in lines and "l_extendedprice" not in lines


def test_latest_row_is_reduced_before_the_shuffle(spark, sf_dir):
    ticks = model.ticks(spark, sf_dir)
    text = plan(prices.latest_per_key(ticks, ["asset_key"], ["snapshot_date", *model.TICK_ORDER]))
    assert "partial_max_by" in text and "Window" not in text


def test_text_and_page_rows_do_not_shuffle(spark, sf_dir):
    for name in ("section_rows", "pattern_rows", "page_links", "page_first_link", "page_class_links", "payload_gate",
                 "payload_quarantine", "json_field"):
        assert "Exchange" not in plan(queries()[name](spark, sf_dir)), name


def test_running_totals_scan_the_lines_twice(spark, sf_dir):
    text = queries()["holdings_running"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("l_linenumber") and len(re.findall(r"Relation \[[^]]*l_partkey", text)) <= 2


def test_moving_cost_shuffles_only_what_it_returns(spark, sf_dir):
    for name in ("cost_basis_moving", "cost_basis_moving_desk"):
        text = queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_tax" not in "".join(line for line in text.splitlines() if "Relation" not in line), name


def test_running_totals_shuffle_the_rows_of_a_block_once(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("user_id"), F.lit(1).alias("asset_key"), F.lit("d").alias("day"), "id")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(portfolio.running_total(rows, portfolio.POSITION, ["id"], F.col("id"), "total", [F.col("day")]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # One of the rows; of the sums one for their total, one for their window, one for the join.
    assert text.count("Exchange hashpartitioning") <= 4


def test_moving_cost_shuffles_a_trade_by_its_block_once(spark, sf_dir):
    for name in ("cost_basis_moving", "cost_basis_moving_desk"):
        df = queries()[name](spark, sf_dir)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("concat_ws") == 1, name  # a trade's name, made last
        df.collect()
        text = plan(df).partition("Initial Plan")[0]
        assert len(re.findall(r"[-+] Exchange hashpartitioning\(_block.*REPARTITION_BY_COL", text)) == 1, name
        assert len(re.findall(r"ReusedExchange .*hashpartitioning\(_block", text)) >= 2, name
