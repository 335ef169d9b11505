"""Queries over listings, prices, validation and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.functions import asset_key, parse_locale_number, parse_report_date
from ledgerlark.functions import split_list as split_items
from ledgerlark.operators import merge, prices, quality
from ledgerlark.operators.bonds import BOND_KEY_SUFFIX
from ledgerlark.plans import model
from ledgerlark.plans.registry import query

FACT_KEYS = ["asset_key", "snapshot_date", "data_source"]


@query(f"""WITH {model.ASSETS}
SELECT DISTINCT ticker_symbol, exchange_country, exchange_code FROM assets
WHERE exchange_country = 'US' AND is_active AND asset_type IN ('STOCK', 'ETF')""")
def symbol_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.symbol_universe(model.assets(spark, sf_dir))


@query(f"""WITH {model.TICKS}
SELECT asset_key, snapshot_date, close_price, volume FROM ticks
QUALIFY row_number() OVER (PARTITION BY asset_key
  ORDER BY snapshot_date DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1""")
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["snapshot_date", *model.TICK_ORDER]
    last = prices.latest_per_key(model.ticks(spark, sf_dir), ["asset_key"], order)
    return last.select("asset_key", "snapshot_date", "close_price", "volume")


@query(f"WITH {model.STAGED} {model.PRICE_FACT}")
def price_fact_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_wall_clock(prices.to_price_fact(model.staged_prices(spark, sf_dir), model.ingested_at()))


@query(f"""SELECT p_partkey, {model.KEY_SQL.format("p_name || '|' || p_brand")} AS listing_key,
  {model.KEY_SQL.format("p_name || '|byma'")} AS bond_key,
  {model.KEY_SQL.format("nullif(p_type, 'SMALL') || '|' || p_brand")} AS nullable_key FROM part""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.table(spark, sf_dir, "part").select(
        "p_partkey",
        asset_key("p_name", "p_brand").alias("listing_key"),
        asset_key("p_name", suffix=BOND_KEY_SUFFIX).alias("bond_key"),
        asset_key(F.nullif("p_type", F.lit("SMALL")), "p_brand").alias("nullable_key"),
    )


# --- validation ----------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as four-element JSON records; some nations' records are broken."""
    nation, text = F.col("c_nationkey"), F.lit
    ticker = F.when(nation == 7, text('"  "')).when(nation == 8, text("7")).otherwise(
        F.concat(text('"'), F.col("c_name"), text('"'))
    )
    price = (
        F.when(nation == 11, text('"abc"'))
        .when(nation == 12, text('" 1e3 "'))
        .when(nation == 13, text("true"))
        .when(nation == 14, text('"1.5f"'))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    market = F.when(F.col("c_acctbal") < 0, text('""')).otherwise(
        F.concat(text('"'), F.col("c_mktsegment"), text('"'))
    )
    date = F.when(nation == 20, text('"2025-13-01"')).when(nation == 21, text('"25-6-1"')).otherwise(
        F.concat(text('"2025-6-'), (F.col("c_custkey") % 28 + 1).cast("string"), text('"'))
    )
    full = F.concat_ws(", ", ticker, price, market, date)
    short = F.concat_ws(", ", ticker, price, market)
    body = F.when(nation == 3, short).otherwise(full)
    record = F.when(nation == 4, text('{"ticker": "X"}')).otherwise(F.concat(text("["), body, text("]")))
    return model.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", record.alias("record"))


RECORDS = """
validated AS (
  SELECT c_custkey, c_nationkey,
    CASE WHEN c_nationkey IN (3, 4) THEN 'invalid_structure'
         WHEN c_nationkey IN (7, 8) THEN 'invalid_ticker'
         WHEN c_nationkey IN (11, 14) THEN 'invalid_price'
         WHEN c_acctbal < 0 THEN 'invalid_market'
         WHEN c_nationkey IN (20, 21) THEN 'invalid_date' END AS error_code
  FROM customer
)"""


@query(f"WITH {RECORDS} SELECT c_custkey, error_code FROM validated")
def record_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.validate_records(quality.read_records(_records(spark, sf_dir)))
    return checked.select("c_custkey", "error_code")


@query(f"""WITH {RECORDS}
SELECT c_nationkey, count(*) AS records, min(c_custkey) FILTER (error_code IS NOT NULL) AS first_bad,
  arg_min(error_code, c_custkey) FILTER (error_code IS NOT NULL) AS error_code,
  CASE WHEN count(error_code) > 0 THEN 'rejected' ELSE 'loaded' END AS verdict,
  CASE WHEN count(error_code) > 0 THEN 0 ELSE count(*) END AS loaded
FROM validated GROUP BY c_nationkey""")
def batch_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.validate_records(quality.read_records(_records(spark, sf_dir)))
    return quality.batch_verdict(checked, ["c_nationkey"], "c_custkey")


def _report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as report text: locale numbers, short dates, some of them corrupt."""
    amount = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    day = F.date_format("o_orderdate", "d-MMM-yy")
    spanish = F.replace(F.replace(day, F.lit("Jan"), F.lit("ene")), F.lit("Dec"), F.lit("dic"))
    return model.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "#DIV/0!").otherwise(amount).alias("amount_text"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("31-xyz-"), F.lit("25")))
        .otherwise(spanish)
        .alias("date_text"),
    )


@query("""SELECT o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(38,9)) END AS amount,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'bad_amount'
       WHEN o_orderstatus = 'P' THEN 'bad_order_date' END AS reject_reason
FROM orders""")
def corrupt_row_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = {
        "amount": ("amount_text", parse_locale_number("amount_text")),
        "order_date": ("date_text", parse_report_date("date_text")),
    }
    marked = quality.quarantine(_report_lines(spark, sf_dir), parsed)
    return marked.select("o_orderkey", "amount", "order_date", "reject_reason")


@query("""WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type, nullif(user_id, 8) AS user_id FROM events)
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_rows, count(*) AS rows FROM e
UNION ALL SELECT 'event_type', count(*) - count(event_type), count(*) FROM e
UNION ALL SELECT 'user_id', count(*) - count(user_id), count(*) FROM e""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = model.table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif("user_id", F.lit(8)).alias("user_id"),
    )
    return quality.null_counts(events, events.columns)


def _raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("l_returnflag") == "R", "SELL")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "TRANSFER")
        .otherwise("BUY")
    )
    return model.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"),
        kind.alias("transaction_type"),
        (F.col("l_quantity").cast("decimal(18,6)") - F.lit(3)).cast("decimal(18,6)").alias("quantity"),
    )


@query("""WITH t AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
    CASE WHEN l_returnflag = 'R' THEN 'SELL' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'TRANSFER'
         ELSE 'BUY' END AS transaction_type,
    CAST(l_quantity - 3 AS DECIMAL(18,6)) AS quantity
  FROM lineitem)
SELECT *, CASE WHEN transaction_type NOT IN ('BUY', 'SELL', 'DIVIDEND', 'SPLIT') THEN 'invalid_type'
               WHEN quantity <= 0 THEN 'invalid_quantity' END AS error_code FROM t""")
def transaction_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_transactions(_raw_trades(spark, sf_dir))


# --- merges --------------------------------------------------------------


def _merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.table(spark, sf_dir, "part").filter("p_size <= 30").select(
        F.col("p_partkey").alias("asset_key"),
        F.col("p_name").alias("ticker_symbol"),
        F.col("p_retailprice").cast("decimal(38,9)").alias("amount_at_payment"),
        F.col("p_type").alias("type"),
    )


def _merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each asset; the last one counts."""
    lots = model.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asset_key"),
        F.lit("renamed").alias("ticker_symbol"),
        F.col("l_extendedprice").cast("decimal(38,9)").alias("amount_at_payment"),
        F.col("l_returnflag").alias("type"),
        *model.TICK_ORDER,
    )
    return lots


MERGE = """
target AS (
  SELECT p_partkey AS asset_key, p_name AS ticker_symbol,
         CAST(p_retailprice AS DECIMAL(38,9)) AS amount_at_payment, p_type AS type
  FROM part WHERE p_size <= 30
),
source AS (
  SELECT l_partkey AS asset_key, 'renamed' AS ticker_symbol,
         CAST(l_extendedprice AS DECIMAL(38,9)) AS amount_at_payment, l_returnflag AS type
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1
)"""


@query(f"""WITH {MERGE}
SELECT coalesce(t.asset_key, s.asset_key) AS asset_key,
  CASE WHEN t.asset_key IS NULL THEN s.ticker_symbol ELSE t.ticker_symbol END AS ticker_symbol,
  CASE WHEN s.asset_key IS NULL THEN t.amount_at_payment ELSE s.amount_at_payment END AS amount_at_payment,
  CASE WHEN s.asset_key IS NULL THEN t.type ELSE s.type END AS type
FROM target t FULL JOIN source s ON t.asset_key = s.asset_key""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _merge_target(spark, sf_dir)
    return merge.upsert(
        target,
        _merge_source(spark, sf_dir),
        ["asset_key"],
        ["amount_at_payment", "type"],
        dedupe_by=model.TICK_ORDER,
    )


@query(f"""WITH {MERGE}
SELECT count(*) AS source_rows, count(t.asset_key) AS would_update,
  count(*) - count(t.asset_key) AS would_insert
FROM source s LEFT JOIN target t ON t.asset_key = s.asset_key""")
def merge_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = merge.unique_source(_merge_source(spark, sf_dir), ["asset_key"], model.TICK_ORDER)
    return merge.merge_preview(_merge_target(spark, sf_dir), source, ["asset_key"])


@query("""WITH target AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date, 'orders' AS origin FROM orders),
source AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS full_date, 'lineitem' AS origin FROM lineitem)
SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date, origin FROM (
  FROM target UNION ALL FROM source WHERE full_date NOT IN (SELECT full_date FROM target))""")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    def dates(name: str, col: str) -> DataFrame:
        days = model.table(spark, sf_dir, name).select(F.col(col).cast("date").alias("full_date")).distinct()
        key = F.date_format("full_date", "yyyyMMdd").cast("bigint").alias("date_key")
        return days.select(key, "full_date", F.lit(name).alias("origin"))

    return merge.insert_missing(dates("orders", "o_orderdate"), dates("lineitem", "l_shipdate"), ["date_key"])


def _tagged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.ticks(spark, sf_dir).withColumn("data_source", F.lit(prices.PRICE_SOURCE))


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a backfill loaded earlier: one row per asset and day up to mid 1998."""
    loaded = _tagged_prices(spark, sf_dir).filter("snapshot_date < date'1998-07-01'")
    return prices.latest_per_key(loaded, FACT_KEYS, model.TICK_ORDER)


def _delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery that overlaps the backfill and repeats some keys."""
    return _tagged_prices(spark, sf_dir).filter("snapshot_date >= date'1998-01-01'")


APPEND = (
    model.TICKS
    + """,
target AS (
  SELECT * FROM ticks WHERE snapshot_date < DATE '1998-07-01'
  QUALIFY row_number() OVER (PARTITION BY asset_key, snapshot_date
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1
),
source AS (SELECT * FROM ticks WHERE snapshot_date >= DATE '1998-01-01'),
fresh AS (
  SELECT * FROM source s
  WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.asset_key = s.asset_key AND t.snapshot_date = s.snapshot_date)
  QUALIFY row_number() OVER (PARTITION BY asset_key, snapshot_date
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1
)"""
)


@query(f"""WITH {APPEND}
SELECT asset_key, snapshot_date, 'alphavantage' AS data_source, close_price, volume FROM fresh""")
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = merge.append_new(
        _backfill(spark, sf_dir), _delivery(spark, sf_dir), FACT_KEYS, model.TICK_ORDER
    )
    return fresh.select(*FACT_KEYS, "close_price", "volume")


@query(f"""WITH {APPEND}
SELECT (SELECT count(*) FROM source) AS rows_staged, (SELECT count(*) FROM fresh) AS rows_inserted,
  (SELECT count(*) FROM target) + (SELECT count(*) FROM fresh) AS rows_total""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.append_counts(_backfill(spark, sf_dir), _delivery(spark, sf_dir), FACT_KEYS)


# --- feeds and runs ------------------------------------------------------


@query("""SELECT CAST(ts AS DATE) AS run_date, count(*) AS total,
  count(*) FILTER (event_type <> 'error') AS succeeded, count(*) FILTER (event_type = 'error') AS failed,
  bool_or(event_type <> 'error') AS run_ok
FROM events GROUP BY 1""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = model.table(spark, sf_dir, "events").withColumn("run_date", F.col("ts").cast("date"))
    return prices.run_summary(status, ["run_date"], F.col("event_type") != "error")


@query("""SELECT 'FCI' AS category, c_custkey AS id, c_name AS name, c_acctbal AS amount, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'LETRAS', s_suppkey, s_name, s_acctbal, NULL FROM supplier
UNION ALL SELECT 'ON', p_partkey, p_name, p_retailprice, p_brand FROM part""")
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def feed(source: str, **cols: str) -> DataFrame:
        return model.table(spark, sf_dir, source).select(*[F.col(c).alias(n) for n, c in cols.items()])

    feeds = {
        "FCI": feed("customer", id="c_custkey", name="c_name", amount="c_acctbal", segment="c_mktsegment"),
        "LETRAS": feed("supplier", id="s_suppkey", name="s_name", amount="s_acctbal"),
        "ON": feed("part", id="p_partkey", name="p_name", amount="p_retailprice", segment="p_brand"),
        "BONOS": None,
    }
    return prices.union_feeds(feeds)


@query("""SELECT count(*) AS n_feeds, count(*) FILTER (payload IS NULL) AS n_failed, bool_and(payload IS NULL) AS all_failed
FROM (SELECT event_type, max(nullif(event_type, 'error')) AS payload FROM events GROUP BY 1)""")
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.max(F.nullif("event_type", F.lit("error"))).alias("payload")
    return prices.feed_health(model.table(spark, sf_dir, "events").groupBy("event_type").agg(payload))


@query("""SELECT p_partkey, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, ',') AS items FROM (
  SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN [] ELSE string_split(p_name || ' ' || p_brand, ' ') END AS items FROM part)""")
def split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.concat_ws(" ", "p_name", "p_brand"), F.lit(" "), F.lit("|"))
    piped = F.when(F.col("p_type") == "SMALL", "").otherwise(text)
    items = model.table(spark, sf_dir, "part").select("p_partkey", split_items(piped).alias("items"))
    return items.select(
        "p_partkey", F.size("items").alias("n_items"), F.array_join("items", ",").alias("items")
    )


def as_wall_clock(fact: DataFrame) -> DataFrame:
    clock = ("snapshot_timestamp", "ingestion_timestamp")
    return fact.select(*[model.ntz(c) if c in clock else F.col(c) for c in fact.columns])

