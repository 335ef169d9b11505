"""How the given tables stand in for the data model, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.functions import half_up_ratio
from ledgerlark.operators.prices import latest_per_key

TICK_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey"]
INGESTED_AT = "2025-01-01 00:00:00"

# Holidays that fall on the same date every year.
HOLIDAY_RULES = (
    ("US", "01-01", "New Year"),
    ("US", "07-04", "Independence Day"),
    ("US", "12-25", "Christmas"),
    ("AR", "01-01", "New Year"),
    ("AR", "05-01", "Labour Day"),
    ("AR", "05-25", "May Revolution"),
    ("AR", "07-09", "Independence Day"),
    ("AR", "12-25", "Christmas"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingested_at() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp")


def ntz(col: str) -> Column:
    """A timestamp as wall-clock time, the way the given tables hold it."""
    return F.col(col).cast("timestamp_ntz").alias(col)


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_us = F.col("p_size") % 2 == 0
    kind = (
        F.when(F.col("p_type") == "STANDARD", "STOCK")
        .when(F.col("p_type") == "PROMO", "ETF")
        .otherwise("BOND")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asset_key"),
        F.col("p_name").alias("ticker_symbol"),
        F.col("p_brand").alias("exchange_code"),
        kind.alias("asset_type"),
        F.when(in_us, "US").otherwise("AR").alias("exchange_country"),
        F.when(in_us, "USD").otherwise("ARS").alias("currency_code"),
        (F.col("p_size") > 5).alias("is_active"),
    )


ASSETS = """
assets AS (
  SELECT p_partkey AS asset_key, p_name AS ticker_symbol, p_brand AS exchange_code,
         CASE p_type WHEN 'STANDARD' THEN 'STOCK' WHEN 'PROMO' THEN 'ETF' ELSE 'BOND' END AS asset_type,
         CASE WHEN p_size % 2 = 0 THEN 'US' ELSE 'AR' END AS exchange_country,
         CASE WHEN p_size % 2 = 0 THEN 'USD' ELSE 'ARS' END AS currency_code,
         p_size > 5 AS is_active
  FROM part
)"""


def unit_price() -> Column:
    """Price per unit of a line, rounded half up to six decimals in whole numbers."""
    micros = F.round(F.col("l_extendedprice") * 100).cast("bigint") * F.lit(10000)
    ratio = half_up_ratio(micros, F.col("l_quantity").cast("bigint"))
    return (ratio.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")


UNIT_PRICE = """CAST(CAST(
    (CAST(round(l_extendedprice * 100) AS BIGINT) * 20000 + CAST(l_quantity AS BIGINT))
    // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6))"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history with ties: one row per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asset_key"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        unit_price().alias("close_price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.when(F.col("l_partkey") % 3 == 0, "ARS").otherwise("USD").alias("price_currency"),
        *TICK_ORDER,
    )


TICKS = f"""
ticks AS (
  SELECT l_partkey AS asset_key, CAST(l_shipdate AS DATE) AS snapshot_date,
         {UNIT_PRICE} AS close_price, CAST(l_quantity AS BIGINT) AS volume,
         CASE WHEN l_partkey % 3 = 0 THEN 'ARS' ELSE 'USD' END AS price_currency,
         l_orderkey, l_linenumber, l_suppkey
  FROM lineitem
)"""


def daily_prices(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Price history, one row per asset and day: the last tick wins."""
    keys = ["asset_key", "snapshot_date"]
    return latest_per_key(ticks(spark, sf_dir), keys, TICK_ORDER, keep or ["close_price"])


DAILY = (
    TICKS
    + """,
daily AS (
  SELECT * FROM ticks
  QUALIFY row_number() OVER (PARTITION BY asset_key, snapshot_date
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1
)"""
)


def trade_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "asset_key", "l_suppkey")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades: the customer trades the part on the order date."""
    kind = (
        F.when(F.col("l_returnflag") == "R", "SELL")
        .when(F.col("l_linenumber") == 7, "DIVIDEND")
        .when(F.col("l_linenumber") == 6, "SPLIT")
        .otherwise("BUY")
    )
    commission = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asset_key"),
        kind.alias("transaction_type"),
        F.col("l_quantity").cast("decimal(18,6)").alias("quantity"),
        unit_price().alias("price_per_unit"),
        commission.cast("decimal(38,9)").alias("commission"),
        *TICK_ORDER,
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )
    return (
        lines.join(orders, "l_orderkey")
        .withColumn("transaction_id", trade_id())
        .withColumn("currency_code", F.when(F.col("l_suppkey") % 2 == 0, "USD").otherwise("ARS"))
    )


TRANSACTIONS = f"""
txns AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS user_id, l_partkey AS asset_key,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CASE WHEN l_returnflag = 'R' THEN 'SELL' WHEN l_linenumber = 7 THEN 'DIVIDEND'
              WHEN l_linenumber = 6 THEN 'SPLIT' ELSE 'BUY' END AS transaction_type,
         CAST(l_quantity AS DECIMAL(18,6)) AS quantity,
         {UNIT_PRICE} AS price_per_unit,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(38,9)) AS commission,
         CASE WHEN l_suppkey % 2 = 0 THEN 'USD' ELSE 'ARS' END AS currency_code,
         l_orderkey, l_linenumber, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
signed AS (
  SELECT *, CASE transaction_type WHEN 'BUY' THEN quantity WHEN 'SPLIT' THEN quantity
                 WHEN 'SELL' THEN -quantity ELSE 0 END AS signed_quantity,
         CASE WHEN transaction_type = 'BUY' THEN quantity ELSE 0 END AS bought_quantity,
         CASE WHEN transaction_type = 'BUY'
              THEN CAST(quantity AS DECIMAL(20,6)) * CAST(price_per_unit AS DECIMAL(18,6)) ELSE 0 END AS bought_cost
  FROM txns
)"""


# The last day on which rates are asked for; all tables end before it.
RATES_UNTIL = "2010-12-31"


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates to USD: one for pesos on every Monday with orders, a constant one for dollars."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("rate_date"))
    peso = F.dayofyear("rate_date").cast("decimal(9,0)") + F.lit(800)
    pesos = days.filter(F.weekday("rate_date") == 0).distinct().select(
        F.lit("ARS").alias("currency_code"),
        "rate_date",
        (peso * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(15,9)").alias("rate_to_usd"),
    )
    dollars = days.agg(F.min("rate_date").alias("rate_date")).select(
        F.lit("USD").alias("currency_code"), "rate_date", F.lit(1).cast("decimal(15,9)").alias("rate_to_usd")
    )
    # Every rate is delivered a second time, corrected downwards; the higher one counts.
    corrected = F.col("rate_to_usd") - F.lit("0.000000001").cast("decimal(15,9)")
    again = pesos.withColumn("rate_to_usd", corrected.cast("decimal(15,9)"))
    return pesos.unionByName(again).unionByName(dollars)


RATES = """
rate_dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders),
delivered AS (
  SELECT 'ARS' AS currency_code, rate_date,
    CAST(CAST(800 + dayofyear(rate_date) AS DECIMAL(9,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(15,9)) AS rate_to_usd
  FROM rate_dates WHERE isodow(rate_date) = 1
  UNION ALL SELECT 'USD', min(rate_date), CAST(1 AS DECIMAL(15,9)) FROM rate_dates
),
rates AS (
  SELECT currency_code, rate_date, max(rate_to_usd) AS rate_to_usd
  FROM (SELECT * FROM delivered UNION ALL SELECT currency_code, rate_date, CAST(rate_to_usd - 0.000000001 AS DECIMAL(15,9))
        FROM delivered WHERE currency_code = 'ARS') GROUP BY ALL
)"""


def cross_rate_sql(source: str, target: str, source_rate: str, target_rate: str) -> str:
    """Units of the target currency for one of the source currency, of whole billionths."""
    whole = "CAST(CAST(CAST({} AS DECIMAL(28,9)) * 1000000000 AS BIGINT) AS DOUBLE)"
    return f"CASE WHEN {source} = {target} THEN 1.0::DOUBLE ELSE {whole.format(source_rate)} / {whole.format(target_rate)} END"


COSTED = f"""
costed AS (
  SELECT s.*, a.currency_code AS cost_basis_currency, CASE WHEN transaction_type <> 'BUY' THEN 0
    WHEN s.currency_code = a.currency_code THEN bought_cost
    ELSE CAST(CAST(round(CAST(CAST(CAST(bought_cost AS DECIMAL(28,6)) * 1000000 AS BIGINT) AS DOUBLE)
      * ({cross_rate_sql("s.currency_code", "a.currency_code", "p.rate_to_usd", "o.rate_to_usd")})) AS BIGINT) AS DECIMAL(20,0))
      * CAST(0.000001 AS DECIMAL(7,6)) END AS buy_cost
  FROM signed s LEFT JOIN assets a USING (asset_key)
  ASOF LEFT JOIN rates p ON s.currency_code = p.currency_code AND s.transaction_date >= p.rate_date
  ASOF LEFT JOIN rates o ON a.currency_code = o.currency_code AND s.transaction_date >= o.rate_date
)"""


def positions_sql(date_filter: str, by: str = "user_id, asset_key", source: str = "costed") -> str:
    """Positions from the transactions, in the types the plans return: one row each, cost in the asset's currency."""
    return f"""
positions AS (
  SELECT {by}, any_value(cost_basis_currency) AS cost_basis_currency,
         CAST(sum(signed_quantity) AS DECIMAL(38,9)) AS quantity_held,
         CAST(sum(bought_quantity) AS DECIMAL(38,9)) AS quantity_bought,
         CASE WHEN count(*) FILTER (buy_cost IS NULL) = 0 THEN CAST(sum(buy_cost) AS DECIMAL(38,9)) END AS purchase_cost
  FROM {source} WHERE {date_filter} GROUP BY {by}
)"""


def staged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of landed price files."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_size", "p_retailprice"
    )
    country = F.when(F.col("p_size") % 2 == 0, "US").otherwise("AR")
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey").select(
        F.col("l_shipdate").cast("date").alias("timestamp"),
        F.col("p_retailprice").alias("open"),
        F.col("l_extendedprice").alias("high"),
        F.col("p_retailprice").alias("low"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("p_name").alias("ticker_symbol"),
        F.col("p_brand").alias("exchange_name"),
        country.alias("country"),
        F.lit(False).alias("is_adjusted"),
    )


STAGED = """
staged AS (
  SELECT CAST(l_shipdate AS DATE) AS "timestamp", p_retailprice AS "open", l_extendedprice AS high,
         p_retailprice AS low, l_extendedprice AS "close", CAST(l_quantity AS BIGINT) AS volume,
         p_name AS ticker_symbol, p_brand AS exchange_name,
         CASE WHEN p_size % 2 = 0 THEN 'US' ELSE 'AR' END AS country, false AS is_adjusted,
         l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

KEY_SQL = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"

PRICE_FACT = f"""
  SELECT CAST("timestamp" AS TIMESTAMP) AS snapshot_timestamp, "timestamp" AS snapshot_date,
         {KEY_SQL.format("ticker_symbol || '|' || exchange_name")} AS asset_key,
         CAST("open" AS DECIMAL(38,9)) AS open_price, CAST(high AS DECIMAL(38,9)) AS high_price,
         CAST(low AS DECIMAL(38,9)) AS low_price, CAST("close" AS DECIMAL(38,9)) AS close_price,
         CAST(volume AS DECIMAL(38,9)) AS volume, CAST(NULL AS VARCHAR) AS price_currency,
         'alphavantage' AS data_source, is_adjusted,
         TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp
  FROM staged"""


def holidays(spark: SparkSession, years: DataFrame) -> DataFrame:
    """The holiday table of a set of years (column ``year``)."""
    rules = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("market", "md", "name"))]) for r in HOLIDAY_RULES])
    day = F.to_date(F.concat_ws("-", F.col("year").cast("string"), F.col("r.md")))
    return years.select("year", F.explode(rules).alias("r")).select(
        F.col("r.market").alias("market"), day.alias("holiday_date"), F.col("r.name").alias("name")
    )


HOLIDAYS = (
    "rules(market, md, name) AS (VALUES "
    + ", ".join(f"('{m}', '{d}', '{n}')" for m, d, n in HOLIDAY_RULES)
    + """),
holidays AS (
  SELECT market, CAST(CAST("year" AS VARCHAR) || '-' || md AS DATE) AS holiday_date, name
  FROM rules, (SELECT DISTINCT "year" FROM spine)
)"""
)

SPINE = """
spine AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS "quarter",
         CAST(month(d) AS INTEGER) AS "month", strftime(d, '%B') AS month_name,
         CAST(day(d) AS INTEGER) AS "day", CAST(isodow(d) AS INTEGER) AS day_of_week,
         strftime(d, '%A') AS day_of_week_name
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds)
)"""


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """First and last date of a column, the range a calendar has to cover."""
    return df.agg(
        F.min(F.col(col).cast("date")).alias("start"), F.max(F.col(col).cast("date")).alias("end")
    )


def bounds_sql(table_name: str, col: str) -> str:
    return f"bounds AS (SELECT date_trunc('day', min({col})) AS lo, date_trunc('day', max({col})) AS hi FROM {table_name}),"
