"""Queries over positions, valuation and as-of prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators import asof, calendar, currency, increments, moving_cost, portfolio
from ledgerlark.plans import model
from ledgerlark.plans.registry import query
from ledgerlark.session import fresh_path
from ledgerlark.sinks import file_table
from ledgerlark.sinks.tables import append_fact

AS_OF = "1998-06-30"
HISTORY = ("1998-06-17", "1998-06-30")
YEAR = ("1997-07-01", "1998-06-30")

TRADES = f"{model.ASSETS}, {model.RATES}, {model.TRANSACTIONS}, {model.COSTED}"


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with their cost in the asset's currency."""
    days = currency.daily_rates(model.rates(spark, sf_dir), model.RATES_UNTIL)
    return currency.trade_costs(model.transactions(spark, sf_dir), model.assets(spark, sf_dir), days)


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return currency.daily_rates(model.rates(spark, sf_dir), model.RATES_UNTIL)


def _valued_sql(positions: str) -> str:
    """The rows of a snapshot from positions that have a ``snapshot_date``."""
    ratio = model.cross_rate_sql("price_currency", "cost_basis_currency", "v.rate_to_usd", "c.rate_to_usd")
    return f"""
priced AS (
  SELECT h.*, CAST(d.close_price AS DECIMAL(38,9)) AS current_price, d.price_currency, d.snapshot_date AS price_date
  FROM (SELECT * FROM {positions} WHERE quantity_held <> 0) h
  ASOF LEFT JOIN daily d ON h.asset_key = d.asset_key AND h.snapshot_date >= d.snapshot_date
),
averaged AS (
  SELECT *, CASE WHEN quantity_bought > 0 THEN CAST(purchase_cost AS DOUBLE) / CAST(quantity_bought AS DOUBLE) END AS avg_cost_basis,
    CAST(CAST(quantity_held AS DECIMAL(20,6)) * CAST(current_price AS DECIMAL(18,6)) AS DECIMAL(38,9)) AS market_value
  FROM priced
),
gained AS (
  SELECT a.*, avg_cost_basis * CAST(quantity_held AS DOUBLE) AS total_cost_basis,
    CAST(market_value AS DOUBLE) * ({ratio}) - avg_cost_basis * CAST(quantity_held AS DOUBLE) AS gain
  FROM averaged a
  ASOF LEFT JOIN rates v ON a.price_currency = v.currency_code AND a.snapshot_date >= v.rate_date
  ASOF LEFT JOIN rates c ON a.cost_basis_currency = c.currency_code AND a.snapshot_date >= c.rate_date
),
valued AS (
  SELECT snapshot_date, user_id, asset_key, quantity_held, avg_cost_basis, total_cost_basis, cost_basis_currency,
    current_price, price_currency, price_date, market_value, gain AS unrealized_gain_loss,
    CASE WHEN total_cost_basis <> 0 THEN 100.0::DOUBLE * gain / total_cost_basis END AS unrealized_gain_loss_pct,
    CASE WHEN price_date IS NULL THEN 'MISSING_PRICE'
         WHEN snapshot_date - price_date > 5 THEN 'STALE_PRICE' ELSE 'COMPLETE' END AS data_quality
  FROM gained
)"""


SNAPSHOT = f"""{model.DAILY}, {TRADES},
{model.positions_sql(f"transaction_date <= DATE '{AS_OF}'")},
held AS (SELECT *, DATE '{AS_OF}' AS snapshot_date FROM positions),
{_valued_sql("held")}"""


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, trades = model.ticks(spark, sf_dir), _trades(spark, sf_dir)
    return portfolio.portfolio_snapshot(trades, prices, _days(spark, sf_dir), AS_OF, tie_break=model.TICK_ORDER)


@query(f"WITH {SNAPSHOT} SELECT * FROM valued")
def portfolio_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir)


# Stored amounts come back as whole thousandths, half up; what is within a ten-thousandth of a half counts as one, so
# that the last binary digit of a double decides nothing.
STORED = ("avg_cost_basis", "total_cost_basis", "unrealized_gain_loss", "unrealized_gain_loss_pct")


@query(f"""WITH {SNAPSHOT}
SELECT snapshot_date, user_id, asset_key, quantity_held, cost_basis_currency, current_price, price_currency, market_value,
  {", ".join(f"CAST(floor({c} * 1000 + 0.5001) AS BIGINT) AS {c}" for c in STORED)},
  TIMESTAMP '{model.INGESTED_AT}' AS calculated_at, data_quality FROM valued""")
def snapshot_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot in its day-partitioned table; a second run replaces its own day.

    The four stored amounts come back as whole thousandths.
    """
    path = fresh_path(spark, "snapshots")
    stored = portfolio.store_snapshot(_snapshot(spark, sf_dir), model.ingested_at())
    for _ in range(2):
        append_fact(stored, path, "snapshot_date", portfolio.POSITION, mode="overwrite")
    kept = spark.read.schema(stored.schema).parquet(path)
    return kept.select(
        "snapshot_date", *portfolio.POSITION, "quantity_held", "cost_basis_currency", "current_price", "price_currency",
        "market_value", *[F.floor(F.col(c) * 1000 + F.lit(0.5001)).cast("bigint").alias(c) for c in STORED],
        model.ntz("calculated_at"), "data_quality",
    )


@query(f"""WITH {SNAPSHOT}
SELECT price_currency, exchange_country, asset_type,
  GROUPING(price_currency, exchange_country, asset_type) AS level, count(*) AS positions,
  count(*) FILTER (data_quality <> 'COMPLETE') AS flagged,
  CAST(sum(market_value) AS DECIMAL(38,9)) AS market_value
FROM valued LEFT JOIN assets USING (asset_key)
GROUP BY GROUPING SETS ((price_currency), (price_currency, exchange_country), (price_currency, exchange_country, asset_type))""")
def portfolio_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.portfolio_rollup(
        _snapshot(spark, sf_dir),
        model.assets(spark, sf_dir),
        ["exchange_country", "asset_type"],
    )


@query(f"""WITH {model.TRANSACTIONS}
SELECT user_id, asset_key, CAST(sum(signed_quantity) AS DECIMAL(38,9)) AS quantity_held
FROM signed WHERE transaction_date <= DATE '{AS_OF}' GROUP BY ALL""")
def holdings_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.holdings(model.transactions(spark, sf_dir), AS_OF)


@query(f"""WITH {model.TRANSACTIONS}
SELECT transaction_id, user_id, asset_key, transaction_date,
  CAST(sum(signed_quantity) OVER (PARTITION BY user_id, asset_key
    ORDER BY transaction_date, l_orderkey, l_linenumber, l_suppkey
    ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,9)) AS quantity_held
FROM signed""")
def holdings_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = [F.col("transaction_date")]
    order = ["transaction_date", *model.TICK_ORDER]
    running = portfolio.running_holdings(model.transactions(spark, sf_dir), order, blocks)
    return running.select("transaction_id", "user_id", "asset_key", "transaction_date", "quantity_held")


@query(f"""WITH {TRADES}, {model.positions_sql(f"transaction_date <= DATE '{AS_OF}'")}
SELECT user_id, asset_key, cost_basis_currency, quantity_bought, purchase_cost,
  CASE WHEN quantity_bought > 0 THEN CAST(purchase_cost AS DOUBLE) / CAST(quantity_bought AS DOUBLE) END AS avg_cost_basis
FROM positions""")
def cost_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.cost_basis(_trades(spark, sf_dir), AS_OF)


def _moving_sql(by: str) -> str:
    """The cost after every trade by a recursion over the trades of a position."""
    rule = """CASE WHEN o.q <= 0 THEN 0.0::DOUBLE
      WHEN o.transaction_type = 'BUY' AND o.q0 >= 0 THEN {c} + o.cost
      WHEN o.transaction_type = 'BUY' THEN o.cost * o.q / o.bought
      WHEN o.q0 <= 0 THEN 0.0::DOUBLE
      WHEN o.transaction_type = 'SELL' THEN {c} * (o.q / o.q0) ELSE {c} END"""
    return f"""
numbered AS (
  SELECT *, row_number() OVER w AS n, sum(signed_quantity) OVER (w ROWS UNBOUNDED PRECEDING) AS held,
    CAST(buy_cost AS DOUBLE) AS cost, CAST(bought_quantity AS DOUBLE) AS bought
  FROM costed WINDOW w AS (PARTITION BY {by} ORDER BY transaction_date, l_orderkey, l_linenumber, l_suppkey)
),
steps AS (SELECT *, CAST(held AS DOUBLE) AS q, CAST(held - signed_quantity AS DOUBLE) AS q0 FROM numbered),
moving AS (
  SELECT o.*, {rule.format(c="0.0::DOUBLE")} AS moving_cost FROM steps o WHERE n = 1
  UNION ALL SELECT o.*, {rule.format(c="m.moving_cost")} FROM moving m JOIN steps o
    ON o.n = m.n + 1 AND {" AND ".join(f"o.{c} = m.{c}" for c in by.split(", "))}
)
SELECT transaction_id, user_id, asset_key, transaction_date, cost_basis_currency, CAST(held AS DECIMAL(38,9)) AS quantity_held,
  CAST(floor(moving_cost * 100 + 0.5001) AS BIGINT) AS cost_cents FROM moving"""


def _moving(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    """Whole cents, half up: what is within a ten-thousandth of a half counts as one, whatever the order of the sums.

    The name of a trade is made of what is ordered by, so it is made last and not shuffled.
    """
    order = ["transaction_date", *model.TICK_ORDER]
    needed = [*portfolio.POSITION, *order, "transaction_type", "quantity", "cost_basis_currency", "buy_cost"]
    costs = moving_cost.moving_cost(_trades(spark, sf_dir).select(*needed), order, by=by)
    cents = F.floor(F.col("moving_cost") * 100 + F.lit(0.5001)).cast("bigint").alias("cost_cents")
    return costs.select(model.trade_id().alias("transaction_id"), *portfolio.POSITION, "transaction_date", "cost_basis_currency", "quantity_held", cents)


@query(f"WITH RECURSIVE {TRADES}, {_moving_sql('user_id, asset_key')}")
def cost_basis_moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moving-average cost of every position after each of its trades."""
    return _moving(spark, sf_dir, portfolio.POSITION)


@query(f"WITH RECURSIVE {TRADES}, {_moving_sql('asset_key')}")
def cost_basis_moving_desk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the desk as a whole: all users' trades of an asset are one position."""
    return _moving(spark, sf_dir, ["asset_key"])


HELD_DAILY = model.positions_sql("transaction_date <= snapshot_date", "snapshot_date, user_id, asset_key", "costed, days")
HISTORY_SQL = f"""{model.DAILY}, {TRADES},
days AS (SELECT CAST(unnest(generate_series(DATE '{HISTORY[0]}', DATE '{HISTORY[1]}', INTERVAL 1 DAY)) AS DATE) AS snapshot_date),
{HELD_DAILY}, {_valued_sql("positions")}"""


@query(f"WITH {HISTORY_SQL} SELECT * FROM valued")
def portfolio_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, prices = _trades(spark, sf_dir), model.ticks(spark, sf_dir)
    return portfolio.portfolio_history(trades, prices, _days(spark, sf_dir), *HISTORY, tie_break=model.TICK_ORDER)


@query(f"""WITH {model.DAILY}, {TRADES},
daily_sums AS (
  SELECT user_id, asset_key, any_value(cost_basis_currency) AS cost_basis_currency,
    greatest(transaction_date, DATE '{YEAR[0]}') AS first_day, sum(signed_quantity) AS q, sum(bought_quantity) AS b,
    count(*) FILTER (buy_cost IS NULL) AS unknown, sum(buy_cost) AS cost
  FROM costed WHERE transaction_date <= DATE '{YEAR[1]}' GROUP BY user_id, asset_key, first_day
),
runs AS (
  SELECT user_id, asset_key, cost_basis_currency, first_day, CAST(sum(q) OVER w AS DECIMAL(38,9)) AS quantity_held,
    CAST(sum(b) OVER w AS DECIMAL(38,9)) AS quantity_bought,
    CASE WHEN sum(unknown) OVER w = 0 THEN CAST(sum(cost) OVER w AS DECIMAL(38,9)) END AS purchase_cost,
    coalesce(lead(first_day) OVER w, DATE '{YEAR[1]}' + 1) - 1 AS last_day
  FROM daily_sums WINDOW w AS (PARTITION BY user_id, asset_key ORDER BY first_day)
),
held AS (
  SELECT * EXCLUDE (first_day, last_day), CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS snapshot_date
  FROM runs WHERE quantity_held <> 0
),
{_valued_sql("held")}
SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, price_currency, data_quality, count(*) AS position_days,
  count(DISTINCT snapshot_date) AS days, CAST(sum(market_value) AS DECIMAL(38,9)) AS value_days,
  count(unrealized_gain_loss) AS gains
FROM valued GROUP BY ALL""")
def portfolio_history_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of daily history, summed up by month, currency and quality flag."""
    trades, prices = _trades(spark, sf_dir), model.ticks(spark, sf_dir)
    history = portfolio.portfolio_history(
        trades, prices, _days(spark, sf_dir), *YEAR, tie_break=model.TICK_ORDER, also=portfolio.amount_parts()
    )
    daily = history.groupBy("snapshot_date", "price_currency", "data_quality").agg(
        F.count(F.lit(1)).alias("n"), *portfolio.amount_sums(), F.count("unrealized_gain_loss").alias("gains")
    )
    return daily.groupBy(F.trunc("snapshot_date", "month").alias("month"), "price_currency", "data_quality").agg(
        F.sum("n").alias("position_days"), F.count(F.lit(1)).alias("days"),
        portfolio.amount_total().alias("value_days"), F.sum("gains").alias("gains"),
    )


@query(f"WITH {HISTORY_SQL} SELECT * FROM valued")
def history_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history kept up to date over three deliveries, the later ones with trades of any date.

    After each, only the days from a position's first new trade on are computed and only files that hold them
    are rewritten; in the end the table is what a full rebuild gives.
    """
    path = fresh_path(spark, "history")
    prices, days = model.ticks(spark, sf_dir), _days(spark, sf_dir)
    trades = _trades(spark, sf_dir).withColumn("delivery", F.when(F.col("l_orderkey") % 50 < 2, F.col("l_orderkey") % 50 + 1).otherwise(0))
    for n in range(3):
        known, new = trades.filter(F.col("delivery") <= n), trades.filter(F.col("delivery") == n)
        increments.refresh_history(spark, path, known, prices, days, new, *HISTORY, tie_break=model.TICK_ORDER)
    return file_table.read(spark, path)


@query(f"""WITH {model.DAILY}, {model.TRANSACTIONS}
SELECT t.transaction_id, t.asset_key, t.transaction_date, d.snapshot_date, d.close_price
FROM txns t ASOF LEFT JOIN daily d ON t.asset_key = d.asset_key AND t.transaction_date >= d.snapshot_date""")
def asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = model.transactions(spark, sf_dir).select("transaction_id", "asset_key", "transaction_date")
    return asof.asof_join(
        trades,
        model.daily_prices(spark, sf_dir),
        ["asset_key"],
        "transaction_date",
        "snapshot_date",
        ["close_price"],
    )


@query(f"""WITH {model.ASSETS}, {model.DAILY}, {model.RATES},
held AS (SELECT asset_key, snapshot_date, CAST(sum(volume) AS DECIMAL(38,9)) AS quantity FROM ticks GROUP BY ALL),
local AS (
  SELECT h.*, close_price, currency_code,
    CAST(CAST(quantity AS DECIMAL(20,6)) * CAST(close_price AS DECIMAL(18,6)) AS DECIMAL(38,9)) AS total_value_local
  FROM held h JOIN daily USING (asset_key, snapshot_date) LEFT JOIN assets USING (asset_key)
)
SELECT CAST(snapshot_date AS TIMESTAMP) AS snapshot_timestamp, snapshot_date, asset_key, quantity,
  CAST(close_price AS DECIMAL(38,9)) AS price_per_unit_local, total_value_local, l.currency_code, rate_date,
  CAST(rate_to_usd AS DECIMAL(38,9)) AS exchange_rate_to_usd,
  CAST(CAST(total_value_local AS DECIMAL(20,6)) * CAST(rate_to_usd AS DECIMAL(15,9)) AS DECIMAL(38,9)) AS total_value_usd
FROM local l ASOF LEFT JOIN rates r ON l.currency_code = r.currency_code AND l.snapshot_date >= r.rate_date""")
def fx_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = model.ticks(spark, sf_dir)
    quantity = F.sum("volume").cast("decimal(38,9)").alias("quantity")
    last = F.max_by("close_price", F.struct(*model.TICK_ORDER)).alias("close_price")
    held = ticks.groupBy("asset_key", "snapshot_date").agg(quantity, last)  # one pass for both
    local = portfolio.investment_snapshot(held)
    own = model.assets(spark, sf_dir).select("asset_key", "currency_code")
    facts = local.join(own, "asset_key", "left")
    rates = model.rates(spark, sf_dir)
    usd = currency.convert_currency(
        facts, rates, "snapshot_date", "currency_code", "total_value_local", until=model.RATES_UNTIL
    )
    return usd.withColumn("snapshot_timestamp", model.ntz("snapshot_timestamp"))


@query(f"""WITH {model.ASSETS}, {model.TICKS}, {model.bounds_sql("lineitem", "l_shipdate")} {model.SPINE}
SELECT t.asset_key, t.snapshot_date, close_price, volume, l_orderkey, l_linenumber, l_suppkey,
  ticker_symbol, asset_type, currency_code, date_key, "year", "quarter", month_name, day_of_week
FROM ticks t LEFT JOIN assets USING (asset_key) LEFT JOIN spine ON full_date = t.snapshot_date""")
def fact_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim_asset = model.assets(spark, sf_dir).select("asset_key", "ticker_symbol", "asset_type", "currency_code")
    bounds = model.date_bounds(model.table(spark, sf_dir, "lineitem"), "l_shipdate")
    dim_date = calendar.spine_between(bounds).select(
        "full_date", "date_key", "year", "quarter", "month_name", "day_of_week"
    )
    return portfolio.enrich(model.ticks(spark, sf_dir).drop("price_currency"), dim_asset, dim_date, "snapshot_date")


@query(f"""WITH {model.ASSETS},
named AS (SELECT DISTINCT p_name AS ticker_symbol, p_brand AS exchange_code FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT {model.KEY_SQL.format("ticker_symbol || '|' || exchange_code")} AS asset_key, ticker_symbol, exchange_code
FROM named n WHERE NOT EXISTS (SELECT 1 FROM assets a
  WHERE a.is_active AND a.ticker_symbol = n.ticker_symbol AND a.exchange_code = n.exchange_code)""")
def missing_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = model.assets(spark, sf_dir)
    trades = model.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("asset_key"))
    named = trades.join(names.drop("is_active"), "asset_key")
    return portfolio.missing_assets(named, names.filter("is_active"), ["ticker_symbol", "exchange_code"])
