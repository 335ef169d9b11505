"""Queries over the calendar; its range comes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators import calendar
from ledgerlark.plans import model
from ledgerlark.plans.registry import query

SHIP_SPINE = model.bounds_sql("lineitem", "l_shipdate") + model.SPINE
ORDER_SPINE = model.bounds_sql("orders", "o_orderdate") + model.SPINE
SHIPPED = "shipped AS (SELECT CAST(l_shipdate AS DATE) AS full_date, count(*) AS price_rows FROM lineitem GROUP BY 1)"


def _spine(spark: SparkSession, sf_dir: str, name: str, col: str) -> DataFrame:
    return calendar.spine_between(model.date_bounds(model.table(spark, sf_dir, name), col))


def _holidays(spark: SparkSession, spine: DataFrame) -> DataFrame:
    return model.holidays(spark, spine.select("year").distinct())


def _shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date").alias("full_date")
    lines = model.table(spark, sf_dir, "lineitem").groupBy(day)
    return lines.agg(F.count(F.lit(1)).alias("price_rows"))


@query(f"""WITH {SHIP_SPINE}, {SHIPPED}
SELECT spine.*, coalesce(price_rows, 0) AS price_rows FROM spine LEFT JOIN shipped USING (full_date)""")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir, "lineitem", "l_shipdate")
    counted = spine.join(_shipped(spark, sf_dir), "full_date", "left")
    return counted.withColumn("price_rows", F.coalesce("price_rows", F.lit(0)))


@query(f"""WITH {ORDER_SPINE}, {model.HOLIDAYS},
placed AS (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS orders FROM orders GROUP BY 1)
SELECT date_key, full_date, "year", "quarter", "month", month_name, "day", day_of_week_name, is_weekend,
  holiday_markets, coalesce(orders, 0) AS orders
FROM (
  SELECT date_key, full_date, "year", "quarter", "month", month_name, "day", day_of_week_name,
    day_of_week >= 6 AS is_weekend,
    coalesce(string_agg(market, '|' ORDER BY market DESC), '') AS holiday_markets
  FROM spine LEFT JOIN holidays ON holiday_date = full_date GROUP BY ALL
) LEFT JOIN placed USING (full_date)""")
def calendar_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir, "orders", "o_orderdate")
    days = calendar.calendar_v1(spine, _holidays(spark, spine))
    day = F.col("o_orderdate").cast("date").alias("full_date")
    placed = model.table(spark, sf_dir, "orders").groupBy(day).agg(F.count(F.lit(1)).alias("orders"))
    return (
        days.withColumn("holiday_markets", F.array_join("holiday_markets", "|"))
        .join(placed, "full_date", "left")
        .withColumn("orders", F.coalesce("orders", F.lit(0)))
    )


STATUS = """
status AS (
  SELECT full_date, m.market, h.name, (day_of_week >= 6 OR h.name IS NOT NULL) AS closed, rank
  FROM spine CROSS JOIN (VALUES ('US', 1), ('AR', 2)) m(market, rank)
  LEFT JOIN holidays h ON h.market = m.market AND holiday_date = full_date
)"""


@query(f"""WITH {SHIP_SPINE}, {model.HOLIDAYS}, {STATUS}, {SHIPPED},
arrays AS (
  SELECT full_date, coalesce(string_agg(market, '|' ORDER BY rank) FILTER (NOT closed), '') AS markets_open,
    coalesce(string_agg(market, '|' ORDER BY rank) FILTER (closed), '') AS markets_closed,
    coalesce(string_agg(market || ':' || name, '|' ORDER BY rank) FILTER (name IS NOT NULL), '') AS holidays
  FROM status GROUP BY full_date
)
SELECT spine.*, markets_open, markets_closed, holidays, coalesce(price_rows, 0) AS price_rows
FROM spine JOIN arrays USING (full_date) LEFT JOIN shipped USING (full_date)""")
def calendar_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir, "lineitem", "l_shipdate")
    days = calendar.calendar_v2(spine, _holidays(spark, spine))
    names = F.transform("holidays", lambda h: F.concat_ws(":", h["market"], h["name"]))
    return (
        days.withColumn("markets_open", F.array_join("markets_open", "|"))
        .withColumn("markets_closed", F.array_join("markets_closed", "|"))
        .withColumn("holidays", F.array_join(names, "|"))
        .join(_shipped(spark, sf_dir), "full_date", "left")
        .withColumn("price_rows", F.coalesce("price_rows", F.lit(0)))
    )


@query(f"""WITH {SHIP_SPINE}, {model.HOLIDAYS}, {STATUS}, {SHIPPED}
SELECT s.market, s.full_date, NOT s.closed AS is_open, o.full_date AS previous_open, coalesce(price_rows, 0) AS price_rows
FROM status s ASOF LEFT JOIN (SELECT market, full_date FROM status WHERE NOT closed) o
  ON s.market = o.market AND s.full_date > o.full_date
LEFT JOIN shipped p ON p.full_date = s.full_date""")
def trading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = _spine(spark, sf_dir, "lineitem", "l_shipdate")
    days = calendar.trading_days(calendar.calendar_v2(spine, _holidays(spark, spine)))
    counted = days.join(_shipped(spark, sf_dir), "full_date", "left")
    return counted.withColumn("price_rows", F.coalesce("price_rows", F.lit(0)))
