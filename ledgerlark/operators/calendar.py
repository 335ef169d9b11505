"""Date spine, market calendars and trading days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The markets tracked, and the ranges the calendars cover.
MARKETS = ("US", "AR")
RANGE_V2 = ("2024-01-01", "2040-12-31")
RANGE_V1 = ("2015-01-01", "2040-12-31")


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` with its parts."""
    one = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return spine_between(one)


def spine_between(bounds: DataFrame) -> DataFrame:
    """The spine between the (start, end) dates of a one-row frame."""
    return date_parts(bounds.select(F.explode(F.sequence("start", "end")).alias("full_date")))


def date_parts(df: DataFrame, date: str = "full_date") -> DataFrame:
    """Key, year, quarter, month, day and weekday (Monday is 1) of a date column."""
    d = F.col(date)
    return df.select(
        F.date_format(d, "yyyyMMdd").cast("bigint").alias("date_key"),
        "*",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
    )


def is_weekend(date: Column | str = "full_date") -> Column:
    return F.weekday(date) >= 5


def holidays_by_date(holidays: DataFrame) -> DataFrame:
    """(holiday_date, entries): one row per date with its {market, name} structs.

    ``holidays`` has market, holiday_date and name. Several names of one market and day are
    joined into one entry, so a date has at most one entry per market.
    """
    named = holidays.groupBy("market", "holiday_date").agg(
        F.array_join(F.sort_array(F.collect_set("name")), "; ").alias("name")
    )
    return named.groupBy("holiday_date").agg(
        F.collect_list(F.struct("market", "name")).alias("entries")
    )


def calendar_v1(spine: DataFrame, holidays: DataFrame, markets: Sequence[str] = MARKETS) -> DataFrame:
    """First calendar form: weekend flag and the markets on holiday, weekends included."""
    joined = _with_holidays(spine, holidays, markets)
    return joined.select(
        *[c for c in spine.columns if c != "day_of_week"],
        is_weekend().alias("is_weekend"),
        F.transform("_entries", lambda e: e["market"]).alias("holiday_markets"),
    )


def calendar_v2(spine: DataFrame, holidays: DataFrame, markets: Sequence[str] = MARKETS) -> DataFrame:
    """Second calendar form: open markets, closed markets and the holidays behind them.

    A market is closed at weekends and on its holidays. A holiday that falls on a weekend
    is listed as well. Markets keep the order in which they are given.
    """
    joined = _with_holidays(spine, holidays, markets)
    every = F.array(*[F.lit(m) for m in markets])
    off = F.transform("_entries", lambda e: e["market"])
    closed = F.when(is_weekend(), every).otherwise(off)
    return joined.select(
        *spine.columns,
        F.array_except(every, closed).alias("markets_open"),
        closed.alias("markets_closed"),
        F.col("_entries").alias("holidays"),
    )


def _with_holidays(spine: DataFrame, holidays: DataFrame, markets: Sequence[str]) -> DataFrame:
    by_date = holidays_by_date(holidays.filter(F.col("market").isin(*markets)))
    order = F.array(*[F.lit(m) for m in markets])
    ranked = F.array_sort(
        F.coalesce("entries", F.array().cast("array<struct<market:string,name:string>>")),
        lambda a, b: (
            F.array_position(order, a["market"]) - F.array_position(order, b["market"])
        ).cast("int"),
    )
    joined = spine.join(by_date, F.col("full_date") == F.col("holiday_date"), "left")
    return joined.withColumn("_entries", ranked)


def trading_days(calendar: DataFrame, markets: Sequence[str] = MARKETS) -> DataFrame:
    """Per market and day: is the market open, and which open day came before.

    Works on the calendar, so the ordered pass sees one row per market and day.
    """
    every = F.array(*[F.lit(m) for m in markets])
    days = calendar.select("full_date", "markets_open", F.explode(every).alias("market"))
    is_open = F.array_contains(F.col("markets_open"), F.col("market"))
    w = Window.partitionBy("market").orderBy("full_date").rowsBetween(Window.unboundedPreceding, -1)
    return days.select("market", "full_date", is_open.alias("is_open")).withColumn(
        "previous_open", F.last(F.when(F.col("is_open"), F.col("full_date")), ignorenulls=True).over(w)
    )
