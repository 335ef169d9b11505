"""Exchange rates by day, and amounts in another currency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.operators.prices import latest_per_key

RATE = "decimal(15,9)"
# Whole billionths: their quotient is the same double in any engine.
BILLION = 1_000_000_000


def daily_rates(rates: DataFrame, until: str | None = None, tie_break: Sequence[str] = ("rate_to_usd",)) -> DataFrame:
    """The rate that holds on each day: ``currency_code, rate_day, rate_date, rate_to_usd``.

    A rate holds from its date to the day before the next one, the last up to ``until`` (today, unless
    given). A rate delivered several times for a currency and day counts once: the greatest row by
    ``tie_break``; rates without a currency or date are none. The table has a row per currency and day, so facts
    meet it in one equi join and are read once.
    """
    keyed = rates.filter("currency_code IS NOT NULL AND rate_date IS NOT NULL")
    once = latest_per_key(keyed, ["currency_code", "rate_date"], list(tie_break), keep=["rate_to_usd"])
    end = F.current_date() if until is None else F.lit(until).cast("date")
    following = F.lead("rate_date").over(Window.partitionBy("currency_code").orderBy("rate_date"))
    held = once.select("*", F.least(F.date_sub(following, 1), end).alias("_last")).filter("rate_date <= _last")
    days = F.explode(F.sequence("rate_date", "_last")).alias("rate_day")
    return held.select("currency_code", days, "rate_date", F.col("rate_to_usd").cast(RATE).alias("rate_to_usd"))


def with_rate(facts: DataFrame, days: DataFrame, date_col: str, currency_col: str, *, rate: str, rate_date: str | None = None) -> DataFrame:
    """Facts with the rate of their currency on their day, null if there is none."""
    given = [F.col("rate_to_usd").alias(rate)] + ([F.col("rate_date").alias(rate_date)] if rate_date else [])
    right = days.select(F.col("currency_code").alias("_currency"), F.col("rate_day").alias("_day"), *given)
    same = (F.col(currency_col) == F.col("_currency")) & (F.col(date_col) == F.col("_day"))
    return facts.join(right, same, "left").drop("_currency", "_day")


def convert_currency(
    facts: DataFrame,
    rates: DataFrame,
    date_col: str,
    currency_col: str,
    amount_col: str,
    tie_break: Sequence[str] = ("rate_to_usd",),
    until: str | None = None,
) -> DataFrame:
    """Add the as-of rate to the common currency and the converted amount.

    Rate and amount are multiplied at scale 9 and 6, so the product keeps nine decimals. Facts before their
    currency's first rate, or after ``until``, have neither.
    """
    joined = with_rate(facts, daily_rates(rates, until, tie_break), date_col, currency_col, rate="_rate", rate_date="rate_date")
    amount = F.col(amount_col).cast("decimal(22,6)")
    return (
        joined.withColumn("exchange_rate_to_usd", F.col("_rate").cast("decimal(38,9)"))
        .withColumn("total_value_usd", (amount * F.col("_rate")).cast("decimal(38,9)"))
        .drop("_rate")
    )


def whole_rates(days: DataFrame) -> DataFrame:
    """Daily rates in whole billionths, as doubles: made once for a rate, not for each fact that meets it."""
    return days.withColumn("rate_to_usd", (F.col("rate_to_usd") * BILLION).cast("bigint").cast("double"))


def cross_rate(source: str, target: str, source_rate: str, target_rate: str) -> Column:
    """How much of the target currency one unit of the source currency is; 1 if they are the same.

    The rates come from :func:`whole_rates`.
    """
    return F.when(F.col(source) == F.col(target), F.lit(1.0)).otherwise(F.col(source_rate) / F.nullif(F.col(target_rate), F.lit(0.0)))


def trade_costs(txns: DataFrame, dim_asset: DataFrame, days: DataFrame) -> DataFrame:
    """Transactions with ``cost_basis_currency``, their asset's currency, and ``buy_cost``, what a buy cost in it.

    A buy in another currency is converted at the rates of its date, to a millionth; without a rate, or without a known
    asset, its cost is null. Other transactions cost 0. ``days`` is the result of :func:`daily_rates`.
    """
    own = dim_asset.select("asset_key", F.col("currency_code").alias("cost_basis_currency"))
    named = txns.join(own, "asset_key", "left")
    whole = whole_rates(days)
    paid = with_rate(named, whole, "transaction_date", "currency_code", rate="_paid")
    both = with_rate(paid, whole, "transaction_date", "cost_basis_currency", rate="_own")
    cost = (F.col("quantity").cast("decimal(22,6)") * F.col("price_per_unit").cast("decimal(18,6)")).cast("decimal(28,9)")
    millionths = F.round(cost * 1_000_000).cast("bigint").cast("double")
    ratio = cross_rate("currency_code", "cost_basis_currency", "_paid", "_own")
    converted = F.round(millionths * ratio).cast("bigint").cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")
    in_own = F.when(F.col("currency_code") == F.col("cost_basis_currency"), cost).otherwise(converted.cast("decimal(28,9)"))
    nothing = F.lit(0).cast("decimal(28,9)")
    return both.withColumn("buy_cost", F.when(F.col("transaction_type") == "BUY", in_own).otherwise(nothing)).drop("_paid", "_own")
