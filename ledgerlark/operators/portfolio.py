"""Holdings, cost basis, valuation, portfolio snapshots and their history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.functions import asset_key
from ledgerlark.operators.currency import cross_rate, whole_rates, with_rate
from ledgerlark.operators.prices import latest_per_key
from ledgerlark.operators.quality import price_quality

POSITION = ["user_id", "asset_key"]
# Scales that keep quantity x price exact: (22,6) x (18,6) is a (38,9) product.
QUANTITY, PRICE = "decimal(22,6)", "decimal(18,6)"
AMOUNT = "decimal(38,9)"


def signed_quantity(kind: str = "transaction_type", quantity: str = "quantity") -> Column:
    """Units a transaction adds: BUY and SPLIT add, SELL takes, DIVIDEND changes nothing."""
    k, q = F.col(kind), F.col(quantity).cast(QUANTITY)
    return (
        F.when(k.isin("BUY", "SPLIT"), q)
        .when(k == "SELL", -q)
        .otherwise(F.lit(0).cast(QUANTITY))
    )


def bought_quantity() -> Column:
    is_buy = F.col("transaction_type") == "BUY"
    return F.when(is_buy, F.col("quantity")).otherwise(0).cast(QUANTITY)


def average_cost(cost: Column | str, quantity: Column | str) -> Column:
    """Weighted average purchase price, unrounded; null if nothing was bought or a cost is unknown."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.when(quantity > 0, cost.cast("double") / quantity.cast("double"))


def upto(txns: DataFrame, as_of: str | None, date: str = "transaction_date") -> DataFrame:
    return txns if as_of is None else txns.filter(F.col(date) <= F.lit(as_of).cast("date"))


def holdings(txns: DataFrame, as_of: str | None = None, by: Sequence[str] = POSITION) -> DataFrame:
    """Units held per position at a date."""
    held = F.sum(signed_quantity()).cast(AMOUNT).alias("quantity_held")
    return upto(txns, as_of).groupBy(*by).agg(held)


def cost_sums() -> list[Column]:
    """Sums of a position's trades, numbers only, so that they are added up by hash with partial sums."""
    return [
        F.sum(signed_quantity()).alias("_q"),
        F.sum(bought_quantity()).alias("_bq"),
        F.sum("buy_cost").alias("_bc"),
        F.sum(F.col("buy_cost").isNull().cast("int")).alias("_unknown"),
    ]


def known_cost(cost: Column, unknown: Column) -> Column:
    """The cost, null where that of any buy is unknown."""
    return F.when(unknown == 0, cost).cast(AMOUNT)


def positions(txns: DataFrame, as_of: str | None = None, by: Sequence[str] = POSITION) -> DataFrame:
    """One row a position: units held and bought, and what the buys cost in the asset's currency.

    ``txns`` comes from :func:`ledgerlark.operators.currency.trade_costs`, so that trades of an asset in several
    currencies are one position. Selling does not change the average.
    """
    return upto(txns, as_of).groupBy(*by, "cost_basis_currency").agg(*cost_sums()).select(
        *by,
        "cost_basis_currency",
        F.col("_q").cast(AMOUNT).alias("quantity_held"),
        F.col("_bq").cast(AMOUNT).alias("quantity_bought"),
        known_cost(F.col("_bc"), F.col("_unknown")).alias("purchase_cost"),
    )


def cost_basis(txns: DataFrame, as_of: str | None = None, by: Sequence[str] = POSITION) -> DataFrame:
    """Units bought, their cost in the asset's currency and the average purchase price, commission excluded."""
    held = positions(txns, as_of, by).drop("quantity_held")
    return held.withColumn("avg_cost_basis", average_cost("purchase_cost", "quantity_bought"))


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, blocks: Sequence[Column]
) -> DataFrame:
    """Running sum per group in ``order``, inclusive of the row itself.

    Rows are cut into ``blocks``, expressions that grow with the order, such as the day. One
    window over the sums per block gives each block's opening balance, one over the rows of a
    block adds to it; no task sorts a whole group, and every row takes the same way.
    """
    by, levels = list(by), [f"_b{i}" for i in range(len(blocks))]
    rest = [c for c in df.columns if c not in by]
    block = F.struct(*by, *[b.alias(n) for n, b in zip(levels, blocks)])  # null equals null
    cut = df.select(*rest, value.alias("_value"), block.alias("_block"))
    totals = cut.groupBy("_block").agg(F.sum("_value").alias("_total"))
    groups, in_turn = [[F.col(f"_block.{c}") for c in cols] for cols in (by, levels)]
    earlier = Window.partitionBy(*groups).orderBy(*in_turn).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0)).cast(AMOUNT)
    opening = totals.select("_block", before.alias("_before"))
    # The window comes before the join, so that one shuffle of the rows by their block serves both.
    inside = Window.partitionBy("_block").orderBy(*[o for o in order if o not in by]).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumn("_sum", F.sum("_value").over(inside))
    columns = [F.col(f"_block.{c}").alias(c) if c in by else F.col(c) for c in df.columns]
    return summed.join(opening, "_block").select(*columns, (F.col("_before") + F.col("_sum")).cast(AMOUNT).alias(name))


def running_holdings(txns: DataFrame, order: Sequence[str], blocks: Sequence[Column]) -> DataFrame:
    """Units held after every transaction."""
    return running_total(txns, POSITION, order, signed_quantity(), "quantity_held", blocks)


def with_value(df: DataFrame, price: str = "current_price") -> DataFrame:
    """Average and total cost and market value of positions that carry a price column."""
    held = F.col("quantity_held")
    value = (held.cast(QUANTITY) * F.col(price).cast(PRICE)).cast(AMOUNT)
    return (
        df.withColumn("avg_cost_basis", average_cost("purchase_cost", "quantity_bought"))
        .withColumn("total_cost_basis", F.col("avg_cost_basis") * held.cast("double"))
        .withColumn("market_value", value)
        .withColumn("_value", F.col("market_value").cast("double"))
    )


def with_gain(df: DataFrame, days: DataFrame) -> DataFrame:
    """Unrealized gain of the rows of :func:`with_value` at the rates of their ``snapshot_date``."""
    whole = whole_rates(days)
    rated = with_rate(df, whole, "snapshot_date", "price_currency", rate="_price_rate")
    return _gained(with_rate(rated, whole, "snapshot_date", "cost_basis_currency", rate="_cost_rate"))


def _gained(rated: DataFrame) -> DataFrame:
    cost, gain = F.col("total_cost_basis"), F.col("unrealized_gain_loss")
    ratio = cross_rate("price_currency", "cost_basis_currency", "_price_rate", "_cost_rate")
    return (
        rated.withColumn("unrealized_gain_loss", F.col("_value") * ratio - cost)
        .withColumn("unrealized_gain_loss_pct", F.when(cost != 0, F.lit(100.0) * gain / cost))
        .drop("_price_rate", "_cost_rate", "_value")
    )


def value_positions(df: DataFrame, days: DataFrame, price: str = "current_price") -> DataFrame:
    """Market value and unrealized gain of positions that carry a price column and a ``snapshot_date``.

    The value is in the price's currency. The gain is in the cost's: a value in another currency is converted at the
    rates of the day (``days``, see :func:`ledgerlark.operators.currency.daily_rates`). Value and gain are null
    without a price, the gain also without a rate or a known cost, the percentage also when the cost is zero.
    """
    return with_gain(with_value(df, price), days)


SNAPSHOT = (
    "snapshot_date", *POSITION, "quantity_held", "avg_cost_basis", "total_cost_basis", "cost_basis_currency",
    "current_price", "price_currency", "price_date", "market_value", "unrealized_gain_loss", "unrealized_gain_loss_pct",
)


def portfolio_snapshot(
    txns: DataFrame,
    prices: DataFrame,
    days: DataFrame,
    as_of: str,
    max_age_days: int = 5,
    last_open: str | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Every open position at a date, one row each, with its cost, as-of price, value and quality flag.

    Closed positions are left out, negative ones stay. ``txns`` comes from ``trade_costs``, ``days`` from
    ``daily_rates``. ``prices`` has asset_key, snapshot_date, close_price, price_currency; of several rows of
    an asset and date the greatest by ``tie_break`` counts. A single date needs no ordered
    pass: the as-of price is one partial aggregate.
    """
    day = F.lit(as_of).cast("date")
    held = positions(txns, as_of).filter("quantity_held <> 0").withColumn("snapshot_date", day)
    quoted = latest_per_key(
        upto(prices, as_of, "snapshot_date"),
        ["asset_key"],
        ["snapshot_date", *tie_break],
        keep=["snapshot_date", "close_price", "price_currency"],
    ).select(
        "asset_key",
        F.col("snapshot_date").alias("price_date"),
        F.col("close_price").cast(AMOUNT).alias("current_price"),
        "price_currency",
    )
    open_day = None if last_open is None else F.lit(last_open).cast("date")
    valued = value_positions(held.join(quoted, "asset_key", "left"), days.filter(F.col("rate_day") == day))
    return valued.select(*SNAPSHOT, price_quality(F.col("price_date"), day, max_age_days, open_day).alias("data_quality"))


def store_snapshot(snapshot: DataFrame, calculated_at: Column) -> DataFrame:
    """A snapshot in the declared types of its table."""
    rounded = ["avg_cost_basis", "total_cost_basis", "unrealized_gain_loss", "unrealized_gain_loss_pct"]
    return snapshot.select(
        *[
            F.col(c).cast(AMOUNT).alias(c) if c in rounded else F.col(c)
            for c in snapshot.columns
            if c not in ("price_date", "data_quality")
        ],
        calculated_at.cast("timestamp").alias("calculated_at"),
        "data_quality",
    )


def _runs(changes: DataFrame, by: Sequence[str], date: str, end: str, until: str) -> DataFrame:
    """Change rows with the last day, up to ``end``, on which each is the current one."""
    following = F.lead(date).over(Window.partitionBy(*by).orderBy(date))
    return changes.withColumn(until, F.coalesce(F.date_sub(following, 1), F.lit(end).cast("date")))


def portfolio_history(
    txns: DataFrame,
    prices: DataFrame,
    days: DataFrame,
    start: str,
    end: str,
    max_age_days: int = 5,
    tie_break: Sequence[str] = (),
    since: DataFrame | None = None,
    piece_days: int | None = None,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per open position and day of [start, end], valued at the as-of price.

    Everything before ``start`` counts as of ``start``: it is summed up (transactions) or
    reduced to the last quote (prices) by a partial aggregate, so the running pass sees at
    most one row per position and day of the range. Holdings and quotes meet as runs of days, one row each, by
    asset; what overlaps is valued once and only then spread over its days, so no row of a day is ever
    shuffled. ``txns`` and ``days`` as for a snapshot.

    With ``since``, a row for a position with its ``from_day``, only these positions are listed, each from that day on.
    With ``piece_days`` the valued runs are cut at every so many days from ``start`` and dealt to tasks by piece, under a
    rebalancing hint: a task then has many rows of few days, fit to be written as it is. ``also`` names further columns, made
    of ``market_value`` and others that a run has, once for a run and not for each of its days.
    """
    first = F.lit(start).cast("date")
    held_by = [*POSITION, "cost_basis_currency"]
    running = Window.partitionBy(*held_by).orderBy("transaction_date").rowsBetween(
        Window.unboundedPreceding, 0
    )
    daily = (
        upto(txns, end)
        .withColumn("transaction_date", F.greatest("transaction_date", first))
        .groupBy(*held_by, "transaction_date")
        .agg(*cost_sums())
    )
    so_far = {c: F.sum(c).over(running) for c in ("_q", "_bq", "_bc", "_unknown")}
    changes = daily.select(
        *held_by,
        "transaction_date",
        so_far["_q"].cast(AMOUNT).alias("quantity_held"),
        so_far["_bq"].cast(AMOUNT).alias("quantity_bought"),
        known_cost(so_far["_bc"], so_far["_unknown"]).alias("purchase_cost"),
    )
    held = _runs(changes, held_by, "transaction_date", end, "_until").filter("quantity_held <> 0")
    if since is not None:
        wanted = held.join(since.select(*POSITION, "from_day"), POSITION).filter(F.col("_until") >= F.col("from_day"))
        held = wanted.withColumn("transaction_date", F.greatest("transaction_date", "from_day")).select(*held.columns)
    quotes = latest_per_key(
        upto(prices, end, "snapshot_date").select(
            "asset_key",
            F.greatest("snapshot_date", first).alias("effective"),
            F.col("snapshot_date").alias("price_date"),
            F.col("close_price").cast(AMOUNT).alias("current_price"),
            "price_currency",
            *tie_break,
        ),
        ["asset_key", "effective"],
        ["price_date", *tie_break],
        keep=["price_date", "current_price", "price_currency"],
    )
    priced = _runs(_from_the_first_day(quotes, first), ["asset_key"], "effective", end, "_good_until")
    quoted = priced.withColumnRenamed("asset_key", "_asset")
    meet = (F.col("asset_key") == F.col("_asset")) & (F.col("effective") <= F.col("_until")) & (F.col("_good_until") >= F.col("transaction_date"))
    valued = with_value(held.join(quoted, meet, "left")).withColumns(dict(also or {}))
    # Without a quote both ends are the holding's own: null is passed over.
    begin, until = F.greatest("transaction_date", "effective"), F.least("_until", "_good_until")
    runs = valued if piece_days is None else _pieces(valued, begin, until, first, piece_days)
    days_of = F.sequence(begin, until) if piece_days is None else F.sequence("_begin", "_end")
    # A run meets the rates of its currencies once, as arrays; a day of it takes its rates by their place.
    rates, place = _rate_lists(days, first, F.lit(end).cast("date")), F.datediff("snapshot_date", first)
    for name in ("price_currency", "cost_basis_currency"):
        own = rates.select(F.col("_code").alias(f"_code_{name}"), F.col("_rates").alias(f"_rates_{name}"))
        runs = runs.join(F.broadcast(own), F.col(name) == F.col(f"_code_{name}"), "left").drop(f"_code_{name}")
    daily_rows = runs.withColumn("snapshot_date", F.explode(days_of)).drop("transaction_date", "effective", "_until", "_good_until", "_asset", "_begin", "_end", "_piece")
    rated = daily_rows.withColumns({"_price_rate": F.get("_rates_price_currency", place), "_cost_rate": F.get("_rates_cost_basis_currency", place)})
    return _gained(rated).select(
        *SNAPSHOT, *(also or ()), price_quality(F.col("price_date"), F.col("snapshot_date"), max_age_days).alias("data_quality")
    )


def _rate_lists(days: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each currency with its :func:`whole_rates` of the days from ``first`` to ``last``, null where there is none."""
    near = whole_rates(days.filter(F.col("rate_day").between(first, last)))
    rate = F.struct(F.datediff("rate_day", first).alias("at"), F.col("rate_to_usd").alias("rate"))
    none = F.transform(F.sequence(F.lit(0), F.datediff(last, first)), lambda i: F.struct(i.alias("at"), F.lit(None).cast("double").alias("rate")))
    listed = near.groupBy(F.col("currency_code").alias("_code")).agg(F.collect_list(rate).alias("l"))
    whole = listed.select("_code", F.explode(F.concat("l", none)).alias("e")).groupBy("_code", "e.at").agg(F.max("e.rate").alias("rate"))
    in_turn = F.sort_array(F.collect_list(F.struct("at", "rate"))).alias("l")
    return whole.groupBy("_code").agg(in_turn).select("_code", F.col("l.rate").alias("_rates"))


def _pieces(runs: DataFrame, begin: Column, until: Column, first: Column, size: int) -> DataFrame:
    """Runs cut at every ``size`` days from ``first``, dealt to tasks by their piece; ``_begin`` and ``_end`` of each."""
    ends = runs.withColumns({"_begin": begin, "_end": until}).drop("transaction_date", "effective", "_until", "_good_until", "_asset")
    number = lambda day: F.floor(F.datediff(day, first) / size).cast("int")
    cut = ends.withColumn("_piece", F.explode(F.sequence(number(F.col("_begin")), number(F.col("_end")))))
    opens = F.date_add(first, F.col("_piece") * size)
    own = {"_begin": F.greatest("_begin", opens), "_end": F.least("_end", F.date_add(opens, size - 1))}
    return cut.withColumns(own).hint("rebalance", F.col("_piece"))


def _from_the_first_day(quotes: DataFrame, first: Column) -> DataFrame:
    """Quotes and, for an asset whose first one comes later than ``first``, an empty one from there on."""
    late = quotes.groupBy("asset_key").agg(F.min("effective").alias("_first")).filter(F.col("_first") > first)
    empty = late.select("asset_key", first.alias("effective"))
    return quotes.unionByName(empty, allowMissingColumns=True)


# An amount as whole numbers, each below a billion: billionths, units, and what is left in billions and in billions of them.
PARTS = ("_part0", "_part1", "_part2", "_part3")


def amount_parts(amount: str = "market_value") -> dict[str, Column]:
    """The parts of an amount, with its sign; null where there is none. Their sums add up faster than decimals."""
    billion, value = F.lit(1_000_000_000).cast("decimal(10,0)"), F.col(amount).cast(AMOUNT)
    left = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    parts = [(value % F.lit(1).cast("decimal(1,0)")).cast("decimal(10,9)") * billion]
    for digits in (22, 13):
        parts.append(left % billion)
        left = ((left - parts[-1]) / billion).cast(f"decimal({digits},0)")
    return {name: part.cast("bigint") for name, part in zip(PARTS, [*parts, left])}


def amount_sums() -> list[Column]:
    """Sums of the parts of up to nine billion amounts."""
    return [F.sum(c).alias(c) for c in PARTS]


def amount_total() -> Column:
    """The sum of all amounts, exact, from sums of their parts; null if there was none. It holds totals below 10 ** 27."""
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(20,0)") for c in PARTS]
    scales = ("0.000000001", "1", "1000000000", "1000000000000000000")
    kinds = ("decimal(10,9)", "decimal(1,0)", "decimal(10,0)", "decimal(19,0)")
    terms = [(total * F.lit(x).cast(kind)).cast("decimal(36,9)") for total, x, kind in zip(sums, scales, kinds)]
    return ((terms[0] + terms[1]) + (terms[2] + terms[3])).cast(AMOUNT)


def portfolio_rollup(
    snapshot: DataFrame, dim_asset: DataFrame, levels: Sequence[str], currency: str = "price_currency"
) -> DataFrame:
    """Totals per currency and every prefix of ``levels``, with the positions counted.

    The currency is the snapshot's, that of the market value; amounts of different
    currencies are never added. The finest grain is summed first, so
    only its groups, not the positions, are repeated for the coarser levels.
    """
    joined = snapshot.join(dim_asset.select("asset_key", *levels), "asset_key", "left")
    finest = joined.groupBy(currency, *levels).agg(
        F.count(F.lit(1)).alias("positions"),
        F.count_if(F.col("data_quality") != "COMPLETE").alias("flagged"),
        F.sum("market_value").alias("market_value"),
    )
    sets = [[F.col(c) for c in (currency, *levels[:n])] for n in range(len(levels) + 1)]
    return finest.groupingSets(sets, currency, *levels).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("positions").alias("positions"),
        F.sum("flagged").alias("flagged"),
        F.sum("market_value").cast(AMOUNT).alias("market_value"),
    )


def enrich(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, date: str) -> DataFrame:
    """Facts with their asset and date attributes; unmatched facts stay.

    No hints: a small dimension is broadcast by its measured size, a large one is shuffled.
    """
    days = dim_date.withColumnRenamed("full_date", date)
    return fact.join(dim_asset, "asset_key", "left").join(days, date, "left")


def enrich_chosen_days(
    fact: DataFrame, dim_asset: DataFrame, days: DataFrame, date: str, partition: dict[str, Column] | None = None
) -> DataFrame:
    """Facts of the days that a filtered date dimension leaves, with their asset and date attributes.

    The fact must be a table partitioned by ``date``, or by the columns of ``partition``, which gives each of them as an
    expression over the dimension's ``full_date``. The days are known only at run time; Spark then prunes the fact's
    partitions by them before it reads a file (dynamic partition pruning), provided that it broadcasts the days, as it does
    by their measured size.
    """
    chosen = days.withColumns(partition or {}).withColumnRenamed("full_date", date)
    return fact.join(chosen, [date, *(partition or {})]).join(dim_asset, "asset_key", "left")


def missing_assets(txns: DataFrame, dim_asset: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Assets that transactions name and the dimension lacks, with their new keys."""
    named = txns.select(*natural).distinct()
    unknown = named.join(dim_asset.select(*natural), list(natural), "left_anti")
    return unknown.select(asset_key(*natural).alias("asset_key"), *natural)


def investment_snapshot(holding: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Local value of each asset held per day: quantity times the day's price.

    Without ``prices`` the holdings carry their ``close_price`` and nothing is joined.
    """
    priced = holding if prices is None else holding.join(prices, ["asset_key", "snapshot_date"])
    value = F.col("quantity").cast(QUANTITY) * F.col("close_price").cast(PRICE)
    return priced.select(
        F.col("snapshot_date").cast("timestamp").alias("snapshot_timestamp"),
        "snapshot_date",
        "asset_key",
        "quantity",
        F.col("close_price").cast(AMOUNT).alias("price_per_unit_local"),
        value.cast(AMOUNT).alias("total_value_local"),
    )

