"""Moving-average cost: a sale takes its share of the cost with it, a closed position starts afresh.

Once the running quantity is known, each trade maps the cost before it to the cost after it by c -> a * c + b.
Such maps compose, so no task has to walk a whole position: trades are cut into small pieces, a
piece's maps become one, the pieces of a day become one, and the days of a position are walked, a map
each. The cost with which a day and then a piece opens goes back to the trades, which are walked inside their piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.operators.portfolio import AMOUNT, POSITION, signed_quantity

PIECE = 256  # trades
MAP = "struct<a:double,b:double>"


def trade_map() -> tuple[Column, Column]:
    """(a, b) of a trade, given ``quantity_held`` after it and ``_value``, what it added.

    A buy adds its cost, less what covers a short position; a sale leaves the share that is still held; a
    split or dividend changes nothing. Nothing held, or short, costs nothing.
    """
    kind, after = F.col("transaction_type"), F.col("quantity_held").cast("double")
    before, bought = (F.col("quantity_held") - F.col("_value")).cast("double"), F.col("quantity").cast("double")
    cost = F.col("buy_cost").cast("double")
    a = F.when((after <= 0) | (before <= 0), 0.0).when(kind == "SELL", after / before).otherwise(1.0)
    added = F.when(before >= 0, cost).otherwise(cost * after / bought)
    b = F.when((kind == "BUY") & (after > 0), added).otherwise(0.0)
    return a, b


def applied(m: Column, cost: Column) -> Column:
    """The cost after a map; where a map forgets what was before, also an unknown cost is forgotten."""
    return F.when(m["a"] == 0, m["b"]).otherwise(m["a"] * cost + m["b"])


def after(first: Column, second: Column) -> Column:
    """The map that is ``first`` and then ``second``."""
    return F.struct((second["a"] * first["a"]).alias("a"), applied(second, first["b"]).alias("b"))


def unchanged() -> Column:
    return F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")).cast(MAP)


def composed(maps: Column) -> Column:
    return F.aggregate(maps, unchanged(), lambda s, m: after(s, m).cast(MAP))


def composed_before(maps: Column) -> Column:
    """For each place the composition of the maps before it."""
    start = F.struct(unchanged().alias("m"), F.array().cast(f"array<{MAP}>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        return F.struct(after(s["m"], m).cast(MAP).alias("m"), F.concat(s["out"], F.array(s["m"])).alias("out"))

    return F.aggregate(maps, start, step, lambda s: s["out"])


def walked(maps: Column, opening: Column) -> Column:
    """The cost before the first map and after each one."""
    start = F.struct(opening.alias("c"), F.array(opening).cast("array<double>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        cost = applied(m, s["c"])
        return F.struct(cost.alias("c"), F.concat(s["out"], F.array(cost)).alias("out"))

    return F.aggregate(maps, start, step, lambda s: s["out"])


def moving_cost(
    txns: DataFrame, order: Sequence[str], by: Sequence[str] = POSITION, block: str = "transaction_date", piece: int = PIECE
) -> DataFrame:
    """Every transaction with ``quantity_held`` and ``moving_cost`` of its position after it.

    ``txns`` comes from :func:`ledgerlark.operators.currency.trade_costs`. ``order`` orders a position's trades,
    its first column being ``block``, a date as a rule. A buy of unknown cost makes the cost null until the position is
    closed. No task sorts more than a position's block or holds more than a position's blocks, one map each.
    """
    # What all trades of a block share travels once, in its key.
    shared = [*by, *([] if block in by else [block])]
    rest = [c for c in txns.columns if c not in shared]
    position = F.struct(*[F.col(f"_block.{c}").alias(c) for c in by]).alias("_pos")
    at = F.col(f"_block.{block}").alias("_at")
    # A position's block, again from both: it doesn't travel beside them.
    of_position = F.struct(*[(F.col("_at") if c == block else F.col(f"_pos.{c}")).alias(c) for c in shared]).alias("_block")
    dealt = txns.select(*rest, F.struct(*shared).alias("_block")).repartition("_block")
    cut = dealt.withColumn("_value", signed_quantity())
    inside = Window.partitionBy("_block").orderBy(*[o for o in order if o not in shared])
    sums = F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    numbered = cut.select("*", F.row_number().over(inside).alias("_n"), sums.alias("_sum"))

    # The sums name every column (the condition always holds), so that they are made from the same shuffle as the rows.
    same = F.pmod(F.xxhash64(*rest), F.lit(1)) == 0
    totals = cut.groupBy("_block").agg(F.sum(F.when(same, F.col("_value"))).alias("_sum")).select(position, at, "_sum")
    earlier = Window.partitionBy("_pos").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast(AMOUNT)).select(of_position, "_before")
    held = numbered.join(opening, "_block").withColumn("quantity_held", (F.col("_before") + F.col("_sum")).cast(AMOUNT))

    a, b = trade_map()
    trade = F.struct("_n", F.struct(a.alias("a"), b.alias("b")).cast(MAP).alias("m"), "quantity_held", F.struct(*rest).alias("row"))
    pieces = (
        held.select("_block", F.floor((F.col("_n") - 1) / piece).alias("_piece"), trade.alias("t"))
        .groupBy("_block", "_piece")
        .agg(F.sort_array(F.collect_list("t")).alias("trades"))
    )
    small = pieces.select("_block", "_piece", composed(F.col("trades.m")).alias("m"))
    of_blocks = (
        small.groupBy("_block")
        .agg(F.sort_array(F.collect_list(F.struct("_piece", "m"))).alias("p"))
        .select(position, at, F.when(F.size("p") > 1, composed_before(F.col("p.m"))).alias("before"), composed(F.col("p.m")).alias("m"))
    )
    in_turn = of_blocks.groupBy("_pos").agg(F.sort_array(F.collect_list(F.struct("_at", "before", "m"))).alias("p"))
    costs = F.slice(walked(F.col("p.m"), F.lit(0.0)), F.lit(1), F.size("p"))
    opened = in_turn.select("_pos", F.explode(F.arrays_zip(F.col("p").alias("p"), costs.alias("c"))).alias("o"))
    opened = opened.select(*[F.col(f"_pos.{c}").alias(c) for c in by if c != block], F.col("o.p._at").alias(block), F.col("o.p.before").alias("_maps"), F.col("o.c").alias("_open"))
    opened = opened.select(F.struct(*shared).alias("_block"), "_maps", "_open")

    # A block of a single piece has no maps before it.
    entry = applied(F.coalesce(F.get("_maps", F.col("_piece").cast("int")), unchanged()), F.col("_open"))
    met = pieces.join(opened, "_block").select("_block", "trades", entry.alias("_entry"))
    states = F.slice(walked(F.col("trades.m"), F.col("_entry")), F.lit(2), F.size("trades"))
    rows = met.select("_block", F.explode(F.arrays_zip(F.col("trades").alias("t"), states.alias("c"))).alias("x"))
    columns = [F.col(f"_block.{c}" if c in shared else f"x.t.row.{c}").alias(c) for c in txns.columns]
    return rows.select(*columns, F.col("x.t.quantity_held").alias("quantity_held"), F.col("x.c").alias("moving_cost"))
