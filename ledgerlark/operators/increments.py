"""A stored portfolio history that follows its trades and prices without being rebuilt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators.portfolio import POSITION, portfolio_history
from ledgerlark.session import fresh_path
from ledgerlark.sinks import file_table


PIECE_DAYS = 16  # that a task writes at most


def dirty_by_trades(delivered: DataFrame) -> DataFrame:
    """Positions with new trades, and the first day on which each changes."""
    return delivered.groupBy(*POSITION).agg(F.min("transaction_date").alias("from_day"))


def dirty_by_prices(delivered: DataFrame, txns: DataFrame) -> DataFrame:
    """Positions whose asset has a new price, and the first day on which their value changes."""
    assets = delivered.groupBy("asset_key").agg(F.min("snapshot_date").alias("from_day"))
    return txns.select(*POSITION).distinct().join(assets, "asset_key").select(*POSITION, "from_day")


def refresh_history(
    spark: SparkSession,
    path: str,
    txns: DataFrame,
    prices: DataFrame,
    days: DataFrame,
    new_txns: DataFrame | None,
    start: str,
    end: str,
    new_prices: DataFrame | None = None,
    max_age_days: int = 5,
    tie_break: Sequence[str] = (),
) -> dict[str, list[str]]:
    """Bring the history table at ``path`` up to date after a delivery; returns the files kept, replaced and written.

    ``txns`` and ``prices`` hold everything that is known, the delivery included. A new trade, or price, dirties
    its position from its date on. Only these ranges are computed, from the trades and quotes of their positions and assets, and
    only files that hold a row of them are rewritten. Positions have a user and an asset. The first call makes the table.
    Rows of a day are not shuffled: runs of days are dealt to the tasks that write their days, and rows that stay are copied
    where they are read.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    found = [dirty_by_trades(new_txns)] if new_txns is not None else []
    found += [dirty_by_prices(new_prices, txns)] if new_prices is not None else []
    if not found:
        raise ValueError("a delivery has trades or prices")
    whole = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    ranges = whole.groupBy(*POSITION).agg(F.greatest(F.min("from_day"), first).alias("from_day")).filter(F.col("from_day") <= last)
    place = fresh_path(spark, "dirty-positions")
    ranges.write.parquet(place)
    dirty = spark.read.schema(ranges.schema).parquet(place)

    earliest = dirty.agg(F.min("from_day").cast("string")).first()[0]
    made = file_table.exists(spark, path)
    if earliest is None and made:
        return {"kept": file_table.files(spark, path), "rewritten": [], "new": []}
    mine = txns.join(dirty.select(*POSITION), POSITION, "left_semi")
    quotes = prices.join(dirty.select("asset_key").distinct(), "asset_key", "left_semi")
    fresh = portfolio_history(
        mine, quotes, days, earliest or start, end, max_age_days, tie_break=tie_break, since=dirty, piece_days=PIECE_DAYS
    )
    if not made:
        return file_table.swap(spark, path, [], [], "snapshot_date", POSITION, dealt=[fresh])
    within = F.col("t.snapshot_date") >= F.col("h.from_day")
    later = file_table.read(spark, path).filter(F.col("snapshot_date") >= F.lit(earliest).cast("date"))
    return file_table.replace_rows(spark, path, dirty, POSITION, within, fresh, "snapshot_date", POSITION, later)
