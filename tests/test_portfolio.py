from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import currency, increments, moving_cost, portfolio
from ledgerlark.schemas import PORTFOLIO_SNAPSHOT
from ledgerlark.sinks import file_table


@pytest.fixture(scope="module")
def days(spark):
    """A dollar is a dollar; a peso is a thousandth, from 5 January on two thousandths."""
    rows = [("USD", "2020-01-01", "1"), ("ARS", "2020-01-01", "0.001"), ("ARS", "2024-01-05", "0.002")]
    rates = spark.createDataFrame(rows, "currency_code string, d string, r string").select(
        "currency_code", F.col("d").cast("date").alias("rate_date"), F.col("r").cast("decimal(15,9)").alias("rate_to_usd")
    )
    return currency.daily_rates(rates, "2024-12-31")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(k, "USD") for k in range(1, 9)], "asset_key long, currency_code string")


@pytest.fixture(scope="module")
def txns(bare, dim, days):
    return currency.trade_costs(bare, dim, days)


@pytest.fixture(scope="module")
def bare(spark):
    rows = [
        ("u", 1, "2024-01-01", "BUY", 10, 5),
        ("u", 1, "2024-01-02", "BUY", 10, 7),
        ("u", 1, "2024-01-03", "SELL", 5, 9),
        ("u", 1, "2024-01-04", "DIVIDEND", 1, 1),
        ("u", 2, "2024-01-01", "SELL", 3, 4),
        ("u", 3, "2024-01-01", "BUY", 4, 1),
        ("u", 3, "2024-01-02", "SELL", 4, 2),
        ("u", 4, "2024-01-01", "BUY", 2, 10),
        ("u", 1, "2024-02-01", "BUY", 100, 1),
    ]
    df = spark.createDataFrame(rows, "user_id string, asset_key long, d string, transaction_type string, q int, p int")
    return df.select(
        "user_id", "asset_key", F.col("d").cast("date").alias("transaction_date"), "transaction_type",
        F.col("q").cast("decimal(18,6)").alias("quantity"), F.col("p").cast("decimal(18,6)").alias("price_per_unit"),
        F.lit("USD").alias("currency_code"),
    )


@pytest.fixture(scope="module")
def prices(spark):
    rows = [(1, "2024-01-03", 8), (1, "2024-01-05", 9), (1, "2024-01-20", 99), (2, "2023-12-01", 4)]
    df = spark.createDataFrame(rows, "asset_key long, d string, p int")
    return df.select("asset_key", F.col("d").cast("date").alias("snapshot_date"),
                     F.col("p").cast("decimal(18,6)").alias("close_price"), F.lit("USD").alias("price_currency"))


def test_snapshot(txns, prices, days):
    got = {r["asset_key"]: r for r in portfolio.portfolio_snapshot(txns, prices, days, "2024-01-06").collect()}
    assert set(got) == {1, 2, 4}  # 3 is closed
    one = got[1]
    assert (one["quantity_held"], one["avg_cost_basis"], one["total_cost_basis"]) == (15, 6.0, 90.0)
    assert (one["current_price"], one["market_value"], one["unrealized_gain_loss"]) == (9, 135, 45.0)
    assert (one["unrealized_gain_loss_pct"], one["data_quality"]) == (50.0, "COMPLETE")
    short = got[2]
    assert (short["quantity_held"], short["avg_cost_basis"], short["data_quality"]) == (-3, None, "STALE_PRICE")
    missing = got[4]
    assert (missing["market_value"], missing["unrealized_gain_loss"], missing["data_quality"]) == (None, None, "MISSING_PRICE")
    assert missing["total_cost_basis"] == 20.0


def test_last_open_day_decides_staleness(txns, prices, days):
    def flag(**kw):
        return portfolio.portfolio_snapshot(txns, prices, days, "2024-01-06", **kw).filter("asset_key = 1").first()["data_quality"]

    assert flag(last_open="2024-01-05") == "COMPLETE"
    assert flag(last_open="2024-01-06") == "STALE_PRICE"


def test_stored_snapshot_has_the_declared_types(txns, prices, days):
    stored = portfolio.store_snapshot(
        portfolio.portfolio_snapshot(txns, prices, days, "2024-01-06"), F.lit("2024-01-07 00:00:00")
    )
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in PORTFOLIO_SNAPSHOT]
    assert stored.filter("asset_key = 1").first()["avg_cost_basis"] == Decimal("6.000000000")


def test_history_equals_daily_snapshots(txns, prices, days):
    history = portfolio.portfolio_history(txns, prices, days, "2024-01-02", "2024-01-06")
    assert history.filter("asset_key = 1").count() == 5
    for day in ("2024-01-02", "2024-01-03", "2024-01-06"):
        snapshot = portfolio.portfolio_snapshot(txns, prices, days, day)
        same = history.filter(F.col("snapshot_date") == day).select(*[c for c in history.columns])
        assert sorted(map(str, same.collect())) == sorted(map(str, snapshot.select(*history.columns).collect()))


def test_history_spreads_over_days_after_prices_are_joined(txns, prices, days):
    history = portfolio.portfolio_history(txns, prices, days, "2024-01-02", "2024-01-06")
    lines = history._jdf.queryExecution().optimizedPlan().toString().splitlines()
    spread = next(i for i, line in enumerate(lines) if "Generate explode(sequence(" in line)
    assert not [line for line in lines[:spread] if "Join" in line and "asset_key" in line]


def test_missing_assets(spark):
    txns = spark.createDataFrame([("A", "X"), ("A", "X"), ("B", "X")], "ticker string, exchange string")
    dim = spark.createDataFrame([("B", "X")], "ticker string, exchange string")
    got = portfolio.missing_assets(txns, dim, ["ticker", "exchange"]).collect()
    assert [(r["ticker"], r["exchange"]) for r in got] == [("A", "X")]


def test_as_of_includes_the_day(txns):
    held = {r["asset_key"]: r["quantity_held"] for r in portfolio.holdings(txns, "2024-01-03").collect()}
    assert held[1] == 15


def trade(spark, rows):
    schema = "user_id string, asset_key long, d string, transaction_type string, q int, p int, currency_code string"
    return spark.createDataFrame(rows, schema).select(
        "user_id", "asset_key", F.col("d").cast("date").alias("transaction_date"), "transaction_type",
        F.col("q").cast("decimal(18,6)").alias("quantity"), F.col("p").cast("decimal(18,6)").alias("price_per_unit"), "currency_code",
        F.monotonically_increasing_id().alias("seq"),
    )


def test_a_position_closed_in_another_currency_is_closed(spark, dim, days, prices):
    both = trade(spark, [("u", 1, "2024-01-01", "BUY", 10, 2000, "ARS"), ("u", 1, "2024-01-02", "SELL", 10, 3, "USD")])
    costed = currency.trade_costs(both, dim, days)
    assert portfolio.portfolio_snapshot(costed, prices, days, "2024-01-06").count() == 0
    cost = portfolio.cost_basis(costed).collect()
    assert [(r["cost_basis_currency"], r["purchase_cost"], r["avg_cost_basis"]) for r in cost] == [("USD", 20, 2.0)]


def test_costs_are_converted_at_the_trade_date(spark, dim, days, prices):
    rows = [("u", 1, "2024-01-01", "BUY", 10, 2000, "ARS"), ("u", 1, "2024-01-05", "BUY", 10, 2000, "ARS"), ("u", 1, "2024-01-02", "BUY", 10, 6, "USD")]
    costed = currency.trade_costs(trade(spark, rows), dim, days)
    got = portfolio.portfolio_snapshot(costed, prices, days, "2024-01-06").collect()
    assert [(r["quantity_held"], r["total_cost_basis"], r["cost_basis_currency"], r["unrealized_gain_loss"]) for r in got] == [(30, 120.0, "USD", 150.0)]
    pesos = prices.withColumn("price_currency", F.lit("ARS")).withColumn("close_price", (F.col("close_price") * 1000).cast("decimal(18,6)"))
    far = portfolio.portfolio_snapshot(costed, pesos, days, "2024-01-06").first()
    assert (far["market_value"], far["price_currency"], far["unrealized_gain_loss"]) == (270_000, "ARS", 420.0)


def test_an_unknown_rate_or_asset_makes_the_cost_unknown(spark, dim, days, prices):
    rows = [("u", 1, "2024-01-01", "BUY", 10, 2, "EUR"), ("u", 1, "2024-01-02", "BUY", 10, 6, "USD"), ("u", 99, "2024-01-01", "BUY", 1, 1, "USD"),
            ("u", 2, "2019-01-01", "BUY", 1, 1, "ARS"), ("u", 2, "2024-01-02", "SELL", 3, 1, "EUR")]
    costed = currency.trade_costs(trade(spark, rows), dim, days)
    got = {r["asset_key"]: r for r in portfolio.portfolio_snapshot(costed, prices, days, "2024-01-06").collect()}
    assert [got[k]["quantity_held"] for k in (1, 2, 99)] == [20, -2, 1]
    assert all(got[k]["total_cost_basis"] is None and got[k]["unrealized_gain_loss"] is None for k in (1, 2, 99))
    assert got[1]["market_value"] == 180


def test_rates_hold_until_the_next_one(spark, days):
    got = {(r["currency_code"], str(r["rate_day"])): (str(r["rate_date"]), r["rate_to_usd"]) for r in days.filter("rate_day >= '2024-01-04'").collect()}
    assert got["ARS", "2024-01-04"] == ("2020-01-01", Decimal("0.001000000"))
    assert got["ARS", "2024-01-05"] == got["ARS", "2024-12-31"] == ("2024-01-05", Decimal("0.002000000"))
    assert max(d for _, d in got) == "2024-12-31"
    assert days.count() == days.select("currency_code", "rate_day").distinct().count()


def walk(rows):
    """Quantity and cost after each trade, one by one."""
    held = cost = 0.0
    out = []
    for kind, q, p in rows:
        before = held
        held += q if kind in ("BUY", "SPLIT") else -q if kind == "SELL" else 0
        if held <= 0:
            cost = 0.0
        elif kind == "BUY":
            cost = cost + q * p if before >= 0 else held * p
        elif before <= 0:
            cost = 0.0
        elif kind == "SELL":
            cost *= held / before
        out.append((held, cost))
    return out


def test_moving_cost(spark, dim, days):
    rows = [("BUY", 10, 5), ("BUY", 10, 7), ("SELL", 5, 9), ("SPLIT", 15, 1), ("DIVIDEND", 1, 1), ("SELL", 30, 9), ("SELL", 4, 2),
            ("BUY", 10, 3), ("SELL", 6, 1), ("SELL", 5, 1), ("SPLIT", 9, 1), ("BUY", 1, 4)]
    df = trade(spark, [("u", 1, f"2024-01-{1 + i // 3:02d}", k, q, p, "USD") for i, (k, q, p) in enumerate(rows)]).coalesce(1)
    costed = currency.trade_costs(df, dim, days)
    for piece in (1, 2, 256):
        got = moving_cost.moving_cost(costed, ["transaction_date", "seq"], piece=piece).orderBy("seq").collect()
        assert [float(r["quantity_held"]) for r in got] == [q for q, _ in walk(rows)]
        assert [r["moving_cost"] for r in got] == pytest.approx([c for _, c in walk(rows)])
        assert got[2]["moving_cost"] == 90.0 and got[5]["moving_cost"] == 0.0 and got[7]["moving_cost"] == 18.0


def test_moving_cost_of_an_unknown_buy_lasts_until_the_position_is_closed(spark, dim, days):
    rows = [("BUY", 10, 5, "EUR"), ("BUY", 10, 7, "USD"), ("SELL", 20, 9, "USD"), ("BUY", 2, 3, "USD")]
    df = trade(spark, [("u", 1, "2024-01-01", k, q, p, c) for k, q, p, c in rows]).coalesce(1)
    got = moving_cost.moving_cost(currency.trade_costs(df, dim, days), ["transaction_date", "seq"]).orderBy("seq").collect()
    assert [r["moving_cost"] for r in got] == [None, None, 0.0, 6.0]


def test_moving_cost_of_a_position_of_a_million_trades(spark):
    n = 1_000_000
    kind = F.when(F.col("id") % 5 == 3, "SELL").otherwise("BUY")
    quantity = F.when(F.col("id") % 5 == 3, F.col("id") % 4 + 1).otherwise(F.col("id") % 3 + 1)
    big = spark.range(n).select(
        F.lit("u").alias("user_id"), F.lit(1).cast("bigint").alias("asset_key"), F.col("id").alias("seq"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 4000).cast("int")).alias("transaction_date"),
        kind.alias("transaction_type"), quantity.cast("decimal(18,6)").alias("quantity"),
        (F.col("id") % 97 + 1).cast("decimal(18,6)").alias("price_per_unit"),
    )
    bought = (F.col("quantity") * F.col("price_per_unit")).cast("decimal(28,9)")
    costed = big.withColumn("buy_cost", F.when(F.col("transaction_type") == "BUY", bought).otherwise(F.lit(0).cast("decimal(28,9)")))
    got = moving_cost.moving_cost(costed, ["transaction_date", "seq"]).filter("seq % 100000 = 99999 OR seq < 10").orderBy("seq").collect()
    want = walk(("SELL", i % 4 + 1, 0) if i % 5 == 3 else ("BUY", i % 3 + 1, i % 97 + 1) for i in range(n))
    assert len(got) == 20
    for r in got:
        assert (float(r["quantity_held"]), r["moving_cost"]) == pytest.approx(want[r["seq"]], rel=1e-9)


def test_a_history_that_follows_its_deliveries(spark, dim, days, prices):
    from ledgerlark.session import fresh_path

    path, span = fresh_path(spark, "history"), ("2024-01-02", "2024-01-09")
    waves = [
        [("u", 1, "2024-01-01", "BUY", 10, 5, "USD"), ("v", 2, "2024-01-03", "BUY", 1, 5, "USD"), ("w", 4, "2024-01-04", "BUY", 3, 2, "USD")],
        [("u", 1, "2024-01-07", "SELL", 10, 5, "USD")],  # closes a position
        [("v", 2, "2024-01-05", "BUY", 2, 1, "ARS"), ("x", 1, "2023-01-01", "BUY", 1, 1, "USD"), ("u", 1, "2025-01-01", "BUY", 1, 1, "USD")],
        [("w", 4, "2024-06-01", "BUY", 1, 1, "USD")],  # after the range: nothing changes
    ]
    known, reports = None, []
    for rows in waves:
        new = currency.trade_costs(trade(spark, rows), dim, days)
        known = new if known is None else known.unionByName(new)
        reports.append(increments.refresh_history(spark, path, known, prices, days, new, *span))
        whole = portfolio.portfolio_history(known, prices, days, *span)
        got = file_table.read(spark, path).select(*whole.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert reports[1]["rewritten"] and all(n >= "snapshot_date=2024-01-07" for n in reports[1]["rewritten"])
    assert {n.split("/")[0] for n in reports[1]["kept"]} >= {f"snapshot_date=2024-01-0{i}" for i in range(2, 7)}
    assert not reports[3]["rewritten"] and not reports[3]["new"] and set(reports[3]["kept"]) == set(file_table.files(spark, path))

    late = spark.sql("select 4L asset_key, date'2024-01-08' snapshot_date, cast(3 as decimal(18,6)) close_price, 'USD' price_currency")
    all_prices = prices.unionByName(late)
    report = increments.refresh_history(spark, path, known, all_prices, days, None, *span, new_prices=late)
    whole = portfolio.portfolio_history(known, all_prices, days, *span)
    assert sorted(map(str, file_table.read(spark, path).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert all(n >= "snapshot_date=2024-01-08" for n in report["rewritten"])
