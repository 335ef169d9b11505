"""A kept history: runs of days are dealt out, rows of a day are not shuffled to be written."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import increments, portfolio
from ledgerlark.session import fresh_path
from ledgerlark.sinks import file_table

SPAN = ("2024-01-02", "2024-02-20")


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(4)
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"
    trades = [(r.choice("uvwxyz"), r.randrange(8), day(r.randrange(56)), r.choice(["BUY", "BUY", "SELL"]), r.randrange(1, 9)) for _ in range(120)]
    txns = spark.createDataFrame(trades, "user_id string, asset_key long, d string, transaction_type string, q int").select(
        "user_id", "asset_key", F.col("d").cast("date").alias("transaction_date"), "transaction_type", F.col("q").cast("decimal(18,6)").alias("quantity"),
        F.lit("USD").alias("cost_basis_currency"), F.when(F.col("transaction_type") == "BUY", F.col("q") * 3).otherwise(0).cast("decimal(28,9)").alias("buy_cost"),
        F.monotonically_increasing_id().alias("seq"),
    ).localCheckpoint()
    quotes = {(a, day(r.randrange(56))): r.randrange(1, 90) for a in range(7) for _ in range(9)}
    prices = spark.createDataFrame([(a, d, p, "ARS" if a % 2 else "USD") for (a, d), p in quotes.items()], "asset_key long, d string, p int, price_currency string").select(
        "asset_key", F.col("d").cast("date").alias("snapshot_date"), F.col("p").cast("decimal(18,6)").alias("close_price"), "price_currency"
    )
    rates = spark.sql("""SELECT code AS currency_code, day AS rate_day, day AS rate_date, CAST(dayofyear(day) * 0.001 AS DECIMAL(15,9)) AS rate_to_usd
        FROM VALUES ('USD'), ('ARS') AS c(code), (SELECT explode(sequence(DATE'2024-01-01', DATE'2024-02-28')) AS day)""")
    return txns, prices, rates


def listed(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [1, 7, 16, 400])
def test_pieces_of_runs_have_the_rows_of_the_runs(tables, size):
    whole = portfolio.portfolio_history(*tables, *SPAN)
    assert listed(portfolio.portfolio_history(*tables, *SPAN, piece_days=size)) == listed(whole) and whole.count() > 500


def test_positions_are_listed_since_their_day(spark, tables):
    since = spark.sql("SELECT 'u' AS user_id, 1L AS asset_key, DATE'2024-01-20' AS from_day UNION ALL SELECT 'v', 2L, DATE'2023-01-01' UNION ALL SELECT 'w', 3L, DATE'2025-01-01'")
    whole = portfolio.portfolio_history(*tables, *SPAN)
    want = whole.join(since, portfolio.POSITION).filter("snapshot_date >= from_day").select(*whole.columns)
    assert listed(portfolio.portfolio_history(*tables, *SPAN, since=since, piece_days=16)) == listed(want) and want.count()


def test_rows_of_a_day_are_not_shuffled_to_be_written(spark, tables, monkeypatch):
    txns, prices, rates = tables
    path, plans, write = fresh_path(spark, "kept"), [], file_table.append_fact

    def seen(df, *args, dealt=False, **kwargs):
        plans.append((dealt, df._jdf.queryExecution().optimizedPlan().toString()))
        write(df, *args, dealt=dealt, **kwargs)

    monkeypatch.setattr(file_table, "append_fact", seen)
    for n in range(2):
        known, new = txns.filter(f"seq % 9 <= {n}" if n == 0 else "true"), txns.filter("seq % 9 = 0" if n == 0 else "seq % 9 > 0")
        increments.refresh_history(spark, path, known, prices, rates, new, *SPAN)
        assert listed(file_table.read(spark, path).select(*portfolio.SNAPSHOT)) == listed(portfolio.portfolio_history(known, prices, rates, *SPAN).select(*portfolio.SNAPSHOT))
    first, left, copied, fresh = plans
    assert [d for d, _ in plans] == [True, False, True, True]
    for _, text in (first, fresh):
        lines = text.splitlines()
        spread = next(i for i, line in enumerate(lines) if "Generate explode(sequence(_begin" in line)
        assert not [line for line in lines[:spread] if "Rebalance" in line] and [line for line in lines[spread:] if "Rebalance" in line]
    assert "Rebalance" not in copied[1] and "LeftAnti" not in copied[1] and "LeftAnti" in left[1]


def test_marks_miss_no_key(spark):
    rows = spark.range(3000).selectExpr("id % 700 AS a", "CASE WHEN id % 11 > 0 THEN CAST(id % 13 AS STRING) END AS b").distinct()
    hit = rows.filter("a % 5 = 0")
    on = ["a", "b"]
    told = file_table.may_meet(rows, hit, on)
    met = rows.join(hit, on, "left_semi")
    assert told.filter("_may").join(met, on, "left_semi").count() == met.count() > 0
    assert told.count() == rows.count() and told.filter("NOT _may").count() > 0.7 * rows.count()
    other = hit.withColumn("a", F.col("a").cast("int"))  # another type, another hash
    assert file_table.may_meet(rows, other, on).filter("NOT _may").count() == 0
    assert file_table.may_meet(rows, hit.limit(0), on).filter("_may").count() == 0


def test_amounts_add_up_from_their_parts(spark):
    amounts = ["0.000000001", "-0.000000001", "1.250000007", "-1.250000007", "999999999.999999999", "-1000000000", "12345678901234567890.123456789",
               "-12345678901234567890123456.987654321", "98765432109876543210987.000000001", "5"]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate([*amounts, *amounts[:4], None])], "g int, v string").select("g", F.col("v").cast(portfolio.AMOUNT).alias("market_value"))
    parts = df.unionByName(df.limit(1).selectExpr("7 AS g", "CAST(NULL AS DECIMAL(38,9)) AS market_value")).withColumns(portfolio.amount_parts())
    sums = parts.groupBy("g", F.rand(1) > 0.5).agg(*portfolio.amount_sums()).groupBy("g")
    want = {r["g"]: r["s"] for r in parts.groupBy("g").agg(F.sum("market_value").alias("s")).collect()}
    assert {r["g"]: r["s"] for r in sums.agg(portfolio.amount_total().alias("s")).collect()} == want and want[7] is None and len(want) == 4


def test_a_day_takes_its_rates_by_their_place(spark, tables):
    txns, prices, rates = tables
    some = rates.filter("currency_code = 'ARS' AND day(rate_day) % 3 > 0 OR currency_code = 'USD' AND rate_day > DATE'2024-01-09'")
    history = portfolio.portfolio_history(txns, prices, some, *SPAN)
    text = history._jdf.queryExecution().optimizedPlan().toString().splitlines()
    spread = next(i for i, line in enumerate(text) if "Generate explode(sequence(greatest(" in line)
    assert not [line for line in text[:spread] if "Join" in line]
    bare = history.drop("unrealized_gain_loss", "unrealized_gain_loss_pct")
    joined = portfolio.with_gain(bare.withColumn("_value", F.col("market_value").cast("double")), some).select(*history.columns)
    assert listed(history) == listed(joined)
    assert 0 < history.filter("unrealized_gain_loss IS NULL AND market_value IS NOT NULL").count() < history.count()
