"""As-of lookups and running totals against brute force, with hot keys."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import asof, currency, portfolio

START = datetime(2024, 1, 1)


def scenario(seed):
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < 0.4 else rng.choice("abcde")

    quotes = {(key(), START + timedelta(minutes=rng.randrange(20000))): rng.random() for _ in range(300)}
    left = [(i, key(), START + timedelta(minutes=rng.randrange(20000))) for i in range(500)]
    left += [(1000, "none", START), (1001, None, START), (1002, "hot", None)]
    return left, [(k, t, v) for (k, t), v in quotes.items()]


@pytest.mark.parametrize("bucket", [None, "day", "hour"])
def test_asof_matches_brute_force(spark, bucket):
    left, quotes = scenario(7)
    l_df = spark.createDataFrame(left, "id long, k string, at timestamp")
    r_df = spark.createDataFrame(quotes, "k string, quoted timestamp, v double")
    got = {r["id"]: (r["quoted"], r["v"]) for r in
           asof.asof_join(l_df, r_df, ["k"], "at", "quoted", ["v"], bucket).collect()}
    assert len(got) == len(left)
    for i, k, at in left:
        before = [(t, v) for q, t, v in quotes if k is not None and at is not None and q == k and t <= at]
        assert got[i] == (max(before) if before else (None, None)), i


def test_same_instant_counts(spark):
    l_df = spark.sql("select 1 id, 'a' k, date'2024-01-02' d")
    r_df = spark.sql("select 'a' k, date'2024-01-02' q, 5 v")
    assert asof.asof_join(l_df, r_df, ["k"], "d", "q", ["v"]).first()["v"] == 5


def test_currency_conversion_with_repeated_rates(spark):
    rates = spark.createDataFrame(
        [("ARS", "2024-01-03", "0.001"), ("ARS", "2024-01-06", "0.002"), ("ARS", "2024-01-06", "0.0015"), ("ARS", "2024-01-03", "0.001"), ("USD", "2024-01-01", "1"), (None, "2024-01-01", "9")],
        "currency_code string, d string, r string",
    ).select("currency_code", F.col("d").cast("date").alias("rate_date"), F.col("r").cast("decimal(15,9)").alias("rate_to_usd"))
    facts = spark.createDataFrame(
        [(i, c, f"2024-01-0{i}") for i in range(1, 10) for c in ("ARS", "USD", "EUR", None)] + [(99, "ARS", None)],
        "i int, currency string, d string",
    ).select("i", "currency", F.col("d").cast("date").alias("day"), F.lit(Decimal("10")).alias("value"))

    out = currency.convert_currency(facts, rates, "day", "currency", "value").collect()
    values = {(r["i"], r["currency"]): r["total_value_usd"] for r in out}
    assert len(out) == facts.count()
    assert values[2, "ARS"] is None and values[3, "ARS"] == Decimal("0.01") == values[5, "ARS"]
    assert values[9, "ARS"] == Decimal("0.02") and values[9, "EUR"] is None and values[9, "USD"] == 10


def trades(spark, seed=3, n=600):
    rng, rows = random.Random(seed), []
    for i in range(n):
        hot = rng.random() < 0.4
        user, asset = ("u0", 0) if hot else (f"u{rng.randrange(6)}", rng.randrange(5))
        day = (START + timedelta(days=rng.randrange(9))).date()
        rows.append((i, user, asset, day, rng.choice(["BUY", "SELL", "SPLIT", "DIVIDEND"]),
                     Decimal(rng.randrange(1, 50)), Decimal(rng.randrange(1, 900)) / 100))
    schema = ("seq long, user_id string, asset_key long, transaction_date date, transaction_type string, "
              "quantity decimal(18,6), price_per_unit decimal(18,6)")
    return spark.createDataFrame(rows, schema).withColumn("currency_code", F.lit("USD")), rows


@pytest.mark.parametrize("fine", [False, True])
def test_running_holdings_match_brute_force(spark, fine):
    df, rows = trades(spark)
    blocks = [F.col("transaction_date"), F.floor(F.col("seq") / 16)][: 1 + fine]
    got = {r["seq"]: r["quantity_held"] for r in
           portfolio.running_holdings(df, ["transaction_date", "seq"], blocks).collect()}
    held = {}
    sign = {"BUY": 1, "SPLIT": 1, "SELL": -1, "DIVIDEND": 0}
    for seq, user, asset, _, kind, quantity, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        held[user, asset] = held.get((user, asset), Decimal(0)) + sign[kind] * quantity
        assert got[seq] == held[user, asset]
    assert len(got) == len(rows)


def test_rows_without_a_date_are_kept(spark):
    df, rows = trades(spark)
    undated = df.withColumn("transaction_date", F.when(F.col("seq") % 7 > 0, F.col("transaction_date")))
    blocks = [F.col("transaction_date"), F.floor(F.col("seq") / 16)]
    running = portfolio.running_holdings(undated, ["transaction_date", "seq"], blocks)
    direct = portfolio.running_holdings(undated, ["transaction_date", "seq"], blocks[:1])
    assert sorted(map(str, running.collect())) == sorted(map(str, direct.collect()))


def test_last_running_row_is_the_holding(spark):
    df, _ = trades(spark)
    blocks = [F.col("transaction_date"), F.floor(F.col("seq") / 16)]
    running = portfolio.running_holdings(df, ["transaction_date", "seq"], blocks)
    last = running.groupBy("user_id", "asset_key").agg(
        F.max_by("quantity_held", F.struct("transaction_date", "seq")).alias("quantity_held")
    )
    plain = portfolio.holdings(df)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, plain.collect()))
