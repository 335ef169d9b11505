import pytest

from ledgerlark.operators import prices, quality


def checked(spark, *records):
    df = spark.createDataFrame(list(enumerate(records)), "i long, record string")
    return quality.validate_records(quality.read_records(df))


def test_record_rules_in_order(spark):
    records = {
        '["QQZ", 17, "US", "2019-03-04"]': None,
        '["QQZ", "17.25", "US", "2019-3-4"]': None,
        '["QQZ", true, "US", "2019-3-4"]': None,
        '["QQZ", "nan", "US", "2019-3-4"]': None,
        '["QQZ", 17, "US"]': "invalid_structure",
        '["QQZ", 17, "US", "2019-03-04", 1]': "invalid_structure",
        '{"ticker": "QQZ"}': "invalid_structure",
        "not json": "invalid_structure",
        '[" ", "abc", "", "x"]': "invalid_ticker",
        '[7, 17, "US", "2019-03-04"]': "invalid_ticker",
        '["QQZ", "abc", "", "x"]': "invalid_price",
        '["QQZ", null, "US", "2019-03-04"]': "invalid_price",
        '["QQZ", 17, "  ", "x"]': "invalid_market",
        '["QQZ", 17, "US", "2019-13-01"]': "invalid_date",
        '["QQZ", 17, "US", 20190304]': "invalid_date",
    }
    got = [r["error_code"] for r in checked(spark, *records).orderBy("i").collect()]
    assert got == list(records.values())


def test_verdicts(spark):
    good, blank, bad_day = '["A", 1, "US", "2019-03-04"]', '["", 1, "US", "2019-03-04"]', '["A", 1, "US", "x"]'
    mixed = quality.verdict_of(checked(spark, good, bad_day, blank), "i").first()
    assert tuple(mixed) == (3, 1, "invalid_date", "rejected", 0)
    assert tuple(quality.verdict_of(checked(spark, good, good), "i").first()) == (2, None, None, "loaded", 2)
    empty = quality.verdict_of(checked(spark, good).filter("i < 0"), "i").first()
    assert (empty["records"], empty["verdict"]) == (0, "no data")


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert {r["column_name"]: r["null_rows"] for r in quality.null_counts(df, ["a", "b"]).collect()} == {"a": 0, "b": 1}
    assert quality.assert_not_null(df, ["a"]).count() == 2
    with pytest.raises(Exception, match="required column is null: b"):
        quality.assert_not_null(df, ["a", "b"]).collect()


def test_transaction_rules(spark):
    df = spark.createDataFrame([("BUY", 1.0), ("GIFT", 1.0), ("SELL", 0.0), (None, 1.0)], "transaction_type string, quantity double")
    codes = [r["error_code"] for r in quality.validate_transactions(df).collect()]
    assert codes == [None, "invalid_type", "invalid_quantity", "invalid_type"]


def test_feeds(spark):
    df = spark.createDataFrame([(1,)], "a long")
    tagged = prices.union_feeds({"FCI": df, "ON": None, "BONOS": df.withColumnRenamed("a", "b")})
    assert sorted(map(tuple, tagged.select("category", "a", "b").collect()), key=str) == [("BONOS", None, 1), ("FCI", 1, None)]
    assert prices.union_feeds({"FCI": None}) is None
    health = spark.createDataFrame([("x", None), ("y", None)], "category string, payload string")
    assert tuple(prices.feed_health(health).first()) == (2, 2, True)


def test_listing_and_currency(spark):
    listings = spark.createDataFrame([("QQZ", "US", "NASDAQ")], "ticker_symbol string, exchange_country string, exchange_code string")
    rows = spark.createDataFrame([("QQZ", 1.0), ("ZZ", 2.0)], "symbol string, close double")
    stamped = prices.with_listing(rows, listings).collect()
    assert [r.asDict() for r in stamped] == [
        {"ticker_symbol": "QQZ", "close": 1.0, "exchange_name": "NASDAQ", "country": "US", "is_adjusted": False}
    ]
    fact = spark.createDataFrame([(1, None), (2, "EUR"), (3, None)], "asset_key long, price_currency string")
    dim = spark.createDataFrame([(1, "USD"), (2, "USD")], "asset_key long, currency_code string")
    got = {r["asset_key"]: r["price_currency"] for r in prices.fill_currency(fact, dim).collect()}
    assert got == {1: "USD", 2: "EUR", 3: None}
    assert prices.scan_symbols(rows).count() == 2
