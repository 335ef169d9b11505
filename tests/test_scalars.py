from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlark import functions as fn
from ledgerlark.functions import scalars


def values(spark, rows, expr):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(expr).collect()]


def test_locale_numbers(spark):
    got = values(spark, ["1.234,56", "123,45", "#DIV/0!", "-7", None], fn.parse_locale_number("x"))
    assert got == [Decimal("1234.56"), Decimal("123.45"), None, Decimal("-7"), None]


def test_percent_keeps_units(spark):
    assert values(spark, ["2,35%"], fn.parse_percent("x")) == [Decimal("2.35")]


def test_report_dates(spark):
    texts = ["29-Sep-25", "31-dic-25", "1-ene-30", "5-AGO-26", "31-xyz-25", "#DIV/0!", "01-Jan-70", "01-Jan-68"]
    assert values(spark, texts, fn.parse_report_date("x")) == [
        date(2025, 9, 29),
        date(2025, 12, 31),
        date(2030, 1, 1),
        date(2026, 8, 5),
        None,
        None,
        date(1970, 1, 1),
        date(2068, 1, 1),
    ]


def test_iso_dates(spark):
    texts = ["2025-06-10", "2025-6-1", "2025-13-01", "2025-02-30", "25-6-1", "2025-6-1x"]
    assert values(spark, texts, fn.strict_iso_date("x")) == [date(2025, 6, 10), date(2025, 6, 1), None, None, None, None]


def test_tolerant_float(spark):
    got = values(spark, ["42", " 1e3 ", "1_000", "abc", "1.5f", "", None, "-.5"], fn.tolerant_float("x"))
    assert got == [42.0, 1000.0, 1000.0, None, None, None, None, -0.5]
    assert str(values(spark, ["nan"], fn.tolerant_float("x"))[0]) == "nan"
    assert values(spark, ["-Infinity"], fn.tolerant_float("x")) == [float("-inf")]


def test_keys_keep_part_boundaries(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), (None, "C"), ("AB", "C")], "a string, b string")
    keys = [r[0] for r in df.select(fn.asset_key("a", "b")).collect()]
    assert keys[0] == keys[3] and keys[0] != keys[1] and keys[2] is None
    assert all(k >= 0 for k in keys if k is not None)


def test_split_list(spark):
    assert values(spark, ["US|AR", "US", "", None], fn.split_list("x")) == [["US", "AR"], ["US"], [], []]


def test_numeric_rounds_half_up(spark):
    df = spark.sql("select 1.0000000005D x, 151.755D y")
    assert df.select(fn.to_numeric("x"), fn.to_numeric("y")).first() == (
        Decimal("1.000000001"),
        Decimal("151.755000000"),
    )


def test_run_date(spark):
    assert spark.range(1).select(fn.run_date_or_today("2025-10-20")).first()[0] == date(2025, 10, 20)
    expected = F.to_date(F.expr("current_timestamp() - interval 3 hours"))
    row = spark.range(1).select(fn.run_date_or_today(None), expected).first()
    assert row[0] == row[1]


def test_half_up_ratio(spark):
    df = spark.createDataFrame([(5, 2), (4, 3), (7, 2), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(fn.half_up_ratio(F.col("a"), F.col("b"))).collect()] == [3, 1, 4, 0]


def test_a_report_date_is_parsed_once(spark):
    df = spark.createDataFrame([("1-Jan-69",), ("31-dic-68",), (" 29-feb-72 ",), ("1-Jan-1970",)], "t string")
    got = df.select(scalars.parse_report_date("t").alias("d"))
    assert [str(r["d"]) for r in got.collect()] == ["1969-01-01", "2068-12-31", "1972-02-29", "None"]
    assert "year(" not in got._jdf.queryExecution().optimizedPlan().toString()
