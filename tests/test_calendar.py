from datetime import date

from pyspark.sql import functions as F

from ledgerlark.operators import calendar


def holidays(spark, *rows):
    df = spark.createDataFrame(rows, "market string, d string, name string")
    return df.select("market", F.col("d").cast("date").alias("holiday_date"), "name")


def test_row_counts_of_the_two_ranges(spark):
    assert calendar.date_spine(spark, *calendar.RANGE_V2).count() == 6210
    assert calendar.date_spine(spark, *calendar.RANGE_V1).count() == 9497


def test_parts(spark):
    day = calendar.date_spine(spark, "2024-02-29", "2024-02-29").first()
    assert tuple(day) == (20240229, date(2024, 2, 29), 2024, 1, 2, "February", 29, 4, "Thursday")


def test_second_form(spark):
    spine = calendar.date_spine(spark, "2024-12-24", "2024-12-29")
    given = holidays(spark, ("AR", "2024-12-25", "Navidad"), ("US", "2024-12-25", "Christmas"),
                     ("AR", "2024-12-26", "Puente"), ("US", "2024-12-28", "Weekend day"), ("GB", "2024-12-24", "x"))
    days = {r["day"]: r for r in calendar.calendar_v2(spine, given).collect()}
    assert (days[24]["markets_open"], days[24]["markets_closed"], days[24]["holidays"]) == (["US", "AR"], [], [])
    assert days[25]["markets_closed"] == ["US", "AR"]
    assert [tuple(h) for h in days[25]["holidays"]] == [("US", "Christmas"), ("AR", "Navidad")]
    assert (days[26]["markets_open"], days[26]["markets_closed"]) == (["US"], ["AR"])
    assert days[28]["markets_closed"] == ["US", "AR"]
    assert [tuple(h) for h in days[28]["holidays"]] == [("US", "Weekend day")]
    for d in days.values():
        assert sorted(d["markets_open"] + d["markets_closed"]) == ["AR", "US"]


def test_first_form(spark):
    spine = calendar.date_spine(spark, "2024-12-25", "2024-12-28")
    given = holidays(spark, ("AR", "2024-12-25", "N"), ("US", "2024-12-25", "C"), ("US", "2024-12-28", "W"))
    days = {r["day"]: r for r in calendar.calendar_v1(spine, given).collect()}
    assert days[25]["holiday_markets"] == ["US", "AR"] and not days[25]["is_weekend"]
    assert days[26]["holiday_markets"] == []
    assert days[28]["holiday_markets"] == ["US"] and days[28]["is_weekend"]


def test_two_names_on_one_day_are_one_entry(spark):
    spine = calendar.date_spine(spark, "2024-12-25", "2024-12-25")
    given = holidays(spark, ("US", "2024-12-25", "B"), ("US", "2024-12-25", "A"))
    assert [tuple(h) for h in calendar.calendar_v2(spine, given).first()["holidays"]] == [("US", "A; B")]


def test_trading_days(spark):
    spine = calendar.date_spine(spark, "2024-12-24", "2024-12-30")
    days = calendar.calendar_v2(spine, holidays(spark, ("US", "2024-12-25", "C")))
    got = {(r["market"], r["full_date"].day): (r["is_open"], r["previous_open"]) for r in calendar.trading_days(days).collect()}
    assert got["US", 24] == (True, None)
    assert got["US", 26] == (True, date(2024, 12, 24))
    assert got["AR", 26] == (True, date(2024, 12, 25))
    assert got["US", 30] == (True, date(2024, 12, 27))
    assert got["US", 28][0] is False
