"""Column expressions shared by the operators. All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values -----------------------------------------------------------
# The warehouse NUMERIC type.
NUMERIC = "decimal(38,9)"
# Spanish short months that differ from the English ones.
SPANISH_MONTHS = {"ene": "jan", "abr": "apr", "ago": "aug", "set": "sep", "dic": "dec"}
# Characters a Python str.split() treats as white space.
WS = r"[\p{Z}\t-\r\x1c-\x1f\x{85}]"
# Text a Python float() accepts.
FLOAT_TEXT = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r"|nan|inf|infinity)$"
)
# The run-date clock is fixed at three hours behind UTC.
RUN_ZONE = "-03:00"
# ------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def asset_key(*parts: Column | str, suffix: str | None = None) -> Column:
    """Signed 64-bit surrogate key of a natural key.

    Parts are joined with ``|`` so that ("AB", "C") and ("A", "BC") differ. A null part
    gives a null key. The first 15 hex digits of md5 fit a bigint and have the same value
    in any SQL engine.
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(_c(part).cast("string"))
    if suffix is not None:
        pieces.append(F.lit("|" + suffix))
    return F.conv(F.substring(F.md5(F.concat(*pieces)), 1, 15), 16, 10).cast("bigint")


def to_numeric(col: Column | str) -> Column:
    return _c(col).cast(NUMERIC)


def parse_locale_number(col: Column | str) -> Column:
    """``1.234,56`` -> 1234.56; text that is not a number gives null."""
    plain = F.replace(F.replace(_c(col), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast(NUMERIC)


def parse_percent(col: Column | str) -> Column:
    """``2,35%`` -> 2.35: percent units are kept."""
    return parse_locale_number(F.replace(_c(col), F.lit("%"), F.lit("")))


def parse_report_date(col: Column | str) -> Column:
    """``29-Sep-25`` or ``31-dic-25`` -> date; anything else gives null.

    Two-digit years pivot at 69 as in POSIX: 69-99 belong to the 1900s.
    """
    text = F.lower(F.trim(_c(col)))
    english = reduce(
        lambda acc, kv: F.replace(acc, F.lit(f"-{kv[0]}-"), F.lit(f"-{kv[1]}-")),
        SPANISH_MONTHS.items(),
        text,
    )
    day = F.try_to_date(english, "d-MMM-yy")
    # The year is asked of the text: a condition on the day itself would parse every date twice.
    last_century = F.substring(F.trim(_c(col)), -2, 2) >= "69"
    return F.when(last_century, F.add_months(day, -1200)).otherwise(day)


def strict_iso_date(col: Column | str) -> Column:
    """Year-month-day text to date; month and day may lack their leading zero."""
    text = _c(col)
    return F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "y-M-d")
    )


def tolerant_float(col: Column | str) -> Column:
    """Text to double, accepting what a lenient float parser accepts, else null."""
    text = F.regexp_replace(_c(col).cast("string"), f"^{WS}+|{WS}+$", "")
    return F.when(
        text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    )


def split_list(col: Column | str, delimiter: str = "|") -> Column:
    """Delimited text to array; null or empty text gives an empty array."""
    text = F.coalesce(_c(col), F.lit(""))
    pattern = "".join("\\" + ch for ch in delimiter)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, pattern)
    )


def run_date_or_today(run_date: str | None) -> Column:
    """The run date as a date column: the argument, or today on the run clock.

    Needs a UTC session time zone, like every timestamp in this package.
    """
    if run_date:
        return F.lit(run_date).cast("date")
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), RUN_ZONE))


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """Integer ratio rounded half up, for non-negative integers: exact in any engine."""
    return F.call_function(
        "div", numerator * F.lit(2) + denominator, denominator * F.lit(2)
    )


def evaluate_once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns in a way that later filters on them do not repeat the expressions.

    A filter on a projected column is pushed below the projection with the whole expression
    inlined. A one-element generator is a boundary for that, and stays in generated code.
    """
    row = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select("*", F.inline(F.array(row)))


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal columns where null equals null, so that no row is lost."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, same).drop(*[f"_right_{c}" for c in on])
