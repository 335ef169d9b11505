"""Fetched payloads that arrive as a text column: price CSV and daily-series JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlark.functions import evaluate_once
from ledgerlark.schemas import PAYLOAD_PRICES

# Fixed values -----------------------------------------------------------
# The phrase that marks an answer refused for quota.
QUOTA_MARKER = "We have detected your API key"
META_KEY, SERIES_KEY, REFRESHED_KEY = "Meta Data", "Time Series (Daily)", "3. Last Refreshed"
CLOSE_KEY = "4. close"
SERIES_MARKET = "US"
# ------------------------------------------------------------------------

_SERIES = T.StructType(
    [
        T.StructField(META_KEY, T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            SERIES_KEY, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
        ),
    ]
)


def gate_payloads(
    df: DataFrame, text: str = "text", symbol: str = "symbol", marker: str = QUOTA_MARKER
) -> DataFrame:
    """Add ``payload_status``: empty_symbol, no_answer, rate_limited or usable."""
    status = (
        F.when(F.coalesce(F.col(symbol).cast("string"), F.lit("")) == "", "empty_symbol")
        .when(F.col(text).isNull(), "no_answer")
        .when(F.contains(F.col(text), F.lit(marker)), "rate_limited")
        .otherwise("usable")
    )
    return df.withColumn("payload_status", status)


def parse_price_payloads(df: DataFrame, text: str = "text", daily: bool = False) -> DataFrame:
    """Price rows out of the usable CSV payloads: header line skipped, one row per line.

    A refused answer, an error body or a line that is no price row gives no row here; see
    :func:`rejected_price_lines` for what was left out.

    With ``daily`` only the newest row of each payload stays, chosen by its date. The
    choice is made on the payload's own lines, so neither form shuffles.
    """
    rows = _price_lines(df, text, daily)
    return rows.filter(f"NOT {BAD_PRICE_LINE}").select(*[c for c in df.columns if c != text], f"_r.{PAYLOAD_PRICES.names[0]}",
                                                      *[f"_r.{n}" for n in PAYLOAD_PRICES.names[1:]])


def rejected_price_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """What of price payloads is no price row: ``line`` and ``reject_reason``.

    A line that does not parse comes back as ``corrupt_line``. A payload without any line after its header comes
    back as one row: ``no_answer`` if it is null, ``rate_limited`` if it was refused for quota, else ``corrupt_body``,
    with its first line. So every payload gives a price row or a row here.
    """
    keep = [c for c in df.columns if c != text]
    bad = _price_lines(df, text, False).filter(BAD_PRICE_LINE)
    lines = bad.select(*keep, F.col("_line").alias("line"), F.lit("corrupt_line").alias("reject_reason"))
    body = F.col(text)
    reason = (
        F.when(body.isNull(), "no_answer")
        .when(F.contains(body, F.lit(QUOTA_MARKER)), "rate_limited")
        .when(F.size(_filled_lines(body)) < 2, "corrupt_body")
    )
    judged = evaluate_once(df, _reason=reason).filter("_reason IS NOT NULL")
    whole = judged.select(*keep, F.get(_filled_lines(body), F.lit(0)).alias("line"), F.col("_reason").alias("reject_reason"))
    return lines.unionByName(whole)


def _filled_lines(text: Column) -> Column:
    """The lines of a payload that are not blank."""
    split = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n")
    return F.filter(split, lambda x: F.trim(x) != "")


# A line without a date is none either.
BAD_PRICE_LINE = "(_r._bad IS NOT NULL OR _r.timestamp IS NULL)"


def _price_lines(df: DataFrame, text: str, daily: bool) -> DataFrame:
    """The body lines of answered payloads, parsed into ``_r``; ``_r._bad`` holds a line that does not parse."""
    df = df.filter(F.col(text).isNotNull() & ~F.contains(F.col(text), F.lit(QUOTA_MARKER)))
    keep = [c for c in df.columns if c != text]
    # Lines are their own column, so that the split is not repeated below.
    lined = df.select(*keep, _filled_lines(F.col(text)).alias("_lines"))
    body = F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PAYLOAD_PRICES.fields)
    if daily:
        # The date is the first field, so ISO dates make the newest line the greatest prefix.
        newest = F.array_max(
            F.transform(
                body,
                lambda x: F.struct(
                    F.try_to_date(F.substring_index(x, ",", 1)).alias("d"), x.alias("line")
                ),
            )
        )["line"]
        body = F.when(F.size("_lines") > 1, F.array(newest))
    rows = lined.select(*keep, F.explode(body).alias("_line"))
    parsed = F.from_csv("_line", f"{schema}, `_bad` string", {"columnNameOfCorruptRecord": "_bad"})
    return evaluate_once(rows, _r=parsed)


def latest_from_series_json(
    df: DataFrame, symbol: str = "symbol", payload: str = "payload"
) -> DataFrame:
    """The point named by the payload's 'last refreshed' key, for every symbol.

    No row comes back for an empty symbol, a body that is not such JSON, or a missing
    section, key or point. A point without a close gives a null price.
    """
    named = df.filter(F.coalesce(F.col(symbol), F.lit("")) != "")
    parsed = evaluate_once(named, _doc=F.from_json(F.col(payload), _SERIES))
    day = F.try_element_at(F.col(f"_doc.`{META_KEY}`"), F.lit(REFRESHED_KEY))
    dated = evaluate_once(parsed, date=day)
    point = F.try_element_at(F.col(f"_doc.`{SERIES_KEY}`"), F.col("date"))
    return (
        evaluate_once(dated, _point=point)
        .filter(F.size("_point") > 0)
        .select(
            F.col(symbol).alias("ticker"),
            F.try_element_at("_point", F.lit(CLOSE_KEY)).alias("price"),
            F.lit(SERIES_MARKET).alias("market"),
            "date",
        )
    )
