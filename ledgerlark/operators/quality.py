"""Record validation, quarantine, required columns and domain rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions import evaluate_once, strict_iso_date, tolerant_float
from ledgerlark.functions.scalars import WS

# The order in which a batch record is checked.
RECORD_RULES = ("invalid_structure", "invalid_ticker", "invalid_price", "invalid_market", "invalid_date")
TRANSACTION_TYPES = ("BUY", "SELL", "DIVIDEND", "SPLIT")
QUALITY_FLAGS = ("COMPLETE", "MISSING_PRICE", "STALE_PRICE")


def first_failure(rules: Mapping[str, Column]) -> Column:
    """Code of the first rule that does not hold, null if all do. A null test fails."""
    return F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules.items()]
    )


def not_blank(col: str) -> Column:
    return F.regexp_replace(F.col(col), f"^{WS}+", "") != ""


def read_records(df: DataFrame, json_col: str = "record") -> DataFrame:
    """Split four-element JSON array records into typed candidates.

    ``n_fields`` is null for anything but an array. Text fields are null unless the JSON
    value is a string; numbers and booleans pass as prices.
    """
    doc = F.try_parse_json(json_col)
    items = F.when(
        F.schema_of_variant(doc).startswith("ARRAY"), F.try_variant_get(doc, "$", "array<variant>")
    )

    def field(value: Column) -> Column:
        return F.struct(
            F.schema_of_variant(value).alias("kind"),
            F.try_variant_get(value, "$", "string").alias("text"),
        )

    def text(i: int) -> Column:
        at = F.try_element_at("_fields", F.lit(i + 1))
        return F.when(at["kind"] == "STRING", at["text"])

    price = F.try_element_at("_fields", F.lit(2))
    # A boolean is a number to the loader.
    number = F.when(price["kind"] == "BOOLEAN", F.when(price["text"] == "true", "1").otherwise("0"))
    return evaluate_once(
        df.withColumn("_fields", F.transform(items, field)),
        n_fields=F.when(F.col("_fields").isNotNull(), F.size("_fields")),
        ticker=text(0),
        price=F.coalesce(number, price["text"]),
        market=text(2),
        date=text(3),
    ).drop("_fields")


def validate_records(records: DataFrame) -> DataFrame:
    """Add ``error_code``: null for a good record, else the first rule it breaks."""
    names = dict(
        zip(
            RECORD_RULES,
            [
                F.col("n_fields") == 4,
                not_blank("ticker"),
                tolerant_float("price").isNotNull(),
                not_blank("market"),
                strict_iso_date("date").isNotNull(),
            ],
        )
    )
    return records.withColumn("error_code", first_failure(names))


def batch_verdict(
    validated: DataFrame, by: Sequence[str], index: str, codes: Sequence[str] = RECORD_RULES
) -> DataFrame:
    """Strict-mode verdict per batch: the first bad record rejects the whole batch.

    Index and rule are packed in one long, so the aggregate stays a hash aggregate with
    partial sums. ``loaded`` counts the rows that would be loaded.
    """
    width = len(codes) + 1
    rank = F.coalesce(*[F.when(F.col("error_code") == c, F.lit(i)) for i, c in enumerate(codes)])
    packed = F.when(F.col("error_code").isNotNull(), F.col(index).cast("bigint") * width + rank)
    first = F.col("_first")
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (first % width + 1).cast("int"))
    return (
        validated.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("records"), F.min(packed).alias("_first"))
        .select(
            *by,
            "records",
            F.when(first.isNotNull(), F.call_function("div", first, F.lit(width))).alias("first_bad"),
            F.when(first.isNotNull(), code).alias("error_code"),
            F.when(first.isNotNull(), "rejected").otherwise("loaded").alias("verdict"),
            F.when(first.isNull(), F.col("records")).otherwise(F.lit(0)).alias("loaded"),
        )
    )


def verdict_of(validated: DataFrame, index: str) -> DataFrame:
    """Verdict of one whole batch; an empty one is 'no data'."""
    out = batch_verdict(validated, [], index)
    return out.withColumn(
        "verdict", F.when(F.col("records") == 0, "no data").otherwise(F.col("verdict"))
    )


def quarantine(df: DataFrame, parsed: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Parse text columns and mark the rows that cannot be parsed.

    ``parsed`` maps an output column to (source column, expression). ``reject_reason``
    names the first output whose source has text but whose value is null.
    """
    reasons = [
        F.when(F.col(name).isNull() & F.col(source).isNotNull(), F.lit(f"bad_{name}"))
        for name, (source, _) in parsed.items()
    ]
    typed = evaluate_once(df, **{name: expr for name, (_, expr) in parsed.items()})
    return typed.withColumn("reject_reason", F.coalesce(*reasons))


def split_quarantine(df: DataFrame, on_error: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of a frame with ``reject_reason``; 'fail' stops at the first bad row."""
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"unknown on_error: {on_error}")
    reason = F.col("reject_reason")
    if on_error == "fail":
        ok = F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean"))
        return df.filter(ok).drop("reject_reason"), df.limit(0)
    return df.filter(reason.isNull()).drop("reject_reason"), df.filter(reason.isNotNull())


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column with its number of nulls, from a single pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in required]
    )
    return counted.select("rows", F.explode(pairs).alias("p")).select(
        F.col("p.column_name"), F.col("p.null_rows"), F.col("rows")
    )


def assert_not_null(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same rows; the job fails at the first row that misses a required value."""
    missing = first_failure({c: F.col(c).isNotNull() for c in required})
    ok = F.when(missing.isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("required column is null: "), missing)).cast("boolean")
    )
    return df.filter(ok)


def validate_transactions(df: DataFrame) -> DataFrame:
    """Add ``error_code`` by the transaction domain: known type, positive quantity."""
    return df.withColumn(
        "error_code",
        first_failure(
            {
                "invalid_type": F.col("transaction_type").isin(*TRANSACTION_TYPES),
                "invalid_quantity": F.col("quantity") > 0,
            }
        ),
    )


def price_quality(
    price_date: Column, as_of: Column, max_age_days: int = 5, last_open: Column | None = None
) -> Column:
    """COMPLETE, MISSING_PRICE or STALE_PRICE by the age of the price used.

    With ``last_open``, the market's last open day, a price is stale if it is older than
    that day, however many days ago it was.
    """
    complete, missing, stale = QUALITY_FLAGS
    old = F.datediff(as_of, price_date) > max_age_days if last_open is None else price_date < last_open
    return F.when(price_date.isNull(), missing).when(old, stale).otherwise(complete)
