"""Typed bond rows from the text rows of a fixed-income report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions import (
    asset_key,
    parse_locale_number,
    parse_percent,
    parse_report_date,
    to_numeric,
)
from ledgerlark.operators.quality import quarantine

# The key suffix of this exchange, and the instrument types by title.
BOND_KEY_SUFFIX = "byma"
BONCAP, LECAP = "BONCAP", "LECAP"


def instrument_type(section: Column) -> Column:
    return F.when(F.contains(section, F.lit(BONCAP)), BONCAP).otherwise(LECAP)


def type_bond_rows(rows: DataFrame, legacy_price: bool = False) -> DataFrame:
    """Parse every measure of section rows; bad rows carry ``reject_reason``.

    ``legacy_price`` reproduces a known slip: the price's comma becomes a dot which is then
    deleted with the thousands dots, so 123,45 reads 12345.
    """
    price = F.col("precio_vn_100")
    if legacy_price:
        price = F.replace(price, F.lit(","), F.lit("."))
    sources = {
        "issue_date": ("fecha_emision", parse_report_date("fecha_emision")),
        "payment_date": ("fecha_pago", parse_report_date("fecha_pago")),
        "amount_at_payment": ("monto_al_vencimiento", parse_locale_number("monto_al_vencimiento")),
        "rate": ("tasa_de_liquidacion", parse_percent("tasa_de_liquidacion")),
        "snapshot_date": ("fecha_cierre", parse_report_date("fecha_cierre")),
        "price_per_100_nominal_value": ("precio_vn_100", parse_locale_number(price)),
        "period_yield": ("rendimiento_periodo", parse_percent("rendimiento_periodo")),
        "annual_percentage_rate": ("tna", parse_percent("tna")),
        "effective_annual_rate": ("tea", parse_percent("tea")),
        "effective_monthly_rate": ("tem", parse_percent("tem")),
        "modified_duration_in_days": (
            "dm_dias",
            parse_locale_number("dm_dias").cast("bigint"),
        ),
    }
    return quarantine(rows, sources)


def to_fixed_income(typed: DataFrame) -> DataFrame:
    """Bond master rows: one per parsed line. Term and settlement date are not kept."""
    return typed.select(
        asset_key("ticker_symbol", suffix=BOND_KEY_SUFFIX).alias("asset_key"),
        "ticker_symbol",
        "issue_date",
        "payment_date",
        "amount_at_payment",
        "rate",
        instrument_type(F.col("section")).alias("type"),
    )


def to_fixed_income_daily(typed: DataFrame, ingested_at: Column) -> DataFrame:
    """Bond measures of the day, one per parsed line."""
    return typed.select(
        asset_key("ticker_symbol", suffix=BOND_KEY_SUFFIX).alias("asset_key"),
        "ticker_symbol",
        "snapshot_date",
        ingested_at.cast("timestamp").alias("ingestion_timestamp"),
        F.col("amount_at_payment").alias("maturity_value"),
        F.col("rate").alias("action_rate"),
        "price_per_100_nominal_value",
        "period_yield",
        "annual_percentage_rate",
        "effective_annual_rate",
        "effective_monthly_rate",
        "modified_duration_in_days",
    )


def staged_fixed_income(staged: DataFrame) -> DataFrame:
    """Bond master rows from all-text staging; a bad cast fails the job."""
    return staged.select(
        asset_key("ticker_symbol", suffix=BOND_KEY_SUFFIX).alias("asset_key"),
        "ticker_symbol",
        F.col("issue_date").cast("date").alias("issue_date"),
        F.col("payment_date").cast("date").alias("payment_date"),
        to_numeric("amount_at_payment").alias("amount_at_payment"),
        to_numeric("rate").alias("rate"),
        "type",
    )
