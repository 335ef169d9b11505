"""Declared schemas of the warehouse tables and of the landed files."""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
_STR, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DATE, _TS, _BOOL, _DBL = T.DateType(), T.TimestampType(), T.BooleanType(), T.DoubleType()
_STRS = T.ArrayType(_STR)
_HOLIDAYS = T.ArrayType(T.StructType([T.StructField("market", _STR), T.StructField("name", _STR)]))


def _struct(*fields: tuple) -> T.StructType:
    """(name, type) is nullable, (name, type, True) is required."""
    return T.StructType(
        [T.StructField(f[0], f[1], nullable=not (len(f) > 2 and f[2])) for f in fields]
    )


DIM_DATE = _struct(
    ("date_key", _LONG, True),
    ("full_date", _DATE, True),
    ("year", _INT),
    ("quarter", _INT),
    ("month", _INT),
    ("month_name", _STR),
    ("day", _INT),
    ("day_of_week", _INT),
    ("day_of_week_name", _STR),
    ("markets_open", _STRS),
    ("markets_closed", _STRS),
    ("holidays", _HOLIDAYS),
)

DIM_DATE_V1 = _struct(
    ("date_key", _LONG, True),
    ("full_date", _DATE, True),
    ("year", _INT),
    ("quarter", _INT),
    ("month", _INT),
    ("month_name", _STR),
    ("day", _INT),
    ("day_of_week_name", _STR),
    ("is_weekend", _BOOL),
    ("holiday_markets", _STRS),
)

DIM_ASSET = _struct(
    ("asset_key", _LONG, True),
    ("ticker_symbol", _STR),
    ("asset_name", _STR),
    ("asset_type", _STR),
    ("asset_subtype", _STR),
    ("exchange_code", _STR),
    ("exchange_name", _STR),
    ("exchange_country", _STR),
    ("currency_code", _STR),
    ("isin", _STR),
    ("is_active", _BOOL),
    ("metadata", T.VariantType()),
    ("last_updated", _TS),
)

DIM_ASSET_V1 = _struct(
    ("asset_key", _LONG, True),
    ("ticker_symbol", _STR),
    ("asset_name", _STR),
    ("asset_type", _STR),
    ("market_name", _STR),
    ("market_country", _STR),
    ("currency_code", _STR),
    ("is_active", _BOOL),
)

PRICE_FACT = _struct(
    ("snapshot_timestamp", _TS, True),
    ("snapshot_date", _DATE, True),
    ("asset_key", _LONG, True),
    ("open_price", NUMERIC),
    ("high_price", NUMERIC),
    ("low_price", NUMERIC),
    ("close_price", NUMERIC),
    ("volume", NUMERIC),
    ("price_currency", _STR),
    ("data_source", _STR),
    ("is_adjusted", _BOOL),
    ("ingestion_timestamp", _TS),
)

TRANSACTIONS = _struct(
    ("transaction_id", _STR, True),
    ("user_id", _STR, True),
    ("asset_key", _LONG, True),
    ("transaction_timestamp", _TS, True),
    ("transaction_date", _DATE, True),
    ("transaction_type", _STR, True),
    ("quantity", NUMERIC, True),
    ("price_per_unit", NUMERIC),
    ("commission", NUMERIC),
    ("currency_code", _STR, True),
    ("notes", _STR),
    ("source", _STR),
    ("created_at", _TS),
    ("synced_at", _TS),
)

TRANSACTIONS_V1 = _struct(
    ("transaction_id", _STR, True),
    ("asset_key", _LONG, True),
    ("transaction_timestamp", _TS, True),
    ("transaction_type", _STR, True),
    ("quantity", NUMERIC, True),
    ("price_per_unit", NUMERIC),
    ("commission", NUMERIC),
    ("notes", _STR),
)

PORTFOLIO_SNAPSHOT = _struct(
    ("snapshot_date", _DATE, True),
    ("user_id", _STR, True),
    ("asset_key", _LONG, True),
    ("quantity_held", NUMERIC, True),
    ("avg_cost_basis", NUMERIC),
    ("total_cost_basis", NUMERIC),
    ("cost_basis_currency", _STR),
    ("current_price", NUMERIC),
    ("price_currency", _STR),
    ("market_value", NUMERIC),
    ("unrealized_gain_loss", NUMERIC),
    ("unrealized_gain_loss_pct", NUMERIC),
    ("calculated_at", _TS),
    ("data_quality", _STR),
)

INVESTMENT_SNAPSHOT_V1 = _struct(
    ("snapshot_timestamp", _TS, True),
    ("snapshot_date", _DATE, True),
    ("asset_key", _LONG, True),
    ("quantity", NUMERIC),
    ("price_per_unit_local", NUMERIC),
    ("total_value_local", NUMERIC),
    ("exchange_rate_to_usd", NUMERIC),
    ("total_value_usd", NUMERIC),
    ("ingestion_timestamp", _TS),
)

FIXED_INCOME = _struct(
    ("asset_key", _LONG),
    ("ticker_symbol", _STR),
    ("issue_date", _DATE),
    ("payment_date", _DATE),
    ("amount_at_payment", NUMERIC),
    ("rate", NUMERIC),
    ("type", _STR),
)

FIXED_INCOME_DAILY = _struct(
    ("asset_key", _LONG),
    ("ticker_symbol", _STR),
    ("snapshot_date", _DATE),
    ("ingestion_timestamp", _TS),
    ("maturity_value", NUMERIC),
    ("action_rate", NUMERIC),
    ("price_per_100_nominal_value", NUMERIC),
    ("period_yield", NUMERIC),
    ("annual_percentage_rate", NUMERIC),
    ("effective_annual_rate", NUMERIC),
    ("effective_monthly_rate", NUMERIC),
    ("modified_duration_in_days", _LONG),
)

# Landed price files: ten columns, one header line.
STAGED_PRICES = _struct(
    ("timestamp", _DATE),
    ("open", _DBL),
    ("high", _DBL),
    ("low", _DBL),
    ("close", _DBL),
    ("volume", _LONG),
    ("ticker_symbol", _STR),
    ("exchange_name", _STR),
    ("country", _STR),
    ("is_adjusted", _BOOL),
)

# The price payload before listing columns are added.
PAYLOAD_PRICES = T.StructType(STAGED_PRICES.fields[:6])

# Bond rows arrive as text only.
BOND_STAGING = _struct(
    ("ticker_symbol", _STR),
    ("issue_date", _STR),
    ("payment_date", _STR),
    ("amount_at_payment", _STR),
    ("rate", _STR),
    ("type", _STR),
)

BATCH_RECORD = _struct(("ticker", _STR), ("price", _DBL), ("market", _STR), ("date", _DATE))

MANIFEST = T.StructType(
    [
        T.StructField("run_date", _STR),
        T.StructField("mode", _STR),
        T.StructField("extracted_at", _STR),
        T.StructField(
            "results",
            T.StructType(
                [
                    T.StructField(
                        "success",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("symbol", _STR),
                                    T.StructField("country", _STR),
                                    T.StructField("exchange", _STR),
                                    T.StructField("gcs_uri", _STR),
                                ]
                            )
                        ),
                    ),
                    T.StructField(
                        "failed",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("symbol", _STR),
                                    T.StructField("country", _STR),
                                    T.StructField("exchange", _STR),
                                ]
                            )
                        ),
                    ),
                    T.StructField("total", _LONG),
                ]
            ),
        ),
    ]
)

# name -> (schema, partition columns, clustering columns)
TABLES = {
    "dim_date": (DIM_DATE, ["year"], []),
    "dim_asset": (DIM_ASSET, [], []),
    "fact_price_history": (PRICE_FACT, ["snapshot_date"], ["asset_key"]),
    "transactions": (TRANSACTIONS, ["transaction_date"], ["user_id", "asset_key"]),
    "dim_date_v1": (DIM_DATE_V1, [], []),
    "dim_asset_v1": (DIM_ASSET_V1, [], []),
    "transactions_v1": (TRANSACTIONS_V1, [], []),
    "fact_portfolio_snapshot": (PORTFOLIO_SNAPSHOT, ["snapshot_date"], ["user_id", "asset_key"]),
    "fact_investment_snapshot": (INVESTMENT_SNAPSHOT_V1, ["snapshot_date"], ["asset_key"]),
    "byma_treasuries_fixed_income": (FIXED_INCOME, [], []),
    "byma_treasuries_fixed_income_daily_values": (FIXED_INCOME_DAILY, ["snapshot_date"], []),
}


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
