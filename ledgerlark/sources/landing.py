"""Landing-path layout, run manifests and JSON attributes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.schemas import MANIFEST

# Fixed value: raw/{mode}/{source}/{country}_{exchange}_{symbol}/{run_date}.csv
LANDING_PATH = r"(?:^|/)(raw|processed)/([^/]+)/([^/]+)/([^/_]+)_([^/_]+)_([^/]+)/(\d{4}-\d{2}-\d{2})\.csv$"
LANDING_FIELDS = ("area", "mode", "source", "country", "exchange", "symbol", "run_date")


def landing_path(
    mode: Column, source: Column, country: Column, exchange: Column, symbol: Column, run_date: Column
) -> Column:
    """The path text a landed file gets."""
    listing = F.concat_ws("_", country, exchange, symbol)
    return F.concat(
        F.lit("raw/"), mode, F.lit("/"), source, F.lit("/"), listing, F.lit("/"), run_date, F.lit(".csv")
    )


def parse_landing_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Add the path's parts; all null for a path of another layout."""
    hit = F.col(path).rlike(LANDING_PATH)
    parts = {
        name: F.when(hit, F.regexp_extract(F.col(path), LANDING_PATH, i + 1))
        for i, name in enumerate(LANDING_FIELDS)
    }
    parts["run_date"] = F.try_to_date(parts["run_date"])
    return df.select("*", *[e.alias(n) for n, e in parts.items()])


def scan_manifest(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Successful files of a run's manifest; no rows if the manifest does not exist.

    ``document`` is one JSON document per file, ``lines`` one document per line.
    """
    reader = spark.read.schema(MANIFEST).option("multiLine", str(layout == "document").lower())
    try:
        docs = reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        docs = spark.createDataFrame([], MANIFEST)
    item = F.explode("results.success").alias("f")
    return docs.select("run_date", "mode", item).select(
        "run_date", "mode", "f.symbol", "f.country", "f.exchange", F.col("f.gcs_uri").alias("uri")
    )


def json_field(col: Column | str, path: str, type_name: str) -> Column:
    """One typed attribute of a JSON text column; null if absent or of another type."""
    return stored_field(stored_json(col), path, type_name)


def stored_json(col: Column | str) -> Column:
    """JSON text as a VARIANT, parsed once and stored so; null if it is no JSON."""
    return F.try_parse_json(col)


def stored_field(col: Column | str, path: str, type_name: str) -> Column:
    """One typed attribute of a VARIANT column; null if absent or of another type."""
    return F.try_variant_get(col, path, type_name)

