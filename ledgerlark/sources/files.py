"""Scans of landed files: declared CSV, NDJSON, and the all-or-nothing file load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlark.operators.quality import validate_transactions
from ledgerlark.schemas import STAGED_PRICES, TRANSACTIONS, required_columns
from ledgerlark.session import fresh_path

BAD_LINE = "_bad_line"
FILE = "source_file"


def scan_prices_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed price files: one header line, ten declared columns, nothing inferred.

    A malformed line fails the job; see :func:`load_files_atomic` for the tolerant load.
    """
    reader = spark.read.schema(STAGED_PRICES).option("header", True).option("mode", "FAILFAST")
    return reader.csv(path)


def with_bad_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])


def is_bad_line(columns: Sequence[str]) -> Column:
    """Whether a line failed to parse in any column.

    Spark parses only the columns a query uses, and a bad value elsewhere goes unseen. So
    the test uses them all, in a condition that always holds but is not folded away.
    """
    uses_all = F.xxhash64(*columns).bitwiseOR(F.lit(1)) != 0
    return F.col(BAD_LINE).isNotNull() & uses_all


def file_uri(uri: Column) -> Column:
    """A file name as Spark reports it: one slash after ``file:``, blanks escaped."""
    return F.replace(F.regexp_replace(uri, "^file:/+", "file:/"), F.lit(" "), F.lit("%20"))


def load_files_atomic(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = STAGED_PRICES,
    expected: DataFrame | None = None,
    member: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, file report): a file with any bad line is left out whole.

    ``path`` is a folder or glob. ``expected`` (column ``uri``, for example a manifest scan)
    limits the load to the files it names and reports the ones that are not there.
    With ``member``, a column of the schema, files are packs of many small ones: each line names its own,
    and these members (:func:`member_uri`), not the packs, are expected, judged and reported; a member has no size.
    """
    parsed = (
        spark.read.schema(with_bad_line(schema))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
        .select("*", (F.col("_metadata.file_path") if member is None else member_uri(member)).alias(FILE))
    )
    if member is not None:
        listed = parsed.select(FILE).distinct().withColumn("bytes", F.lit(0).cast("bigint"))
        return split_files(*_wanted(parsed, listed, expected), [f.name for f in schema.fields])
    # The listing sees files without rows too; only paths are read, not contents.
    listed = (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("_metadata.file_path").alias(FILE), F.col("length").alias("bytes"))
    )
    return split_files(*_wanted(parsed, listed, expected), [f.name for f in schema.fields])


def member_uri(member: str) -> Column:
    """The address of a small file inside a pack: the pack's, and what the line calls its own."""
    return file_uri(F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col(member)))


def _wanted(parsed: DataFrame, listed: DataFrame, expected: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    if expected is None:
        return parsed, listed
    wanted = expected.select(file_uri(F.col("uri")).alias(FILE)).distinct()
    return parsed.join(wanted, FILE, "left_semi"), wanted.join(listed, FILE, "left")


def split_files(
    parsed: DataFrame, listed: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split parsed rows by file verdict. Runs one pass over the rows.

    The verdict is an aggregate over the file, with one partial row per task and file, so a
    file larger than one task is no obstacle. It is written to the work folder once, so the
    size of the list of bad files is known, and Spark picks the join by it.
    """
    spark = parsed.sparkSession
    path = fresh_path(spark, "file-verdicts")
    parsed.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(is_bad_line(columns)).alias("bad_lines")
    ).write.parquet(path)
    verdicts = spark.read.schema(f"{FILE} string, lines bigint, bad_lines bigint").parquet(path)

    bad = verdicts.filter("bad_lines > 0").select(FILE)
    rows = parsed.join(bad, FILE, "left_anti")
    status = (
        F.when(F.col("bytes").isNull(), "missing")
        .when(F.col("bad_lines") > 0, "rejected")
        .otherwise("loaded")
    )
    report = listed.join(verdicts, FILE, "left").select(
        FILE,
        status.alias("status"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("bad_lines", F.lit(0)).alias("bad_lines"),
    )
    return rows.select(*columns, FILE), report


def scan_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types, for staging. Reads the files twice."""
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    )


def scan_positional_csv(
    spark: SparkSession, path: str, schema: T.StructType
) -> DataFrame:
    """Headerless CSV whose columns are known by position."""
    return spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").csv(path)


def load_transactions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) transactions of a spreadsheet export.

    Unparsable lines and lines that break the transaction rules are rejected with a reason.
    """
    parsed = (
        spark.read.schema(with_bad_line(TRANSACTIONS))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )
    ruled = validate_transactions(parsed)
    missing = F.lit(None).cast("string")
    for name in required_columns(TRANSACTIONS):
        missing = F.coalesce(missing, F.when(F.col(name).isNull(), F.lit(f"missing_{name}")))
    reason = F.when(is_bad_line(TRANSACTIONS.fieldNames()), F.lit("corrupt_line")).otherwise(
        F.coalesce(missing, F.col("error_code"))
    )
    marked = ruled.withColumn("reject_reason", reason)
    good = marked.filter(F.col("reject_reason").isNull()).select(*TRANSACTIONS.fieldNames())
    return good, marked.filter(F.col("reject_reason").isNotNull()).drop("error_code")
