"""A table as a list of Parquet files, so that a change rewrites the files it touches and no others.

Data files lie under ``data``, in partition folders if there are any; every version of the table is a list of the
files that make it up, under ``versions``. A writer adds files and then a list, and fails if another one has written the
same version; readers see the last list. Files that no list needs any more stay until they are cleared away.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.operators.merge import upsert
from ledgerlark.session import folder_exists
from ledgerlark.sinks.tables import append_fact

VERSION = "file string, version bigint"
MARK_BITS = 25  # 2 ** 25 marks, 64 to a row
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside gives up its shuffle files as each of its jobs ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _name(uri: str) -> str:
    """A file's name under the data folder, from its address."""
    return unquote(uri).rsplit("/data/", 1)[1]


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VERSION).json(f"{path}/versions")


def exists(spark: SparkSession, path: str) -> bool:
    return folder_exists(spark, f"{path}/versions")


def version(spark: SparkSession, path: str) -> int:
    """The number of the last version, 0 if there is none."""
    return _versions(spark, path).agg(F.max("version")).first()[0] if exists(spark, path) else 0


def files(spark: SparkSession, path: str, at: int | None = None) -> list[str]:
    """The names of the files of a version, the last one unless told otherwise."""
    at = version(spark, path) if at is None else at
    found = _versions(spark, path).filter((F.col("version") == at) & (F.col("file") != ""))
    return sorted(r["file"] for r in found.collect())


def read(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """The table, or some of its files."""
    names = files(spark, path) if names is None else list(names)
    schema = spark.read.parquet(f"{path}/data").schema
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{n}" for n in names])


def _present(spark: SparkSession, path: str) -> set[str]:
    if not folder_exists(spark, f"{path}/data"):
        return set()
    return {_name(f) for f in spark.read.parquet(f"{path}/data").inputFiles()}


def _commit(spark: SparkSession, path: str, number: int, names: Sequence[str]) -> None:
    rows = [(n, number) for n in names] or [("", number)]
    spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("error").json(f"{path}/versions/v={number:08d}")


def swap(
    spark: SparkSession, path: str, gone: Sequence[str], rows: DataFrame | Sequence[DataFrame], partition: str, cluster: Sequence[str],
    dealt: Sequence[DataFrame] = (),
) -> dict[str, list[str]]:
    """A new version: ``rows`` in files of their own in place of the files ``gone``; one writer at a time.

    Frames in ``dealt`` are added too, each row by the task that has it.
    """
    number = version(spark, path)
    live = files(spark, path) if number else []
    before = _present(spark, path)
    with passing_shuffles(spark):
        for df in [rows] if isinstance(rows, DataFrame) else rows:
            append_fact(df, f"{path}/data", partition, cluster, compression="zstd")
        for df in dealt:
            append_fact(df, f"{path}/data", partition, cluster, dealt=True, compression="zstd")
    new = sorted(_present(spark, path) - before)
    kept = [n for n in live if n not in set(gone)]
    _commit(spark, path, number + 1, [*kept, *new])
    return {"kept": kept, "rewritten": sorted(gone), "new": new}


def _mark(on: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(1 << MARK_BITS))


def marks(hit: DataFrame, on: Sequence[str]) -> DataFrame:
    """Hashes of the keys of ``hit`` as bits, 64 to a row: at most 2 ** (MARK_BITS - 6) rows, however large ``hit`` is."""
    bits = F.bit_or(F.expr("shiftleft(1L, CAST(_m & 63 AS INT))")).alias("_bits")
    return hit.select(_mark(on).alias("_m")).groupBy(F.shiftright("_m", 6).alias("_word")).agg(bits)


def may_meet(rows: DataFrame, hit: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with ``_may``: false tells that ``hit`` has no row of their key. The marks, of bounded size, go to every task.

    Keys of two types have two hashes; then any row may meet one.
    """
    if any(rows.schema[c].dataType != hit.schema[c].dataType for c in on):
        return rows.withColumn("_may", F.lit(True))
    found = rows.withColumn("_m", _mark(on)).join(F.broadcast(marks(hit, on)), F.shiftright("_m", 6) == F.col("_word"), "left")
    may = F.expr("coalesce(_bits & shiftleft(1L, CAST(_m & 63 AS INT)), 0) <> 0")
    return found.withColumn("_may", may).drop("_m", "_word", "_bits")


def touched(table: DataFrame, hit: DataFrame, on: Sequence[str], within: Column | None = None) -> list[str]:
    """The names of the files of ``table`` that hold a row that ``hit`` meets; one name a file comes to the driver.

    ``within`` may compare further columns of both, named ``t`` and ``h``.
    """
    named = table.select("*", F.col("_metadata.file_path").alias("_file"))
    rows = may_meet(named, hit, on).filter("_may").alias("t")
    same = [F.col(f"t.{c}") == F.col(f"h.{c}") for c in on] + ([] if within is None else [within])
    with passing_shuffles(table.sparkSession):
        found = rows.join(hit.alias("h"), same, "left_semi").select("_file").distinct().collect()
    return sorted(_name(r["_file"]) for r in found)


def create(df: DataFrame, path: str, partition: str, cluster: Sequence[str]) -> None:
    """Write the first version of a table."""
    swap(df.sparkSession, path, [], df, partition, cluster)


def merge_files(
    spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str], partition: str
) -> dict[str, list[str]]:
    """Upsert that rewrites only files with a matched key; what it inserts goes to files of its own or theirs.

    Returns the names of the files that were kept, replaced and written.
    """
    table = read(spark, path)
    gone = touched(table, source.select(*keys), keys)
    merged = upsert(read(spark, path, gone), source.select(*table.columns), keys, update_cols)
    return swap(spark, path, gone, merged, partition, [k for k in keys if k != partition])


def replace_rows(
    spark: SparkSession, path: str, doomed: DataFrame, on: Sequence[str], within: Column | None,
    fresh: DataFrame, partition: str, cluster: Sequence[str], table: DataFrame | None = None,
) -> dict[str, list[str]]:
    """Take out the rows that ``doomed`` meets and put ``fresh`` in; files without such rows stay.

    ``table`` may be the table with a filter that no doomed row fails, which prunes partitions. Rows whose key no mark of
    ``doomed`` meets are copied by the tasks that read them; only the others are joined and dealt out by ``partition``.
    ``fresh`` comes as it is to be written, many rows of few partitions to a task.
    """
    gone = touched(read(spark, path) if table is None else table, doomed, on, within)
    old = read(spark, path, gone)
    parted = may_meet(old, doomed, on)
    clear, met = parted.filter("NOT _may").drop("_may"), parted.filter("_may").drop("_may")
    same = [F.col(f"t.{c}") == F.col(f"h.{c}") for c in on] + ([] if within is None else [within])
    left = met.alias("t").join(doomed.alias("h"), same, "left_anti")
    return swap(spark, path, gone, left, partition, cluster, dealt=[clear, fresh.select(*old.columns)])
