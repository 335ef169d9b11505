"""Incremental ingestion: every landed file once, whole files or none."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerlark.operators.prices import PRICE_SOURCE, to_price_fact
from ledgerlark.schemas import STAGED_PRICES
from ledgerlark.sources.files import BAD_LINE, FILE, split_files, with_bad_line


@dataclass(frozen=True)
class IngestPaths:
    """Where an ingestion reads and writes."""

    landing: str
    facts: str
    reports: str
    checkpoint: str
    archive: str | None = None
    files_a_batch: int = 1000


class BatchCounts(NamedTuple):
    """What a micro-batch landed and inserted; files and bytes are null once Spark has dropped the batch's progress."""

    ingest_batch: int
    files: int | None
    bytes: int | None
    inserted: int


# The columns of Spark's whole-file reader; only names and lengths are read here.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def open_landing(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """Names and lengths of the landed CSV files as a stream, files without rows included."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", paths.files_a_batch)
    found = reader.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(paths.landing)
    return found.select(F.col("_metadata.file_path").alias(FILE), F.col("length").alias("bytes"))


def read_files(spark: SparkSession, names: list[str], schema: T.StructType = STAGED_PRICES) -> DataFrame:
    reader = spark.read.schema(with_bad_line(schema)).option("header", True).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", BAD_LINE).csv(names)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))


def move_file(spark: SparkSession, name: str, landing: str, archive: str) -> None:
    """Move a landed file to the same place under the archive; nothing to do if it is gone."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    source = path(name)
    system = source.getFileSystem(conf)
    root, whole = system.makeQualified(path(landing)).toUri().getPath(), source.toUri().getPath()
    target = path(f"{archive.rstrip('/')}/{whole[len(root):].lstrip('/')}")
    if system.exists(source):
        system.mkdirs(target.getParent())
        system.rename(source, target)


def ingest_new_files(
    spark: SparkSession,
    paths: IngestPaths,
    ingested_at: Column | None = None,
    source: str = PRICE_SOURCE,
) -> list[BatchCounts]:
    """Load what landed since the last run into the price facts, and report every file.

    The checkpoint remembers the files, so a rerun adds nothing. A batch writes its own
    ``ingest_batch`` partition and overwrites only that, so a batch that is repeated after
    a lost driver or executor leaves no duplicate. A file with a bad line is reported as
    rejected and none of its rows is kept; once corrected, deliver it under a new name. Files
    without rows are reported too. Loaded files move to the archive, if there is one, after
    facts and report are written; rejected ones stay where they landed.

    Returns the counts of each micro-batch of this run that had files. Nothing is read again for them: inserted rows are
    observed on the write, files and bytes on the stream, whose progress Spark keeps for the last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    inserted: dict[int, int] = {}

    def load(batch: DataFrame, batch_id: int) -> None:
        columns = STAGED_PRICES.fieldNames()
        found = batch.collect()  # ``files_a_batch`` names and lengths at most
        if not found:
            return
        listed = spark.createDataFrame(found, f"{FILE} string, bytes bigint")
        rows, report = split_files(read_files(spark, [r[FILE] for r in found]), listed, columns)
        written = Observation()
        facts = to_price_fact(rows, stamp, source).withColumn("ingest_batch", F.lit(batch_id))
        counted = facts.observe(written, F.count(F.lit(1)).alias("inserted"))
        for df, path in ((counted, paths.facts), (report.withColumn("ingest_batch", F.lit(batch_id)), paths.reports)):
            (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("ingest_batch")
                .parquet(path)
            )
        inserted[batch_id] = written.get["inserted"]
        if paths.archive:
            stored = spark.read.parquet(paths.reports).filter((F.col("ingest_batch") == batch_id) & (F.col("status") == "loaded"))
            for row in stored.select(FILE).collect():
                move_file(spark, row[FILE], paths.landing, paths.archive)

    query = (
        open_landing(spark, paths)
        .observe("landed", F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed = {p.batchId: p.observedMetrics.get("landed") for p in query.recentProgress}

    def counts(batch_id: int, rows: int) -> BatchCounts:
        seen = landed.get(batch_id)
        return BatchCounts(batch_id, seen and seen["files"], seen and seen["bytes"], rows)

    return [counts(*b) for b in sorted(inserted.items())]
