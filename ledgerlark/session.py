"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan in this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

WORK_DIR_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with whoever built the session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", partitions: int = 8, folder: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    builder = builder.config(WORK_DIR_CONF, folder or tempfile.mkdtemp(prefix="ledgerlark-"))
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``."""
    named = spark.conf.get(WORK_DIR_CONF, None)
    if not named:
        raise RuntimeError(f"set {WORK_DIR_CONF} to a folder all executors share")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder, on whatever file system the path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
