"""Writers: partitioned facts, dimension, raw CSV, NDJSON, manifests, declared tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerlark.operators.merge import append_new, upsert
from ledgerlark.schemas import TABLES


def append_fact(
    df: DataFrame,
    path: str,
    partition: str = "snapshot_date",
    cluster: Sequence[str] = ("asset_key",),
    mode: str = "append",
    observation: Observation | None = None,
    bounds: Mapping[str, Sequence[int]] | None = None,
    cells: int = 1,
    dealt: bool = False,
    compression: str | None = None,
) -> None:
    """Add rows to a day-partitioned fact, clustered across and inside its files.

    The input is read once: rows are dealt to tasks by their day and cell under a rebalancing hint, so that
    adaptive execution joins small tasks and cuts large ones by the sizes it finds. Without ``bounds`` a day is one cell and
    rows are sorted by the ``cluster`` columns in turn. With ``bounds`` (:func:`cluster_bounds`) the
    columns count alike: rows are sorted by their interleaved ranks, and a day is cut into ``cells`` (a
    power of two) ranges of them, so that files have narrow ranges of every column; take some cells more than a day has
    files. Rows that are ``dealt`` already, many of few days to a task, are written by the tasks that have them. An ``observation`` gets the number of rows written as ``inserted``.
    """
    if bounds:
        bits = _bits(max(len(bounds[c]) + 1 for c in cluster))
        z = interleaved([quantile_rank(df, c, bounds[c]) for c in cluster], bits)
        coarse = max(bits * len(cluster) - _bits(cells), 0)
        ranked = df.withColumn("_z", z).withColumn("_cell", F.shiftright("_z", coarse))
        spread, order = [partition, "_cell"], [partition, "_z", *cluster]
    else:
        ranked, spread, order = df, [partition], [partition, *cluster]
    placed = ranked if dealt else ranked.hint("rebalance", *[F.col(c) for c in spread])
    laid_out = placed.sortWithinPartitions(*order).select(*df.columns)
    if observation is not None:
        laid_out = laid_out.observe(observation, F.count(F.lit(1)).alias("inserted"))
    (
        laid_out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .options(**{"compression": compression} if compression else {})
        .partitionBy(partition)
        .parquet(path)
    )


def _bits(n: int) -> int:
    return max(n - 1, 0).bit_length()


def ordered_number(df: DataFrame, column: str) -> Column:
    """A whole number in the order of the column: the value, the day, or the first seven bytes of a text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("bigint")
    return F.floor(F.col(column)).cast("bigint")


def cluster_bounds(df: DataFrame, columns: Sequence[str], parts: int = 16) -> dict[str, list[int]]:
    """Approximate quantiles that cut each column into ``parts``: some numbers a column, from one aggregate.

    Take them from a table smaller than the fact, such as a dimension, or from an earlier load.
    """
    at = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    row = df.agg(*[F.percentile_approx(ordered_number(df, c), at, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def quantile_rank(df: DataFrame, column: str, bounds: Sequence[int]) -> Column:
    """How many bounds a value reaches; null reaches none."""
    steps = F.array(*[F.lit(b).cast("bigint") for b in bounds]).cast("array<bigint>")
    value = ordered_number(df, column)
    return F.coalesce(F.size(F.filter(steps, lambda b: b <= value)), F.lit(0)).cast("bigint")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits in turn, the highest of each first: near numbers are near in every rank."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            out = F.shiftleft(out, 1) + F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
    return out


def write_dim_date(df: DataFrame, path: str) -> None:
    """The date dimension, one partition per year."""
    df.repartition("year").sortWithinPartitions("date_key").write.mode("overwrite").partitionBy(
        "year"
    ).parquet(path)


def write_raw_csv(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """CSV with a header line; ``partition`` columns become folders."""
    df.write.mode("append").partitionBy(*partition).option("header", True).csv(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per line; nulls are written, not left out."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def manifest_documents(
    status: DataFrame, extracted_at: Column, n_documents: int
) -> DataFrame:
    """Run manifests in document form, a run spread over ``n_documents`` documents.

    ``status`` has run_date, mode, symbol, country, exchange and uri (null if it failed).
    Every document carries the run's total.
    """
    run = ["run_date", "mode"]
    totals = status.groupBy(*run).agg(F.count(F.lit(1)).alias("total"))
    part = F.pmod(F.xxhash64("symbol", "country", "exchange"), F.lit(n_documents))
    ok, listing = F.col("uri").isNotNull(), [F.col(c) for c in ("symbol", "country", "exchange")]
    lists = status.groupBy(*run, part.alias("_part")).agg(
        F.sort_array(
            F.collect_list(F.when(ok, F.struct(*listing, F.col("uri").alias("gcs_uri"))))
        ).alias("success"),
        F.sort_array(F.collect_list(F.when(~ok, F.struct(*listing)))).alias("failed"),
    )
    return lists.join(totals, run).select(
        F.col("run_date").cast("string").alias("run_date"),
        "mode",
        extracted_at.cast("string").alias("extracted_at"),
        F.struct("success", "failed", "total").alias("results"),
    )


def write_manifest(status: DataFrame, path: str, extracted_at: Column, n_documents: int = 1) -> None:
    """Write manifests as JSON lines, one document a run unless told otherwise."""
    manifest_documents(status, extracted_at, n_documents).write.mode("append").json(path)


def ensure_table(spark: SparkSession, name: str, kind: str, location: str | None = None) -> None:
    """Create a declared warehouse table if it is not there."""
    schema, partitions, _ = TABLES[kind]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    layout = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{place}")


def append_observed(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    dedupe_by: Sequence[str | Column],
) -> dict[str, int]:
    """Idempotent append; returns how many rows were staged and inserted.

    The inserted count is observed on the write itself, not recounted. The staged one is a count of its own: adaptive
    execution drops an observation below a join that it finds empty.
    """
    target = spark.read.schema(source.schema).parquet(path)
    fresh, seen = append_new(target, source, keys, dedupe_by), Observation()
    cluster = [k for k in keys if k != partition]
    append_fact(fresh, path, partition, cluster, observation=seen)
    return {"staged": source.count(), "inserted": seen.get["inserted"]}


def upsert_partitions(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    partition: str,
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the source touches.

    ``partition`` must be among the keys. Dynamic partition overwrite stages the new files
    and swaps them in when the job commits, so the partitions may be read by the same job.
    """
    if partition not in keys:
        raise ValueError("the partition column must be one of the merge keys")
    touched = source.select(partition).distinct()
    current = spark.read.schema(source.schema).parquet(path).join(touched, partition, "left_semi")
    merged = upsert(current, source, keys, update_cols)
    append_fact(merged, path, partition, [k for k in keys if k != partition], mode="overwrite")
