"""Batch writers and table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame, path: str, mode: str = "error", partition_by: str | None = None
) -> None:
    """Parquet files: ``error`` if they exist, ``overwrite`` or ``append``."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_orc(
    df: DataFrame,
    path: str,
    mode: str = "error",
    bloom_columns: str | None = None,
    dictionary_threshold: float | None = None,
    direct_encoding: str | None = None,
) -> None:
    """ORC files with bloom filters, dictionary threshold and direct-encoded columns."""
    writer = df.write.format("orc").mode(mode)
    if bloom_columns:
        writer = writer.option("orc.bloom.filter.columns", bloom_columns)
    if dictionary_threshold is not None:
        writer = writer.option("orc.dictionary.key.threshold", str(dictionary_threshold))
    if direct_encoding:
        writer = writer.option("orc.column.encoding.direct", direct_encoding)
    writer.save(path)


def write_lines(df: DataFrame, path: str, mode: str = "error", single_file: bool = False) -> None:
    """One string column as text. ``single_file`` is for small results only: one task writes it."""
    (df.repartition(1) if single_file else df).write.mode(mode).text(path)


def bucket_count(*frames: DataFrame, bytes_each: int = 32 << 20) -> int:
    """Buckets that hold about ``bytes_each`` of the largest frame.

    A bucket is sorted by one task, and compressed files tell little of the memory that takes. So
    rows are counted, at the widths of their types; the planner's estimate counts where it is larger.
    """

    def size(frame: DataFrame) -> int:
        planned = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return max(planned, frame.count() * frame._jdf.schema().defaultSize())

    return max(1, *(-(-size(frame) // bytes_each) for frame in frames))


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "error",
    partition_by: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    sort_by: str | None = None,
    path: str | None = None,
    files_per_bucket: int = 1,
) -> None:
    """Table, partitioned, or bucketed and sorted for joins without a shuffle.

    Without a path it is a managed table of the warehouse. Rows are first hashed by the bucket
    column, so that a bucket is written by one task and not by all of them. ``files_per_bucket``
    spreads each key over several tasks, for buckets that are too large for one.
    """
    if bucket_by:
        spread = [F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))] if files_per_bucket > 1 else []
        df = df.repartition(buckets * files_per_bucket, bucket_by, *spread)
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by)
        if sort_by:
            writer = writer.sortBy(sort_by)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_view(df: DataFrame, name: str, shared: bool = False) -> str:
    """Temporary view of a session, or of all sessions with ``shared``; returns its SQL name."""
    if shared:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name
