"""Stream sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.storage import scratch_path

_SUBSCRIPTIONS = ("assign", "subscribe", "subscribePattern")


def kafka_options(
    servers: str,
    subscription: str,
    topics: str,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. Consumed offsets are kept in the query's checkpoint.

    ``security`` takes client settings such as ``security.protocol`` and ``sasl.mechanism``.
    """
    if subscription not in _SUBSCRIPTIONS:
        raise ValueError(f"subscription must be one of {', '.join(_SUBSCRIPTIONS)}")
    options = {
        "kafka.bootstrap.servers": servers,
        subscription: topics,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for key, value in (security or {}).items():
        options[f"kafka.{key}"] = value
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka records as ``(value STRING, timestamp)``. Needs the Kafka connector package."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"), "timestamp")


def read_socket(
    spark: SparkSession, host: str, port: int, include_timestamp: bool = False
) -> DataFrame:
    """Lines of a text socket, with their time of arrival if asked for."""
    return (
        spark.readStream.format("socket")
        .options(host=host, port=port, includeTimestamp=include_timestamp)
        .load()
    )


def read_new_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the text files that appear in a folder."""
    return spark.readStream.text(folder)


def union_streams(streams: Sequence[DataFrame]) -> DataFrame:
    """One stream of several with the same columns."""
    return reduce(DataFrame.unionByName, streams)


def replay(
    df: DataFrame, order_by: str, batches: int, files_per_batch: int | None = None
) -> DataFrame:
    """A table as a stream of about ``batches`` micro-batches, each made of ranges of ``order_by``.

    By default the files of all batches keep every task slot busy. Rows of one ``order_by`` value
    are split further by content, so a frequent value does not end up in one file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "replay")
    files_per_batch = files_per_batch or max(1, spark.sparkContext.defaultParallelism // batches)
    ranges = df.repartitionByRange(batches * files_per_batch, order_by, F.xxhash64(*df.columns))
    ranges.write.parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
