"""Starting streaming queries and collecting what they write as tables.

All sinks are files below the shared folder, keyed by batch, so that a batch that is run again
after a failure replaces its own output. Progress and state live in the query's checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType

from tallygraph.storage import exists, scratch_path

BatchFunction = Callable[[DataFrame, int], None]


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None, processors: bool = False):
    """Number of state stores of the queries started inside; it is fixed with their checkpoint.

    By default one per task slot, since state partitions are not coalesced at run time. Stateful
    ``processors`` need the RocksDB store.
    """
    settings = {"spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    if processors:
        settings[_PROVIDER] = _ROCKS_DB
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    stream: DataFrame,
    sink: BatchFunction,
    mode: str = "append",
    checkpoint_location: str | None = None,
    interval: str | None = None,
    partitions: int | None = None,
    processors: bool = False,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``sink``.

    With an ``interval`` it runs on as a service; without, it takes what is there and stops.
    """
    spark = stream.sparkSession
    location = checkpoint_location or scratch_path(spark, "progress")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", location)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    with state_partitions(spark, partitions, processors):
        return writer.foreachBatch(sink).start()


def _stop_when_idle(query: StreamingQuery) -> None:
    """Stop a query after its first batch without input. Timers keep it from stopping by itself."""
    try:
        while query.isActive:
            progress = query.lastProgress
            if progress and progress["numInputRows"] == 0:
                break
            time.sleep(0.1)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def run_batches(
    stream: DataFrame,
    per_batch: Callable[[DataFrame], DataFrame],
    mode: str = "append",
    path: str | None = None,
    checkpoint_location: str | None = None,
    timers: bool = False,
    processors: bool = False,
) -> DataFrame:
    """Apply a batch query to every micro-batch; returns all results with their ``batch_id``.

    Given the path and checkpoint of an earlier run, it goes on from there; a run without new input
    returns what there is.

    A query with processing-time ``timers`` never runs out of batches by itself: it is stopped
    once it has taken all input.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "batches")
    schemas = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        result = per_batch(batch)
        schemas.append(result.schema)
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    interval = "1 second" if timers else None
    query = start(stream, sink, mode, checkpoint_location, interval, processors=processors)
    if timers:
        _stop_when_idle(query)
    else:
        query.awaitTermination()
    if not schemas:
        if not exists(spark, path):
            raise RuntimeError("the stream has not delivered a batch")
        written = spark.read.option("mergeSchema", "true").parquet(path)
        return written.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return spark.read.schema(schemas[-1].add("batch_id", LongType())).parquet(path)


def run_complete(
    stream: DataFrame, per_batch: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Final result table of a query in complete mode, optionally shaped by a batch query."""
    spark = stream.sparkSession
    path = scratch_path(spark, "complete")
    last = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        result = per_batch(batch) if per_batch else batch
        result.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        last.update(version=batch_id, schema=result.schema)

    start(stream, sink, "complete").awaitTermination()
    return spark.read.schema(last["schema"]).parquet(f"{path}/version={last['version']}")


def run_update(stream: DataFrame, keys: list[str], timers: bool = False, processors: bool = False) -> DataFrame:
    """Latest row per key of a query in update mode: only changed rows are written per batch."""
    changes = run_batches(stream, lambda batch: batch, mode="update", timers=timers, processors=processors)
    values = [c for c in changes.columns if c not in (*keys, "batch_id")]
    latest = F.max_by(F.struct(*values), "batch_id").alias("_latest")
    return changes.groupBy(*keys).agg(latest).select(*keys, "_latest.*")


def run_append(
    stream: DataFrame, partition_by: str | None = None, path: str | None = None
) -> DataFrame:
    """Append a stream to a Parquet table through the exactly-once file sink."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, "append")
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with state_partitions(spark):
        query = writer.start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def to_console(stream: DataFrame, mode: str, checkpoint_location: str, interval: str) -> StreamingQuery:
    """Print the rows of each batch, for looking at a running stream."""
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("checkpointLocation", checkpoint_location)
        .trigger(processingTime=interval)
        .start()
    )
