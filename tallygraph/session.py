"""Session settings the library is tuned for, and access to a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Adaptive execution sizes shuffles, splits skewed join partitions and turns a join into a
# broadcast once the small side has been measured, so none of these is tuned per query.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where a grouping on the same key follows, for one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "tallygraph",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    hive: bool = False,
    **settings: str,
) -> SparkSession:
    """Session with the library defaults. On a cluster leave ``master`` to spark-submit.

    ``settings`` are extra Spark options with dots written as double underscores,
    e.g. ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder; a file and a directory of part files both work."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table read as a stream of files."""
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A glob, because the stream source takes a plain path to be a directory.
    return reader.parquet(f"{folder}/{name}.parque[t]")
