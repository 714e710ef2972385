"""Shared working storage: where loops cut their lineage and streams keep their progress.

Everything goes below the folder that the cluster names in ``spark.checkpoint.dir``, so a lost
executor never takes intermediate results with it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor. A local folder is chosen only for a local master."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallygraph-")
    spark.conf.set(_CHECKPOINT_DIR, folder)
    return folder


def _own_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application alone."""
    return f"{shared_dir(spark)}/tallygraph/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small or narrow state, computed once and cut from its lineage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a wide or much-reused result as Parquet and read it back.

    Unlike a checkpoint the copy is columnar, so each later use reads only the columns it needs
    and the planner knows its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at a path of any file system Spark knows."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def release(spark: SparkSession) -> None:
    """Delete what this application wrote through :func:`scratch_path`, and nothing else."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(hadoop).delete(path, True)
