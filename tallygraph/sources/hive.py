"""Hive tables. Needs a session built with ``hive=True``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_text_table(spark: SparkSession, name: str, columns: str) -> None:
    """Table in Hive's text format."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING hive")


def load_file(spark: SparkSession, name: str, path: str, local: bool = True) -> None:
    """Load a file into a Hive table."""
    spark.sql(f"LOAD DATA {'LOCAL ' if local else ''}INPATH '{path}' INTO TABLE {name}")


def create_parquet_table(spark: SparkSession, name: str, columns: str) -> None:
    """Hive table stored as Parquet."""
    spark.sql(f"CREATE TABLE {name} ({columns}) STORED AS PARQUET")


def create_external_table(spark: SparkSession, name: str, columns: str, location: str) -> None:
    """Hive table over existing Parquet files; columns match the files by name."""
    spark.sql(f"CREATE EXTERNAL TABLE {name} ({columns}) STORED AS PARQUET LOCATION '{location}'")


def write_dynamic_partitions(df: DataFrame, name: str, partition_by: str) -> None:
    """Hive-format table partitioned by the values of a column, which becomes the last column."""
    spark = df.sparkSession
    spark.conf.set("hive.exec.dynamic.partition", "true")
    spark.conf.set("hive.exec.dynamic.partition.mode", "nonstrict")
    df.write.partitionBy(partition_by).format("hive").saveAsTable(name)
