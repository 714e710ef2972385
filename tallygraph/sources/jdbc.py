"""JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    custom_schema: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options. ``partition_column`` and ``bounds`` make the executors read in parallel.

    ``custom_schema`` overrides column types, e.g. ``"id DECIMAL(38, 0), name STRING"``.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    if custom_schema:
        options["customSchema"] = custom_schema
    if partition_column:
        low, high = bounds
        options.update(
            partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=str(partitions)
        )
    return options


def write_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column_types: str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Writer options. ``column_types`` overrides the types of a created table.

    ``partitions`` bounds the number of parallel connections.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    if column_types:
        options["createTableColumnTypes"] = column_types
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def read_table(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """A database table; settings as in :func:`read_options`."""
    return spark.read.format("jdbc").options(**read_options(url, table, **settings)).load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "error", **settings) -> None:
    """Write to a database table; settings as in :func:`write_options`."""
    df.write.format("jdbc").mode(mode).options(**write_options(url, table, **settings)).save()
