"""User-chosen partitioning of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_by_key(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash partitioning by a key, schema kept."""
    return df.repartition(partitions, key)


def partition_by_rule(df: DataFrame, rule: Column, partitions: int) -> DataFrame:
    """Rows go to the partition whose number the rule yields."""
    return df.repartitionById(partitions, F.pmod(rule.cast("int"), F.lit(partitions)))
