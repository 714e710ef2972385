"""Items of each key in long form, the same shape for a key of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_items(df: DataFrame, keys: list[str], item: str, times: str | None = None) -> DataFrame:
    """One row ``(keys, item, times)`` per key and item, with how often the key has the item.

    ``times`` names a column with the multiplicity of a row. A key may own any share of the rows:
    equal items are added up before they are shuffled, and rows are dealt out by key and item.
    """
    weight = F.col(times) if times else F.lit(1)
    counted = df.groupBy(*keys, item).agg(F.sum(weight).cast("bigint").alias("times"))
    return counted.where("times > 0")
