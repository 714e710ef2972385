"""User-defined averages, written so that they combine before the shuffle."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def average(value: Column) -> Column:
    """Mean of the non-null values; NaN for a group without any."""
    count = F.count(value)
    return F.when(count == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.sum(value.cast("double")), count))


def _merge_averages(sums: pa.Array, counts: pa.Array) -> float:
    total = pc.sum(counts).as_py()
    return pc.sum(sums).as_py() / total if total else float("nan")


def register_average(spark: SparkSession, name: str = "my_average") -> None:
    """Register a SQL aggregate that merges ``(sum, count)`` partials and finishes the mean."""
    spark.udf.register(name, F.arrow_udf(_merge_averages, DoubleType()))


def average_partials(df: DataFrame, keys: list[str], value: str, spread: int = 32) -> DataFrame:
    """At most ``spread`` rows ``(keys, sum, count)`` per key, the input of the SQL aggregate.

    The Python aggregate gets these few rows of a key and never the group itself.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    return (
        df.groupBy(*keys, salt.alias("salt"))
        .agg(F.sum(F.col(value).cast("double")).alias("sum"), F.count(value).alias("count"))
        .drop("salt")
    )


def typed_average(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Zero / reduce / merge / finish average kept as a ``buffer`` struct next to its result."""
    buffer = F.struct(
        F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("sum"),
        F.count(value).alias("count"),
    )
    return df.groupBy(*keys).agg(buffer.alias("buffer")).withColumn(
        "average",
        F.when(F.col("buffer.count") == 0, F.lit(float("nan"))).otherwise(
            F.try_divide(F.col("buffer.sum"), F.col("buffer.count"))
        ),
    )


@F.pandas_udf(DoubleType())
def round2(values: pd.Series) -> pd.Series:
    """Half-up rounding to two decimals, kept as the Arrow UDF surface."""
    return np.sign(values) * np.floor(np.abs(values) * 100 + 0.5) / 100
