"""Per-batch partial sums of vectors: the map-side half of an element-wise aggregate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain_matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as a matrix of their own type."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as a matrix of doubles."""
    return plain_matrix(column).astype(np.float64, copy=False)


def partial_sums(
    df: DataFrame, summarize: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]
) -> DataFrame:
    """``(key, n, sums)`` rows: what ``summarize`` returns for each Arrow batch.

    A batch gives one row per key, so what is shuffled afterwards does not grow with the rows of
    a batch, and a key that holds most rows is no longer hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, counts, sums = summarize(batch)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(keys, pa.int32()),
                        "n": pa.array(counts, pa.int64()),
                        "sums": pa.array(list(sums), pa.list_(pa.float64())),
                    }
                )

    return df.mapInArrow(run, "key INT, n BIGINT, sums ARRAY<DOUBLE>")


def vector_sums(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Element-wise sum of the vectors of each key, as ``(keys, rows, sums)``."""
    parts = df.select(*keys, F.posexplode(vector).alias("_pos", "_value"))
    summed = parts.groupBy(*keys, "_pos").agg(
        F.sum(F.col("_value").cast("double")).alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )
    entry = F.sort_array(F.collect_list(F.struct("_pos", "_sum")))
    return summed.groupBy(*keys).agg(
        F.max("_rows").alias("rows"), F.transform(entry, lambda e: e["_sum"]).alias("sums")
    )
