"""Identity of documents, for operators that send pieces of texts away and bring marks back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST = -(1 << 63)


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text beside ``_row``, a hash of both.

    ``_row`` tells documents with equal keys apart and orders them; fully repeated rows share it.
    """
    return docs.select(key, text, F.xxhash64(key, text).alias("_row"))


def addressed(rows: DataFrame, key: str, text: str, *more: str) -> DataFrame:
    """``_order`` (the key, a null before all others), ``_row`` and ``_text`` of identified rows."""
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(FIRST).cast("bigint"))
    return rows.select(order.alias("_order"), "_row", F.col(text).alias("_text"), *more)


def joined_by_row(docs: DataFrame, key: str, text: str, marks: DataFrame, how: str) -> DataFrame:
    """All columns of the documents and ``_row`` beside the marks of their row.

    The texts are moved in the same shape by every call on the same columns, so the calls of one
    plan share one exchange of them. The marks are the side that is held in memory.
    """
    rows = docs.withColumn("_row", F.xxhash64(key, text))
    return rows.join(marks.hint("shuffle_hash"), "_row", how)
