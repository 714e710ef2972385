"""Aggregations and joins for keys that hold a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallygraph.storage import checkpoint, materialize


def salted_aggregate(
    df: DataFrame,
    keys: list[str],
    partial: dict[str, Column],
    final: dict[str, Column],
    salts: int = 64,
) -> DataFrame:
    """Aggregate by ``(keys, salt)`` and then by ``keys``.

    ``partial`` computes named columns from rows, ``final`` merges those columns. Rows are salted
    by content, so a rerun of a lost task puts every row where it was before.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    first = df.groupBy(*keys, salt.alias("_salt")).agg(
        *[expr.alias(name) for name, expr in partial.items()]
    )
    return first.groupBy(*keys).agg(*[expr.alias(name) for name, expr in final.items()])


def heavy_keys(rows: DataFrame, key: str, share: float) -> tuple[DataFrame, DataFrame]:
    """``(rows, heavy)``: the rows, written once, and the keys that hold more than ``share`` of them.

    A frequent-items sketch is filled by every task while the rows are written, so they are
    computed once and no key is shuffled to be counted. Every key above the share is in ``heavy``
    (key, ``rows``); counts may be off by a ninth of the share, so keys just below it may be too.
    The sketch keeps a number of keys that follows from the share, and ``heavy`` at most two for
    each share. Null is no key.
    """
    shares = math.ceil(1 / share)
    # The error of the sketch is at most 3.5 / tracked of all rows.
    tracked = min(1_000_000, 32 * shares)
    seen = Observation()
    top = F.expr(f"approx_top_k(`{key}`, {2 * shares}, {tracked})")
    written = materialize(rows.observe(seen, top.alias("top"), F.count(F.lit(1)).alias("rows")), "observed")
    found = seen.get
    least = found["rows"] * (share - 3.5 / tracked)
    heavy = [(t["item"], t["count"]) for t in found["top"] or [] if t["item"] is not None and t["count"] > least]
    schema = StructType([rows.schema[key], StructField("rows", LongType())])
    return written, rows.sparkSession.createDataFrame(heavy, schema)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot_rows: int | None = None,
    salts: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi-join in which the left rows of every hot key are spread over several tasks.

    A key is hot when the left side has more than ``hot_rows`` rows of it, which takes a count of
    all keys; by default when it has more than an even share of the rows for every shuffle
    partition, which a sketch finds while the rows are written. Each hot key gets ``salts`` tasks,
    by default one for each such share. The right rows of hot keys, and only those, are repeated
    once per salt. Rows without a key are spread like those of a hot key. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join keeps the left side: how must be inner or left")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot_rows is None:
        left, heavy = heavy_keys(left, key, 1 / partitions)
        even = F.greatest(F.lit(1), F.lit(left.count()) / partitions)
        heavy = F.broadcast(heavy)
    else:
        counted = left.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        heavy, even = counted.where(F.col("rows") > hot_rows), F.lit(max(1, hot_rows))
    wanted = F.greatest(F.lit(2), F.ceil(F.col("rows") / even)) if salts is None else F.lit(salts)
    hot = heavy.select(key, wanted.cast("int").alias("_salts"))
    keyless = F.when(F.col(key).isNull(), F.lit(salts or partitions))
    row_salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.coalesce("_salts", keyless))
    spread = left.join(hot, key, "left").withColumn("_salt", F.coalesce(row_salt, F.lit(0)))
    repeated = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .withColumn("_salt", F.col("_salt").cast("bigint"))
        .drop("_salts")
    )
    spread = spread.drop("_salts").withColumn("_salt", F.col("_salt").cast("bigint"))
    spread = spread.repartition(key, "_salt")
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def per_key_join(
    rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join rows to a table with one row per key that was itself aggregated by that key.

    Adaptive execution splits a skewed join partition only when both inputs come straight from a
    shuffle. An aggregate right below the join would hide the skew of ``rows``, so the per-key
    table is cut off first.
    """
    return rows.join(checkpoint(per_key), keys, how)
