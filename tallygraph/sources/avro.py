"""Avro files and Avro-encoded columns. Needs the spark-avro package on the class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_avro(spark: SparkSession, path: str, reader_schema: str | None = None) -> DataFrame:
    """Avro records as rows; ``reader_schema`` is an Avro schema in JSON."""
    reader = spark.read.format("avro")
    if reader_schema:
        reader = reader.option("avroSchema", reader_schema)
    return reader.load(path)


def write_avro(df: DataFrame, path: str, mode: str = "error") -> None:
    """Rows as Avro records."""
    df.write.format("avro").mode(mode).save(path)


def decode(column: Column, schema: str) -> Column:
    """A binary column of Avro records as structs."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(column, schema)


def as_maps(df: DataFrame) -> DataFrame:
    """Each record as one map from field name to its JSON text; null fields are left out."""
    pairs = [F.struct(F.lit(c).alias("k"), F.to_json(F.struct(F.col(c).alias("v"))).alias("v")) for c in df.columns]
    present = F.filter(F.array(*pairs), lambda e: e["v"] != F.lit("{}"))
    inner = F.transform(
        present, lambda e: F.struct(e["k"].alias("k"), F.regexp_extract(e["v"], r'(?s)^\{"v":(.*)\}$', 1).alias("v"))
    )
    return df.select(F.map_from_entries(inner).alias("record"))
