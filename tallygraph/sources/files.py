"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files; with ``merge_schema`` the union of the columns of all files."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """Files in the session's default format (Parquet unless configured otherwise)."""
    return spark.read.load(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """JSON lines. Without a schema the files are read once more to infer one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def parse_json(df: DataFrame, column: str, schema: str | Column, alias: str = "parsed") -> DataFrame:
    """A column of JSON strings as a struct column; malformed strings become null."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def schema_of_example(example: str) -> Column:
    """Schema of one JSON example, for :func:`parse_json`."""
    return F.schema_of_json(F.lit(example))


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    schema: str | StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header. Without a schema the types are inferred."""
    reader = spark.read.options(sep=sep, header=header, multiLine=multi_line, escape='"')
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``; compressed files are decompressed by their ending."""
    return spark.read.text(path)


def query_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SQL directly on files."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def string_schema(names: Sequence[str]) -> str:
    """Schema text in which every named column is a nullable string."""
    return ", ".join(f"`{name}` STRING" for name in names)


def fields(text: Column, names: Sequence[tuple[str, str]], sep: str = ",") -> list[Column]:
    """Typed columns ``(name, type)`` of delimited text; a field that does not parse is null."""
    parts = F.split(text, sep)
    return [
        F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(names)
    ]


def split_columns(
    lines: DataFrame, names: Sequence[tuple[str, str]], sep: str = ",", column: str = "value"
) -> DataFrame:
    """Delimited text lines as a table of :func:`fields`."""
    return lines.select(*fields(F.col(column), names, sep))


def keyed_attributes(lines: DataFrame, sep: str = ",", column: str = "value") -> DataFrame:
    """``id, attribute, attribute ...`` lines as ``(id BIGINT, attrs ARRAY<STRING>)``."""
    parts = F.split(F.col(column), sep)
    return lines.select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias("id"),
        F.slice(parts, 2, F.size(parts)).alias("attrs"),
    )


def vectors(lines: DataFrame, sep: str = " ", column: str = "value") -> DataFrame:
    """Lines of numbers as ``vector``."""
    return lines.select(F.split(F.col(column), sep).cast("array<double>").alias("vector"))


def labelled_points(lines: DataFrame, sep: str = " ", column: str = "value") -> DataFrame:
    """``y x1 x2 ...`` lines as ``(y, x)``."""
    numbers = F.split(F.col(column), sep).cast("array<double>")
    return lines.select(numbers[0].alias("y"), F.slice(numbers, 2, F.size(numbers)).alias("x"))


def source_files(df: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Files a frame is read from and their rows; ``%20`` is shown as a blank.

    Files whose path contains an excluded text are left out.
    """
    path = F.regexp_replace(F.input_file_name(), "%20", " ")
    files = df.select(path.alias("path"))
    for text in excluded:
        files = files.where(~F.col("path").contains(text))
    return files.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
