"""Word totals of a set of lines before and after a round trip through text files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import words
from tallygraph.sources.writers import write_lines


def word_total(lines: DataFrame, alias: str = "words") -> DataFrame:
    """Number of words in all lines."""
    return lines.agg(F.coalesce(F.sum(F.size(words(F.col("value")))), F.lit(0)).alias(alias))


def words_before_and_after(lines: DataFrame, path: str) -> DataFrame:
    """Totals ``(before, after)`` of lines and of the same lines written to text and read back."""
    write_lines(lines.select("value"), path)
    copy = lines.sparkSession.read.text(path)
    both = lines.select("value", F.lit(True).alias("original")).unionByName(
        copy.withColumn("original", F.lit(False))
    )
    size = F.size(words(F.col("value")))
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("original"), size)), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.when(~F.col("original"), size)), F.lit(0)).alias("after"),
    )
