"""Building, reshaping and measuring graphs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.operators.skew import per_key_join


def edge_list(spark: SparkSession, path: str, canonical: bool = False) -> DataFrame:
    """Edges of a whitespace-separated text file. Lines starting with ``#`` are comments."""
    line = F.trim("value")
    parts = F.split(line, r"\s+")
    edges = (
        spark.read.text(path)
        .where((F.length(line) > 0) & ~line.startswith("#"))
        .select(parts[0].cast("bigint").alias("src"), parts[1].cast("bigint").alias("dst"))
    )
    return canonical_edges(edges) if canonical else edges


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Every edge turned so that ``src <= dst``."""
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))


def link_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (page, neighbour) pairs of a whitespace-separated text file."""
    parts = F.split(F.col("value"), r"\s+")
    return spark.read.text(path).select(parts[0].alias("src"), parts[1].alias("dst")).distinct()


def vertices_of(edges: DataFrame, default: Column | None = None) -> DataFrame:
    """Distinct edge ends, with a default attribute if given."""
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return ids if default is None else ids.withColumn("attr", default)


def both_directions(edges: DataFrame) -> DataFrame:
    """``(id, neighbour)`` rows; each edge is seen from both of its ends."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("neighbour")),
    )
    return edges.select(F.inline(ends))


def with_attributes(vertices: DataFrame, attributes: DataFrame, defaults: dict) -> DataFrame:
    """Attach attributes by id; vertices without a row get the defaults."""
    return vertices.join(attributes, "id", "left").fillna(defaults)


def subgraph(vertices: DataFrame, edges: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Vertices that satisfy a condition and the edges between them."""
    kept = vertices.where(keep)
    ids = kept.select("id")
    inner = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
    return kept, inner.select(*edges.columns)


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """In + out degree of every vertex, 0 for isolated ones."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    counts = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return vertices.select("id").join(counts, "id", "left").fillna({"degree": 0})


def degree_histogram(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of vertices of each degree."""
    return degrees(vertices, edges).groupBy("degree").agg(F.count(F.lit(1)).alias("vertices"))


def in_neighbours(
    edges: DataFrame, more_than: int, at_most: int, distinct: bool = True
) -> DataFrame:
    """Sorted in-neighbours of vertices whose neighbour count lies in (more_than, at_most].

    Vertices are counted before anything is gathered, so a list holds at most ``at_most`` ids.
    """
    links = edges.select("src", "dst")
    if distinct:
        links = links.distinct()
    sizes = (
        links.groupBy("dst")
        .agg(F.count(F.lit(1)).alias("neighbours"))
        .where((F.col("neighbours") > more_than) & (F.col("neighbours") <= at_most))
    )
    return (
        per_key_join(links, sizes, ["dst"])
        .groupBy(F.col("dst").alias("id"), "neighbours")
        .agg(F.sort_array(F.collect_list("src")).alias("ids"))
    )


def partition_edges(edges: DataFrame, strategy: str, partitions: int) -> DataFrame:
    """Lay edges out by a vertex-cut strategy.

    ``1d`` keeps the edges of a source together, ``random`` those of an ordered pair,
    ``canonical`` those of an unordered pair, ``2d`` bounds the partitions a vertex is seen in
    by twice the square root of their number.
    """
    src, dst = F.col("src"), F.col("dst")
    if strategy == "1d":
        return edges.repartition(partitions, src)
    if strategy == "random":
        return edges.repartition(partitions, src, dst)
    if strategy == "canonical":
        return edges.repartition(partitions, F.least(src, dst), F.greatest(src, dst))
    if strategy == "2d":
        side = math.ceil(math.sqrt(partitions))
        row = F.pmod(F.xxhash64(src), F.lit(side))
        column = F.pmod(F.xxhash64(dst), F.lit(side))
        return edges.repartition(partitions, row, column)
    raise ValueError(f"unknown edge partitioning strategy: {strategy}")
