"""Triangle counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.graph.model import both_directions, canonical_edges, vertices_of
from tallygraph.storage import materialize

EDGES_PER_CELL = 1_000_000


def triangle_count(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Triangles through each vertex; directions, repeated edges and self-loops are ignored.

    Edges are pointed from the end of lower degree to the end of higher degree. A vertex then has
    at most sqrt(2 * edges) successors however large its degree is, which bounds every list that
    is gathered, and each triangle is found once, as a common successor of both ends of an edge.
    """
    ids = vertices_of(edges) if vertices is None else vertices.select("id")
    simple = materialize(canonical_edges(edges.where("src != dst")).distinct(), "simple-edges")
    degree = both_directions(simple).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    # Per-vertex tables are written before they are joined to edges, so that adaptive execution
    # can split the joins at hubs (see operators.skew.per_key_join).
    degree = materialize(degree, "degrees")

    def of(end: str) -> DataFrame:
        return degree.select(F.col("id").alias(end), F.struct("degree", "id").alias(f"{end}_rank"))

    ranked = simple.join(of("src"), "src").join(of("dst"), "dst")
    upward = F.col("src_rank") < F.col("dst_rank")
    pointed = materialize(
        ranked.select(
            F.when(upward, F.col("src")).otherwise(F.col("dst")).alias("low"),
            F.when(upward, F.col("dst")).otherwise(F.col("src")).alias("high"),
        ),
        "pointed-edges",
    )
    successors = pointed.groupBy("low").agg(F.collect_list("high").alias("next"))
    successors = materialize(successors, "successors")
    counts = _corners(pointed, successors)
    return ids.join(counts, "id", "left").fillna({"triangles": 0})


def _corners(pointed: DataFrame, successors: DataFrame) -> DataFrame:
    """``(id, triangles)`` of the vertices with triangles, by pointed edges and lists of successors.

    Edges are dealt to cells by their lower end. The list of a higher end is sent once to each cell
    that has edges to it, not along every edge, and a cell holds the lists of its own lower ends,
    so lists are compared where they are.
    """
    spark = pointed.sparkSession
    cells = max(-(-pointed.count() // EDGES_PER_CELL), spark.sparkContext.defaultParallelism)
    celled = pointed.withColumn("cell", F.pmod(F.xxhash64("low"), F.lit(cells)))
    sent = celled.select("cell", "high").distinct().join(
        successors.select(F.col("low").alias("high"), F.col("next").alias("next_high")), "high"
    )
    sent = materialize(sent, "sent-successors")
    own = successors.withColumn("cell", F.pmod(F.xxhash64("low"), F.lit(cells)))
    tasks = 4 * cells  # so that hashing seldom puts several cells into one task
    # Both joins are on the cell and a vertex; rows that lie together by cell meet both.
    by_part_of_keys = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(by_part_of_keys, None)
    spark.conf.set(by_part_of_keys, "false")
    try:
        common = (
            celled.repartition(tasks, "cell")
            .join(sent.repartition(tasks, "cell"), ["cell", "high"])
            .join(own.repartition(tasks, "cell"), ["cell", "low"])
            .select("low", "high", F.array_intersect("next", "next_high").alias("third"))
            .where(F.size("third") > 0)
        )
        shared = F.size("third").cast("bigint").alias("n")
        ends = F.array(F.struct(F.col("low").alias("id"), shared), F.struct(F.col("high").alias("id"), shared))
        one = F.lit(1).cast("bigint").alias("n")
        thirds = F.transform("third", lambda vertex: F.struct(vertex.alias("id"), one))
        corners = common.select(F.inline(F.concat(ends, thirds)))
        return materialize(corners.groupBy("id").agg(F.sum("n").alias("triangles")), "triangles")
    finally:
        spark.conf.unset(by_part_of_keys) if before is None else spark.conf.set(by_part_of_keys, before)


def triangle_total(counts: DataFrame) -> DataFrame:
    """Number of triangles of the graph: each is counted at its three corners."""
    return counts.agg(F.expr("coalesce(sum(triangles), 0) div 3").alias("triangles"))
