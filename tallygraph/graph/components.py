"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.graph.model import both_directions, vertices_of
from tallygraph.operators.skew import per_key_join
from tallygraph.storage import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each vertex to the smallest id around it."""
    around = both_directions(edges)
    least = around.groupBy("id").agg(F.least(F.min("neighbour"), F.col("id")).alias("least"))
    return (
        per_key_join(around.where("neighbour > id"), least, ["id"])
        .select(F.col("neighbour").alias("src"), F.col("least").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each vertex and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("id"), F.least("src", "dst").alias("below"))
    least = down.groupBy("id").agg(F.min("below").alias("least"))
    least = checkpoint(least)
    moved = down.join(least, "id").select(F.col("below").alias("src"), F.col("least").alias("dst"))
    kept = least.select(F.col("id").alias("src"), F.col("least").alias("dst"))
    return moved.where("src != dst").unionByName(kept).distinct()


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Lowest vertex id of the component of each vertex, directions ignored: ``(id, component)``.

    Runs until a round changes nothing. The number of rounds grows with the logarithm of the
    number of vertices, not with the length of the longest path.
    """
    ids = vertices_of(edges) if vertices is None else vertices.select("id")
    stars = checkpoint(edges.select("src", "dst").where("src != dst").distinct())
    seen = None
    while True:
        # Rows, sum of ids and sum of hashes of the edge set: equal twice in a row means stable.
        mark = stars.agg(
            F.count(F.lit(1)),
            F.sum(F.col("dst").cast("decimal(38,0)")),
            F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")),
        ).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        stars = checkpoint(_small_star(checkpoint(_large_star(stars))))
    component = F.coalesce(F.col("dst"), F.col("id")).alias("component")
    labelled = ids.join(stars.withColumnRenamed("src", "id"), "id", "left")
    return labelled.select("id", component)


def component_count(labels: DataFrame) -> DataFrame:
    """Number of components."""
    return labels.agg(F.count_distinct("component").alias("components"))
