"""PageRank: link-pair form, fixed rounds over all vertices, and to a tolerance."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.graph.model import vertices_of
from tallygraph.graph.slots import EDGES_PER_SLOT, SlottedEdges, slotted
from tallygraph.operators.skew import per_key_join
from tallygraph.storage import checkpoint, materialize

RESET = 0.15
DAMPING = 0.85


def _weighted(edges: DataFrame, edges_per_slot: int) -> SlottedEdges:
    """Edges with the share of its rank that the source sends along each of them."""
    edges = materialize(edges.select("src", "dst"), "edges")
    out = edges.groupBy("src").agg((F.lit(1.0) / F.count(F.lit(1))).alias("share"))
    weighted = materialize(per_key_join(edges, out, ["src"]), "weighted-edges")
    return slotted(weighted, "src", edges_per_slot)


def _round(ranks: DataFrame, weighted: SlottedEdges, base: DataFrame | None) -> DataFrame:
    """One round. ``base`` rows (id, part) keep vertices alive that nobody links to.

    The exchange of edges is the same in every round of one plan and is run once. Ranks leave the
    sum partitioned by id, so without hubs a round moves nothing but the summed parts.
    """
    parts = weighted.join(ranks).select(
        F.col("dst").alias("id"), (F.col("rank") * F.col("share")).alias("part")
    )
    if base is not None:
        parts = parts.unionByName(base)
    return parts.groupBy("id").agg((F.lit(RESET) + DAMPING * F.sum("part")).alias("rank"))


def pagerank_links(
    links: DataFrame,
    rounds: int = 10,
    rounds_per_plan: int = 5,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """Ranks from distinct links, starting at 1. Pages nobody links to drop out after one round."""
    weighted = _weighted(links.select("src", "dst").distinct(), edges_per_slot)
    ranks = weighted.edges.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for i in range(1, rounds + 1):
        ranks = _round(ranks, weighted, None)
        if i % rounds_per_plan == 0 and i < rounds:
            ranks = checkpoint(ranks)
    return ranks


def _start(
    edges: DataFrame, vertices: DataFrame | None, edges_per_slot: int
) -> tuple[SlottedEdges, DataFrame, DataFrame]:
    weighted = _weighted(edges, edges_per_slot)
    ids = vertices_of(weighted.edges) if vertices is None else vertices.select("id")
    ids = checkpoint(ids)
    return weighted, ids, ids.withColumn("part", F.lit(0.0))


def _scaled(ranks: DataFrame) -> DataFrame:
    """Ranks scaled to sum to the number of vertices."""
    total = ranks.agg(F.sum("rank").alias("sum"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return ranks
    return ranks.withColumn("rank", F.col("rank") * F.lit(total["n"] / total["sum"]))


def pagerank_static(
    edges: DataFrame,
    rounds: int = 10,
    vertices: DataFrame | None = None,
    rounds_per_plan: int = 5,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """Ranks of all vertices after a fixed number of rounds, scaled to sum to their number."""
    weighted, ids, base = _start(edges, vertices, edges_per_slot)
    ranks = ids.withColumn("rank", F.lit(1.0))
    for i in range(1, rounds + 1):
        ranks = _round(ranks, weighted, base)
        if i % rounds_per_plan == 0 or i == rounds:
            ranks = checkpoint(ranks)
    return _scaled(ranks)


def pagerank_until(
    edges: DataFrame,
    tolerance: float,
    vertices: DataFrame | None = None,
    rounds_per_plan: int = 5,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """Ranks once no rank moves by more than the tolerance.

    A round shrinks the sum of the moves by the damping factor, so this ends for any tolerance
    above rounding errors; below them, where moves no longer shrink, an error is raised. The largest move is looked at every ``rounds_per_plan`` rounds.
    """
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")
    weighted, ids, base = _start(edges, vertices, edges_per_slot)
    ranks = ids.withColumn("rank", F.lit(1.0))
    last = math.inf
    while True:
        for _ in range(rounds_per_plan - 1):
            ranks = _round(ranks, weighted, base)
        before = checkpoint(ranks)
        ranks = checkpoint(_round(before, weighted, base))
        distance = F.abs(F.col("rank") - F.col("old"))
        move = (
            ranks.join(before.withColumnRenamed("rank", "old"), "id")
            .agg(F.max(distance).alias("largest"), F.sum(distance).alias("total"))
            .first()
        )
        if move["largest"] is None or move["largest"] <= tolerance:
            return _scaled(ranks)
        if move["total"] >= last:
            raise ValueError("the tolerance is below the rounding of the ranks")
        last = move["total"]
