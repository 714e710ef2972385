"""Label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.graph.model import both_directions
from tallygraph.graph.slots import EDGES_PER_SLOT, edge_tasks, slotted
from tallygraph.storage import checkpoint, materialize


def label_propagation(
    edges: DataFrame,
    rounds: int = 5,
    rounds_per_plan: int = 5,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """Label of every vertex after synchronous rounds of voting along both edge directions.

    Each parallel edge is a vote. The label with most votes wins, ties go to the smallest label.
    Returns ``(id, label)``.

    Votes are counted per (vertex, label) before the winner is picked, so a hub never brings its
    neighbours into one task. Every vertex here has a neighbour, hence a vote in each round.
    """
    links = materialize(both_directions(edges.select("src", "dst")), "links")
    links = slotted(links, "neighbour", edges_per_slot)
    labels = links.edges.select("id").distinct().withColumn("label", F.col("id"))
    # Nearly every edge is a group of its own in the first rounds, so tasks are counted by edges.
    with edge_tasks(links.edges):
        for i in range(1, rounds + 1):
            votes = links.join(labels).groupBy("id", "label").agg(F.count(F.lit(1)).alias("votes"))
            best = F.max_by("label", F.struct("votes", -F.col("label")))
            labels = votes.groupBy("id").agg(best.alias("label"))
            if i % rounds_per_plan == 0 or i == rounds:
                labels = checkpoint(labels)
    return labels
