"""Messages along edges: one exchange of messages, and rounds of them until nothing changes."""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.graph.slots import EDGES_PER_SLOT, bucketed, slotted
from tallygraph.storage import checkpoint, materialize


def triplets(
    vertices: DataFrame, edges: DataFrame, src: bool = True, dst: bool = True
) -> DataFrame:
    """Edges with the attributes of their ends, named ``src_<attr>`` and ``dst_<attr>``."""
    joined = edges
    for side, wanted in (("src", src), ("dst", dst)):
        if wanted:
            names = [F.col("id").alias(side)] + [
                F.col(c).alias(f"{side}_{c}") for c in vertices.columns if c != "id"
            ]
            joined = joined.join(vertices.select(*names), side)
    return joined


def aggregate_messages(
    vertices: DataFrame,
    edges: DataFrame,
    send_when: Column,
    merge: Mapping[str, Column],
    to: str = "dst",
    src: bool = True,
    dst: bool = True,
) -> DataFrame:
    """Aggregate, per receiving vertex, expressions over the triplets that send a message.

    The vertices are written first: an aggregate by id right below the join would keep the edges
    of a hub in one task.
    """
    sent = triplets(materialize(vertices, "vertices"), edges, src, dst).where(send_when)
    return sent.groupBy(F.col(to).alias("id")).agg(*[e.alias(n) for n, e in merge.items()])


def pregel(
    vertices: DataFrame,
    edges: DataFrame,
    send: Mapping[str, Column],
    merge: Mapping[str, Column],
    update: Mapping[str, Column],
    changed: Column,
    send_when: Column | None = None,
    use_dst: bool = False,
    max_rounds: int | None = None,
    edges_per_slot: int = EDGES_PER_SLOT,
) -> DataFrame:
    """Rounds of send, merge and update until no vertex is active; returns the vertices.

    With ``max_rounds`` an error is raised when that many rounds do not suffice.

    ``vertices`` carry their initial state and all of them are active in the first round.
    ``send`` builds message columns from edge columns and ``src_*`` (with ``use_dst`` also
    ``dst_*``) state; only active sources send. ``merge`` aggregates message columns per receiver.
    ``update`` and ``changed`` see the old state and the merged messages, null for a vertex that
    got none. A vertex is active in the next round when ``changed`` holds.

    The edges are bucketed by source once, so that a round moves the active vertices to them and
    not the other way round; the edges of a source with more than ``edges_per_slot`` are dealt out
    to several buckets. ``edges`` is read three times: pass a materialized frame. The only value that
    reaches the driver is whether an active vertex is left.
    """
    laid = bucketed(slotted(edges, "src", edges_per_slot, present=["src", "dst"]))
    try:
        return _rounds(
            vertices, laid, send, merge, update, changed, send_when, use_dst, max_rounds
        )
    finally:
        laid.drop()


def _rounds(vertices, laid, send, merge, update, changed, send_when, use_dst, max_rounds):
    columns = vertices.columns
    source = [F.col(c).alias("id" if c == "id" else f"src_{c}") for c in columns]
    state = checkpoint(vertices.withColumn("_active", F.lit(True)))
    for done in itertools.count(1):
        sent = laid.join(state.where("_active").select(*source))
        if use_dst:
            sent = triplets(state.select(*columns), sent, src=False, dst=True)
        if send_when is not None:
            sent = sent.where(send_when)
        merged = (
            sent.select(F.col("dst").alias("id"), *[e.alias(n) for n, e in send.items()])
            .groupBy("id")
            .agg(*[e.alias(n) for n, e in merge.items()])
        )
        met = state.drop("_active").join(merged, "id", "left")
        state = checkpoint(
            met.select(
                *[update.get(c, F.col(c)).alias(c) for c in columns],
                F.coalesce(changed, F.lit(False)).alias("_active"),
            )
        )
        if state.where("_active").isEmpty():
            return state.drop("_active")
        if done == max_rounds:
            raise RuntimeError(f"vertices are still active after {max_rounds} rounds")
