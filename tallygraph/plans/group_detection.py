"""Groups of users that share property values, found by label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import GOOD_FLAG
from tallygraph.graph.labels import label_propagation
from tallygraph.operators.lists import grouped_items
from tallygraph.operators.relational import (
    clean_relations,
    co_member_pairs,
    group_rates,
    restrict_to,
    shared_members,
)
from tallygraph.operators.skew import per_key_join
from tallygraph.storage import materialize


def property_members(
    relations: DataFrame,
    classify: DataFrame,
    relation: str,
    more_than: int = 2,
    at_most: int = 100,
    count_rows: bool = False,
) -> DataFrame:
    """``(value, user_id, members)`` of one relation: classified users of values of usable size.

    Distinct users are counted, or relation rows with ``count_rows``. A value is named ``rel::val``.
    """
    known = classify.where(F.col("flag").isNotNull())
    source = restrict_to(clean_relations(relations, relation), known, "user_id")
    named = source.select(
        "node_id", F.concat_ws("::", "rel", "val").alias("value"), "user_id"
    )
    return shared_members(named, ["node_id", "value"], "user_id", more_than, at_most, count_rows)


def user_edges(members: DataFrame) -> DataFrame:
    """User graph as ``(src, dst, value, times)``: a row per pair of users and value they share."""
    pairs = co_member_pairs(members, ["node_id", "value"], "user_id")
    return grouped_items(pairs, ["src", "dst"], "value")


def group_values(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(group_id, value, times)``: how often a group's edges carry a value, counted at both ends.

    A user of a value with n members has n - 1 edges carrying it, so the count follows from the
    memberships and no edge is touched.
    """
    labelled = members.join(
        labels.select(F.col("id").alias("user_id"), F.col("label").alias("group_id")), "user_id"
    )
    carried = labelled.withColumn("_times", F.col("members") - 1)
    return grouped_items(carried, ["group_id"], "value", "_times")


def detect_groups(
    relations: DataFrame,
    classify: DataFrame,
    relation: str,
    more_than: int = 2,
    at_most: int = 100,
    rounds: int = 5,
    count_rows: bool = False,
) -> DataFrame:
    """Good and bad rate, size and shared values of every user group of a relation.

    One row per group and value; ``times`` says how often the edges of the group carry the value.
    """
    members = materialize(
        property_members(relations, classify, relation, more_than, at_most, count_rows), "members"
    )
    pairs = co_member_pairs(members, ["node_id", "value"], "user_id").select("src", "dst")
    labels = label_propagation(pairs.distinct(), rounds)

    flags = classify.where(F.col("flag").isNotNull()).select("user_id", "flag")
    flags = flags.replace(GOOD_FLAG, subset=["flag"])
    grouped = labels.select(F.col("id").alias("user_id"), F.col("label").alias("group_id"))
    rates = group_rates(grouped.join(flags, "user_id"), ["group_id"], "flag")
    return per_key_join(group_values(members, labels), rates, ["group_id"]).select(
        "group_id", "good_rate", "bad_rate", "total", "value", "times", F.lit(relation).alias("rel")
    )


def write_groups(groups: DataFrame, table: str) -> None:
    """Append the groups to a managed table partitioned by relation."""
    groups.write.mode("append").partitionBy("rel").saveAsTable(table)
