"""Groups of users around one shared property value, and their risk rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import epoch_millis, property_digest
from tallygraph.operators.skew import per_key_join
from tallygraph.storage import materialize


def node_sizes(source: DataFrame, at_least: int, below: int) -> DataFrame:
    """Property nodes with a number of distinct users in [at_least, below)."""
    sizes = source.groupBy("node_id").agg(F.count_distinct("user_id").alias("match_count"))
    return sizes.where((F.col("match_count") >= at_least) & (F.col("match_count") < below))


def all_relation(
    source: DataFrame, create_date: str, at_least: int = 2, below: int = 5000
) -> DataFrame:
    """Every source row of a shared value, with readable time."""
    added = F.timestamp_millis(epoch_millis(F.col("addtime")))
    return per_key_join(source, node_sizes(source, at_least, below), ["node_id"]).select(
        F.col("rel").alias("match_type"),
        F.col("sub_rel").alias("match_subtype"),
        F.col("val").alias("match_value"),
        F.col("user_id").cast("string").alias("match_user"),
        F.date_format(added, "yyyy-MM-dd HH:mm:ss").alias("add_time"),
        F.lit(create_date).alias("create_time"),
    )


def _one(name: str) -> Column:
    return F.coalesce(F.col(name).cast("int") == 1, F.lit(False))


def risk_level(counters: DataFrame) -> Column:
    """Numbers of the rules that hold, joined by ``|``, or ``0``.

    1: S >= 10 and SD/S >= 0.2;  2: N < 10 and NR/N >= 0.5;
    3: B/match_count >= 0.3;     4: T/match_count >= 0.8.
    Ratios are compared by whole numbers, so no ratio is rounded and none divides by zero.
    """
    c = {name: F.col(name) for name in counters.columns}
    rules = [
        (c["success"] >= 10) & (5 * c["success_overdue"] >= c["success"]),
        (c["ordered"] < 10) & (c["ordered"] > 0) & (2 * c["ordered_risk"] >= c["ordered"]),
        10 * c["blacklisted"] >= 3 * c["match_count"],
        5 * c["multi_loan"] >= 4 * c["match_count"],
    ]
    fired = F.concat_ws("|", *[F.when(rule, str(i)) for i, rule in enumerate(rules, start=1)])
    return F.when(fired == "", "0").otherwise(fired)


def group_relation(
    source: DataFrame,
    classify: DataFrame,
    create_date: str,
    at_least: int = 20,
    below: int = 5000,
) -> DataFrame:
    """One row per shared value: its users, the risk rules they meet and a digest as group id.

    ``match_count`` counts all users of a value, the counters only classified ones. A user list
    is shorter than ``below``.
    """
    # The source is read once; sizes, users and names come from its distinct memberships.
    members = materialize(source.select("node_id", "rel", "val", "user_id").distinct(), "members")
    users = members.select("node_id", "user_id").distinct()
    sized = per_key_join(users, node_sizes(members, at_least, below), ["node_id"])
    named = sized.join(members.select("node_id", "val", "rel").distinct(), "node_id")
    profile = classify.select(
        "user_id",
        _one("if_last_order_success").alias("_success"),
        _one("is_overdue").alias("_overdue"),
        F.col("last_order_nid").isNotNull().alias("_ordered"),
        _one("is_high_risk_reject").alias("_risk"),
        _one("is_blacklist").alias("_black"),
        _one("is_duotou").alias("_multi"),
    )
    counters = (
        named.join(profile, "user_id")
        .groupBy("rel", "match_count", "val")
        .agg(
            F.count_if("_success").alias("success"),
            F.count_if(F.col("_success") & F.col("_overdue")).alias("success_overdue"),
            F.count_if("_ordered").alias("ordered"),
            F.count_if(F.col("_ordered") & F.col("_risk")).alias("ordered_risk"),
            F.count_if("_black").alias("blacklisted"),
            F.count_if("_multi").alias("multi_loan"),
            F.array_sort(F.collect_list("user_id")).alias("_users"),
        )
    )
    level = F.col("group_level")
    trace = F.when(level != "0", F.concat(F.lit("{"), level, F.lit(f",{create_date}}}")))
    return counters.withColumn("group_level", risk_level(counters)).select(
        property_digest(F.col("rel"), F.col("val")).alias("group_id"),
        F.col("rel").alias("match_type"),
        F.col("val").alias("match_value"),
        F.col("match_count").cast("string").alias("match_count"),
        F.array_join(F.col("_users").cast("array<string>"), ",").alias("match_user"),
        "group_level",
        trace.alias("group_trace"),
        F.lit(create_date).alias("create_time"),
        F.lit(create_date).alias("update_time"),
    )


def user_group(groups: DataFrame, create_date: str) -> DataFrame:
    """One row per user and group of theirs, with how many groups they are in and how many of
    those are at risk."""
    membership = groups.select(
        F.explode(F.split("match_user", ",")).alias("user_id"), "group_id", "group_level"
    )
    counts = membership.groupBy("user_id").agg(
        F.count_if(F.col("group_level") != "0").alias("bad_group_cnt"),
        F.count(F.lit(1)).alias("group_cnt"),
    )
    return per_key_join(membership, counts, ["user_id"]).select(
        "user_id",
        F.col("group_id").alias("match_group_id"),
        "bad_group_cnt",
        "group_cnt",
        F.lit(create_date).alias("create_time"),
    )
