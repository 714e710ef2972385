"""Filters, joins and key statistics shared by the larger jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import epoch_date
from tallygraph.operators.skew import per_key_join
from tallygraph.storage import materialize

RELATION_COLUMNS = ["user_id", "val", "addtime", "edge_id", "node_id", "sub_rel", "rel"]


def clean_relations(relations: DataFrame, relation: str | None = None) -> DataFrame:
    """Relation rows without missing or placeholder values, of one relation if given."""
    keep = ~F.col("val").isin("", "NULL")
    for name in ("val", "user_id", "addtime", "edge_id", "node_id"):
        keep = keep & F.col(name).isNotNull()
    if relation is not None:
        keep = keep & (F.col("rel") == relation)
    return relations.where(keep).select(*RELATION_COLUMNS)


def clean_relations_since(
    relations: DataFrame,
    since: str = "2017-01-01",
    excluded: Sequence[str] = ("ip", "lbs"),
) -> DataFrame:
    """Clean rows of all but the excluded relations, added on or after a date."""
    return clean_relations(relations).where(
        ~F.col("rel").isin(*excluded) & (epoch_date(F.col("addtime")) >= F.lit(since).cast("date"))
    )


def restrict_to(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed. A key listed twice does not repeat rows."""
    return df.join(keys.select(key), key, "left_semi")


def right_join_lookup(rows: DataFrame, lookup: DataFrame, condition: Column) -> DataFrame:
    """``rows RIGHT JOIN lookup``. Adaptive execution broadcasts ``rows``, the side that is not
    preserved, once it has measured them to be below the broadcast threshold."""
    return rows.join(lookup, condition, "right")


def left_join_default(
    df: DataFrame, other: DataFrame, key: str | list[str], defaults: dict
) -> DataFrame:
    """Left outer join in which missing attributes take a default value."""
    return df.join(other, key, "left").fillna(defaults)


def key_distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc(key))


def top_values(df: DataFrame, keys: list[str], member: str, n: int) -> DataFrame:
    """The n keys with most distinct members."""
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(member).alias("members"))
        .orderBy(F.desc("members"), *keys)
        .limit(n)
    )


def group_rates(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Good and bad share of 0/1 flags per group, rounded half up to two decimals.

    The share is rounded in integer arithmetic: floor(100 * good / total + 1/2) / 100.
    """
    good, total = F.col("good"), F.col("total")
    return (
        df.groupBy(*keys)
        .agg(F.sum(flag).alias("good"), F.count(flag).alias("total"))
        .select(
            *keys,
            _percent(good, total).alias("good_rate"),
            _percent(total - good, total).alias("bad_rate"),
            "total",
        )
    )


def _percent(part: Column, whole: Column) -> Column:
    hundredths = F.when(whole > 0, F.floor((part * 200 + whole) / (whole * 2)))
    return hundredths.cast("double") / 100


def shared_members(
    source: DataFrame,
    value_keys: list[str],
    member: str,
    more_than: int,
    at_most: int,
    count_rows: bool = False,
) -> DataFrame:
    """Distinct ``(value, member, members)`` rows of values whose size lies in a range.

    The size of a value is its number of distinct members, or of source rows with ``count_rows``;
    ``members`` is the distinct number in either case. Values are counted first, so a value outside
    the range never has its members gathered, whatever share of the rows it holds.
    """
    # Written once: the sizes and the join below would otherwise both run the source.
    members = materialize(
        source.groupBy(*value_keys, member).agg(F.count(F.lit(1)).alias("_rows")), "members"
    )
    size = F.sum("_rows") if count_rows else F.count(F.lit(1))
    sizes = (
        members.groupBy(*value_keys)
        .agg(F.count(F.lit(1)).alias("members"), size.alias("_size"))
        .where((F.col("_size") > more_than) & (F.col("_size") <= at_most))
        .drop("_size")
    )
    return per_key_join(members.drop("_rows"), sizes, value_keys)


def co_member_pairs(members: DataFrame, value_keys: list[str], member: str) -> DataFrame:
    """Unordered pairs ``(value, src, dst)`` with ``src < dst`` of members that share a value.

    Takes the output of :func:`shared_members`: the largest group is the ``at_most`` given there,
    so every input row yields at most ``at_most - 1`` pairs.
    """
    groups = members.groupBy(*value_keys).agg(F.sort_array(F.collect_list(member)).alias("_all"))
    first = groups.select(*value_keys, "_all", F.posexplode("_all").alias("_pos", "src"))
    rest = F.slice(F.col("_all"), F.col("_pos") + 2, F.size("_all"))
    return first.select(*value_keys, "src", F.explode(rest).alias("dst"))
