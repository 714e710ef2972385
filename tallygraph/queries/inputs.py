"""Inputs the queries derive from the tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.session import table
from tallygraph.storage import materialize


def json_key(props):
    """The number ``k`` of an event's properties."""
    return F.get_json_object(props, "$.k").cast("bigint")


def event_relations(spark: SparkSession, folder: str) -> DataFrame:
    """User - property rows from the events: relation = event type, value = properties."""
    return table(spark, folder, "events").select(
        "user_id",
        F.col("props").alias("val"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("addtime"),
        F.col("event_id").alias("edge_id"),
        (F.ascii("event_type") * 1000 + json_key(F.col("props"))).alias("node_id"),
        F.lit("k").alias("sub_rel"),
        F.col("event_type").alias("rel"),
    )


EVENT_RELATIONS_SQL = """
event_relations AS (
  SELECT user_id, props AS val, CAST(floor(epoch(ts)) AS BIGINT) AS addtime, event_id AS edge_id,
         ascii(event_type) * 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS node_id,
         'k' AS sub_rel, event_type AS rel
  FROM events)"""


def shipment_relations(spark: SparkSession, folder: str) -> DataFrame:
    """Customer - property rows from all line items: value = supplier and day of shipping."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"),
        F.concat_ws("@", F.col("l_suppkey").cast("string"), F.col("day").cast("string")).alias("val"),
        (F.unix_date("day") * F.lit(86400).cast("bigint")).alias("addtime"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"),
        (F.col("l_suppkey") * 100000 + F.unix_date("day")).alias("node_id"),
        F.lit("day").alias("sub_rel"),
        F.lit("shipment").alias("rel"),
    )


SHIPMENT_RELATIONS_SQL = """
shipment_relations AS (
  SELECT o_custkey AS user_id,
         CAST(l_suppkey AS VARCHAR) || '@' || strftime(l_shipdate, '%Y-%m-%d') AS val,
         CAST(epoch(l_shipdate) AS BIGINT) AS addtime,
         l_orderkey * 10 + l_linenumber AS edge_id,
         l_suppkey * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS node_id,
         'day' AS sub_rel, 'shipment' AS rel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def quarter_relations(spark: SparkSession, folder: str) -> DataFrame:
    """Customer - property rows from all line items: value = supplier and quarter of shipping.

    A value has about as many users at every scale, so limits on its size keep their meaning.
    Times are in milliseconds.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    year, quarter = F.year("day"), F.quarter("day")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"),
        F.concat(F.col("l_suppkey"), F.lit("@"), year, F.lit("Q"), quarter).alias("val"),
        (F.unix_date("day") * F.lit(86_400_000).cast("bigint")).alias("addtime"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"),
        (F.col("l_suppkey") * 1000 + (year - 1990) * 4 + quarter).alias("node_id"),
        F.lit("quarter").alias("sub_rel"),
        F.lit("shipment").alias("rel"),
    )


QUARTER_RELATIONS_SQL = """
quarter_relations AS (
  SELECT o_custkey AS user_id,
         l_suppkey || '@' || year(l_shipdate) || 'Q' || quarter(l_shipdate) AS val,
         CAST(epoch_ms(l_shipdate) AS BIGINT) AS addtime,
         l_orderkey * 10 + l_linenumber AS edge_id,
         l_suppkey * 1000 + (year(l_shipdate) - 1990) * 4 + quarter(l_shipdate) AS node_id,
         'quarter' AS sub_rel, 'shipment' AS rel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def user_classify(spark: SparkSession, folder: str) -> DataFrame:
    """Classification flags of every customer, written as the stored table such flags would be."""
    last = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.max("o_orderkey").alias("last_order_nid"),
            F.max_by("o_orderstatus", "o_orderkey").alias("_status"),
        )
    )
    customer = table(spark, folder, "customer")
    flags = customer.join(last, customer["c_custkey"] == last["o_custkey"], "left").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") % 3 + 1).cast("int").alias("flag"),
        "last_order_nid",
        (F.col("_status") == "F").cast("int").alias("if_last_order_success"),
        (F.col("c_mktsegment") != "BUILDING").cast("int").alias("is_duotou"),
        (F.col("c_custkey") % 4 == 0).cast("int").alias("is_high_risk_reject"),
        (F.col("c_nationkey") < 5).cast("int").alias("is_blacklist"),
        (F.col("c_acctbal") < 0).cast("int").alias("is_overdue"),
    )
    return materialize(flags, "user-classify")


USER_CLASSIFY_SQL = """
user_classify AS (
  SELECT c_custkey AS user_id, CAST(c_custkey % 3 + 1 AS INTEGER) AS flag, last_order_nid,
         CAST(status = 'F' AS INTEGER) AS if_last_order_success,
         CAST(c_mktsegment <> 'BUILDING' AS INTEGER) AS is_duotou,
         CAST(c_custkey % 4 = 0 AS INTEGER) AS is_high_risk_reject,
         CAST(c_nationkey < 5 AS INTEGER) AS is_blacklist,
         CAST(c_acctbal < 0 AS INTEGER) AS is_overdue
  FROM customer LEFT JOIN (
    SELECT o_custkey, max(o_orderkey) AS last_order_nid, arg_max(o_orderstatus, o_orderkey) AS status
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""


def trade_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Directed graph of all line items, supplier number -> part number in one id space."""
    return (
        table(spark, folder, "lineitem")
        .where("l_suppkey != l_partkey")
        .select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
        .distinct()
    )


TRADE_EDGES_SQL = """
edges AS MATERIALIZED (
  SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem WHERE l_suppkey <> l_partkey),
ids AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"""
