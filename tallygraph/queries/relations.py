"""Shared-property groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygraph.graph.components import component_count as count_components
from tallygraph.graph.components import connected_components as find_components
from tallygraph.graph.model import in_neighbours
from tallygraph.operators.relational import clean_relations_since, co_member_pairs
from tallygraph.plans import group_detection as groups
from tallygraph.plans import single_property
from tallygraph.queries.inputs import (
    QUARTER_RELATIONS_SQL,
    SHIPMENT_RELATIONS_SQL,
    USER_CLASSIFY_SQL,
    quarter_relations,
    shipment_relations,
    user_classify,
)
from tallygraph.operators.skew import per_key_join
from tallygraph.queries.registry import query
from tallygraph.storage import materialize

AS_OF = "2024-02-01"

MEMBERS_SQL = f"""
{SHIPMENT_RELATIONS_SQL}, {USER_CLASSIFY_SQL},
source AS (SELECT DISTINCT node_id, rel || '::' || val AS value, user_id FROM shipment_relations
           WHERE user_id IN (SELECT user_id FROM user_classify WHERE flag IS NOT NULL)),
members AS MATERIALIZED (
  SELECT * FROM source JOIN (SELECT node_id, count(*) AS members FROM source GROUP BY node_id
                             HAVING count(*) > 2 AND count(*) <= 100) USING (node_id)),
pairs AS MATERIALIZED (
  SELECT a.value, a.user_id AS src, b.user_id AS dst FROM members a JOIN members b
  ON a.node_id = b.node_id AND a.user_id < b.user_id)"""


def label_rounds_sql(links: str, rounds: int) -> str:
    """Chained CTEs ``label0 .. labelN`` of synchronous label propagation over ``links``."""
    steps = [f"label0 AS MATERIALIZED (SELECT DISTINCT id, id AS label FROM {links})"]
    for i in range(1, rounds + 1):
        steps.append(
            f"label{i} AS MATERIALIZED (SELECT id, label FROM (SELECT k.id, l.label, row_number() OVER "
            f"(PARTITION BY k.id ORDER BY count(*) DESC, l.label) AS place FROM {links} k "
            f"JOIN label{i - 1} l ON k.neighbour = l.id GROUP BY k.id, l.label) WHERE place = 1)"
        )
    return ",\n".join(steps)


def _members(spark, folder):
    return groups.property_members(shipment_relations(spark, folder), user_classify(spark, folder), "shipment")


@query(
    f"WITH {MEMBERS_SQL} SELECT src, dst, value, count(*) AS times FROM pairs GROUP BY src, dst, value"
)
def shared_property_pairs(spark, folder):
    return groups.user_edges(_members(spark, folder))


@query(
    f"""
    WITH {QUARTER_RELATIONS_SQL},
    links AS (SELECT DISTINCT user_id, node_id FROM quarter_relations)
    SELECT node_id AS id, count(*) AS neighbours, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS ids
    FROM links GROUP BY node_id HAVING count(*) > 20 AND count(*) <= 100
    """
)
def in_neighbors_filtered(spark, folder):
    edges = quarter_relations(spark, folder).select(F.col("user_id").alias("src"), F.col("node_id").alias("dst"))
    found = in_neighbours(edges, more_than=20, at_most=100)
    return found.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


GROUP_DETECTION_SQL = f"""
WITH {MEMBERS_SQL},
user_edges AS MATERIALIZED (SELECT DISTINCT src, dst FROM pairs),
links AS MATERIALIZED (SELECT src AS id, dst AS neighbour FROM user_edges UNION ALL SELECT dst, src FROM user_edges),
{label_rounds_sql('links', 5)},
carried AS (
  SELECT l.label AS group_id, value FROM pairs JOIN label5 l ON l.id = pairs.src
  UNION ALL SELECT l.label, value FROM pairs JOIN label5 l ON l.id = pairs.dst),
group_values AS (SELECT group_id, value, count(*) AS times FROM carried GROUP BY group_id, value),
sums AS (
  SELECT label AS group_id, sum(CASE WHEN flag = 3 THEN 1 ELSE 0 END) AS good, count(flag) AS total
  FROM label5 JOIN user_classify ON id = user_id WHERE flag IS NOT NULL GROUP BY label)
SELECT group_id, floor((good * 200 + total) / (total * 2)) / 100 AS good_rate,
       floor(((total - good) * 200 + total) / (total * 2)) / 100 AS bad_rate,
       total, value, times, 'shipment' AS rel
FROM sums JOIN group_values USING (group_id)"""


@query(GROUP_DETECTION_SQL)
def group_detection(spark, folder):
    return groups.detect_groups(shipment_relations(spark, folder), user_classify(spark, folder), "shipment")


SOURCE_SQL = f"""
{QUARTER_RELATIONS_SQL}, {USER_CLASSIFY_SQL},
source AS MATERIALIZED (
  SELECT * FROM quarter_relations WHERE rel NOT IN ('ip', 'lbs') AND addtime >= epoch_ms(TIMESTAMP '1996-01-01 00:00:00')),
sizes AS MATERIALIZED (
  SELECT node_id, count(DISTINCT user_id) AS match_count FROM source GROUP BY node_id
  HAVING count(DISTINCT user_id) >= 20 AND count(DISTINCT user_id) < 5000)"""

GROUP_RELATION_SQL = f"""
{SOURCE_SQL},
counters AS (
  SELECT rel, match_count, val,
         count(*) FILTER (WHERE if_last_order_success = 1) AS s,
         count(*) FILTER (WHERE if_last_order_success = 1 AND is_overdue = 1) AS sd,
         count(last_order_nid) AS n,
         count(*) FILTER (WHERE last_order_nid IS NOT NULL AND is_high_risk_reject = 1) AS nr,
         count(*) FILTER (WHERE is_blacklist = 1) AS b,
         count(*) FILTER (WHERE is_duotou = 1) AS t,
         string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS match_user
  FROM (SELECT DISTINCT node_id, user_id FROM source) JOIN sizes USING (node_id)
  JOIN (SELECT DISTINCT node_id, val, rel FROM source) USING (node_id)
  JOIN user_classify USING (user_id) GROUP BY rel, match_count, val),
leveled AS (
  SELECT *, concat_ws('|', CASE WHEN s >= 10 AND sd / s >= 0.2 THEN '1' END,
                           CASE WHEN n < 10 AND n > 0 AND nr / n >= 0.5 THEN '2' END,
                           CASE WHEN b / match_count >= 0.3 THEN '3' END,
                           CASE WHEN t / match_count >= 0.8 THEN '4' END) AS fired FROM counters),
group_relation AS MATERIALIZED (
  SELECT md5(rel || val) AS group_id, rel AS match_type, val AS match_value,
         CAST(match_count AS VARCHAR) AS match_count, match_user,
         CASE WHEN fired = '' THEN '0' ELSE fired END AS group_level,
         CASE WHEN fired <> '' THEN '{{' || fired || ',{AS_OF}}}' END AS group_trace,
         '{AS_OF}' AS create_time, '{AS_OF}' AS update_time FROM leveled)"""


def _source(spark, folder):
    return clean_relations_since(quarter_relations(spark, folder), "1996-01-01")


@query(
    f"""
    WITH {SOURCE_SQL}
    SELECT rel AS match_type, sub_rel AS match_subtype, val AS match_value,
           CAST(user_id AS VARCHAR) AS match_user,
           strftime(to_timestamp(addtime / 1000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS add_time,
           '{AS_OF}' AS create_time
    FROM source JOIN sizes USING (node_id)
    """
)
def all_relation(spark, folder):
    return single_property.all_relation(_source(spark, folder), AS_OF, at_least=20)


@query(f"WITH {GROUP_RELATION_SQL} SELECT * FROM group_relation")
def group_relation(spark, folder):
    return single_property.group_relation(_source(spark, folder), user_classify(spark, folder), AS_OF)


@query(
    f"""
    WITH {GROUP_RELATION_SQL},
    members AS (SELECT unnest(string_split(match_user, ',')) AS user_id, group_id, group_level FROM group_relation)
    SELECT user_id, group_id AS match_group_id,
           count(*) FILTER (WHERE group_level <> '0') OVER own AS bad_group_cnt, count(*) OVER own AS group_cnt,
           '{AS_OF}' AS create_time
    FROM members WINDOW own AS (PARTITION BY user_id)
    """
)
def user_group(spark, folder):
    found = single_property.group_relation(
        _source(spark, folder), user_classify(spark, folder), AS_OF
    )
    return single_property.user_group(materialize(found, "group-relation"), AS_OF)


COMPONENTS_SQL = f"""
WITH RECURSIVE {MEMBERS_SQL},
links AS MATERIALIZED (SELECT src AS id, dst AS neighbour FROM pairs UNION SELECT dst, src FROM pairs),
reach(id, label) AS (
  SELECT id, id FROM links UNION SELECT k.neighbour, r.label FROM reach r JOIN links k ON k.id = r.id
  WHERE r.label < k.neighbour),
labels AS (SELECT id, min(label) AS component FROM reach GROUP BY id)"""


def _components(spark, folder):
    """Linking every member to the smallest of its value gives the components of all pairs."""
    members = _members(spark, folder)
    least = members.groupBy("node_id", "value").agg(F.min("user_id").alias("dst"))
    stars = per_key_join(members, least, ["node_id", "value"]).where("user_id != dst")
    return find_components(stars.select(F.col("user_id").alias("src"), "dst"))


@query(f"{COMPONENTS_SQL} SELECT id, component FROM labels")
def connected_components(spark, folder):
    return _components(spark, folder)


@query(f"{COMPONENTS_SQL} SELECT count(DISTINCT component) AS components FROM labels")
def component_count(spark, folder):
    return count_components(_components(spark, folder))
