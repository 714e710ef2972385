"""Selections, joins, groupings, ordering and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallygraph.functions import aggregates, scalar
from tallygraph.operators import relational as ops
from tallygraph.operators.lists import grouped_items
from tallygraph.operators.skew import salted_aggregate, salted_join
from tallygraph.queries.inputs import EVENT_RELATIONS_SQL, USER_CLASSIFY_SQL, event_relations, user_classify
from tallygraph.queries.registry import query
from tallygraph.session import table


@query("SELECT c_custkey, c_name AS name, c_nationkey + 1 AS next_nation, c_acctbal * 2 AS twice FROM customer")
def select_arith(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 1).alias("next_nation"),
        (F.col("c_acctbal") * 2).alias("twice"),
    )


@query("SELECT * FROM part WHERE p_type = 'ECONOMY' OR p_type = 'SMALL'")
def filter_or(spark, folder):
    kind = F.col("p_type")
    return table(spark, folder, "part").where((kind == "ECONOMY") | (kind == "SMALL"))


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def between_filter(spark, folder):
    return table(spark, folder, "part").where(F.col("p_size").between(13, 19)).select(
        "p_partkey", "p_name", "p_size"
    )


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 "
    "ORDER BY o_totalprice, o_orderkey"
)
def order_filter(spark, folder):
    return (
        table(spark, folder, "orders")
        .where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
        .select("o_orderkey", "o_totalprice")
        .orderBy("o_totalprice", "o_orderkey")
    )


@query("SELECT 'Key: ' || c_custkey || ', Value: ' || c_name AS line FROM customer")
def row_format(spark, folder):
    return table(spark, folder, "customer").select(
        F.format_string("Key: %s, Value: %s", "c_custkey", "c_name").alias("line")
    )


@query(
    """
    SELECT c_custkey, CASE flag WHEN 3 THEN 1 WHEN 4 THEN 4 ELSE 0 END AS flag,
           CASE WHEN net = '2g' THEN '2G' WHEN net IN ('3g', '4g') THEN '3G/4G'
                WHEN net = 'wifi' THEN 'Wifi' ELSE '其他' END AS network, status
    FROM (
      SELECT c_custkey, CAST(c_custkey % 4 + 1 AS INTEGER) AS flag,
             lower(['2G', '3g', '4G', 'WIFI', 'lan'][CAST(c_nationkey % 5 AS INTEGER) + 1]) AS net,
             CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0' WHEN 'BUILDING' THEN '1'
                  WHEN 'FURNITURE' THEN '2' WHEN 'HOUSEHOLD' THEN '3' END AS status
      FROM customer)
    WHERE status IS NOT NULL
    """
)
def value_mapping(spark, folder):
    metric = F.create_map(
        *[
            F.lit(x)
            for pair in zip(
                ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"), scalar.APPOINTMENT_STATUS
            )
            for x in pair
        ]
    )
    network = F.array(*[F.lit(x) for x in ("2G", "3g", "4G", "WIFI", "lan")])
    return (
        table(spark, folder, "customer")
        .select(
            "c_custkey",
            (F.col("c_custkey") % 4 + 1).cast("int").alias("flag"),
            scalar.network_label(network[F.col("c_nationkey") % 5]).alias("network"),
            scalar.appointment_status(F.try_element_at(metric, "c_mktsegment")).alias("status"),
        )
        .where(F.col("status").isNotNull())
        .replace(scalar.GOOD_FLAG, subset=["flag"])
    )


@query(
    f"WITH {EVENT_RELATIONS_SQL} SELECT * FROM event_relations WHERE rel = 'purchase' "
    "AND val NOT IN ('', 'NULL') AND user_id IS NOT NULL"
)
def clean_relations(spark, folder):
    return ops.clean_relations(event_relations(spark, folder), "purchase")


@query(
    f"WITH {EVENT_RELATIONS_SQL} SELECT * FROM event_relations WHERE rel NOT IN ('error', 'signup') "
    "AND addtime >= epoch(TIMESTAMP '2024-01-15 00:00:00') AND val NOT IN ('', 'NULL')"
)
def clean_relations_since(spark, folder):
    return ops.clean_relations_since(
        event_relations(spark, folder), "2024-01-15", excluded=("error", "signup")
    )


@query(
    """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000
                          ELSE CAST(floor(epoch(ts)) AS BIGINT) * 1000 END AS millis,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
    FROM events
    """
)
def epoch_normalize(spark, folder):
    at = F.col("ts").cast("timestamp")
    mixed = F.when(F.col("event_id") % 2 == 0, F.unix_millis(at)).otherwise(F.unix_seconds(at))
    millis = scalar.epoch_millis(mixed)
    return table(spark, folder, "events").select(
        "event_id",
        millis.alias("millis"),
        F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


@query(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "'us' AS city FROM events"
)
def json_props(spark, folder):
    nested = F.concat(F.lit('{"props":'), F.col("props"), F.lit(',"address":{"city":"us"}}'))
    schema = F.schema_of_json('{"props":{"k":1},"address":{"city":"us"}}')
    parsed = table(spark, folder, "events").select("event_id", F.from_json(nested, schema).alias("v"))
    return parsed.select("event_id", F.col("v.props.k").alias("k"), F.col("v.address.city").alias("city"))


@query("SELECT to_json({'id': event_id, 'type': event_type}) AS line FROM events")
def to_json_rows(spark, folder):
    return table(spark, folder, "events").select(
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("line")
    )


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def inner_join(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "custkey")
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "custkey")
    return orders.join(customer, "custkey").select("o_orderkey", "c_name", "o_totalprice")


@query(
    f"WITH {EVENT_RELATIONS_SQL}, {USER_CLASSIFY_SQL} SELECT * FROM event_relations WHERE user_id IN "
    "(SELECT user_id FROM user_classify WHERE last_order_nid IS NOT NULL)"
)
def semi_join_users(spark, folder):
    known = user_classify(spark, folder).where(F.col("last_order_nid").isNotNull())
    relations = event_relations(spark, folder).select(*ops.RELATION_COLUMNS)
    return ops.restrict_to(relations, known, "user_id").select(*ops.RELATION_COLUMNS)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_type FROM
      (SELECT * FROM part WHERE p_type = 'ECONOMY' OR p_type = 'SMALL') RIGHT JOIN lineitem
      ON p_partkey = l_partkey
    """
)
def right_outer_join(spark, folder):
    kind = F.col("p_type")
    parts = table(spark, folder, "part").where((kind == "ECONOMY") | (kind == "SMALL"))
    lines = table(spark, folder, "lineitem")
    joined = ops.right_join_lookup(
        parts.select("p_partkey", "p_name", "p_type"), lines, F.col("p_partkey") == F.col("l_partkey")
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_type")


@query(
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "GROUP BY n_name"
)
def sql_join_view_table(spark, folder):
    view = f"customers_{uuid.uuid4().hex}"
    table(spark, folder, "customer").createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT n_name, count(*) AS customers FROM {view} v JOIN parquet.`{folder}/nation.parquet` n "
        "ON v.c_nationkey = n.n_nationkey GROUP BY n_name"
    )


@query(
    "SELECT c_custkey, coalesce(orders, 0) AS orders FROM customer LEFT JOIN "
    "(SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"
)
def left_join_default(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey")
    counts = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return ops.left_join_default(customer, counts, "c_custkey", {"orders": 0})


@query("SELECT count(*) AS rows FROM lineitem")
def global_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT nullif(event_type, 'error') AS kind, count(*) AS rows FROM events GROUP BY 1")
def count_by_key(spark, folder):
    kind = F.nullif(F.col("event_type"), F.lit("error")).alias("kind")
    return table(spark, folder, "events").groupBy(kind).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey ORDER BY cnt DESC, l_partkey")
def key_distribution(spark, folder):
    return ops.key_distribution(table(spark, folder, "lineitem"), "l_partkey")


@query(
    f"""
    WITH {USER_CLASSIFY_SQL},
    flags AS (SELECT c_nationkey, CASE WHEN flag = 3 THEN 1 ELSE 0 END AS good
              FROM user_classify JOIN customer ON user_id = c_custkey),
    sums AS (SELECT c_nationkey, sum(good) AS good, count(good) AS total FROM flags GROUP BY c_nationkey)
    SELECT c_nationkey,
           CAST(round(CAST(good / total AS DECIMAL(18,6)), 2) AS DOUBLE) AS good_rate,
           CAST(round(CAST((total - good) / total AS DECIMAL(18,6)), 2) AS DOUBLE) AS bad_rate, total
    FROM sums
    """
)
def group_rates(spark, folder):
    flags = user_classify(spark, folder).replace(scalar.GOOD_FLAG, subset=["flag"])
    nation = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    return ops.group_rates(flags.join(nation, "user_id"), ["c_nationkey"], "flag")


@query("SELECT count(DISTINCT l_orderkey) AS groups FROM lineitem")
def distinct_group_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count_distinct("l_orderkey").alias("groups"))


@query(
    "SELECT o_custkey, o_orderkey, count(*) AS times FROM orders GROUP BY o_custkey, o_orderkey"
)
def grouped_order_lists(spark, folder):
    return grouped_items(table(spark, folder, "orders"), ["o_custkey"], "o_orderkey")


@query(
    "SELECT l_returnflag, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, "
    "max(l_extendedprice) AS highest FROM lineitem GROUP BY l_returnflag"
)
def salted_group_agg(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("bigint").alias("q")
    )
    return salted_aggregate(
        lines,
        ["l_returnflag"],
        partial={
            "rows": F.count(F.lit(1)),
            "quantity": F.sum("q"),
            "highest": F.max("l_extendedprice"),
        },
        final={"rows": F.sum("rows"), "quantity": F.sum("quantity"), "highest": F.max("highest")},
    )


@query(
    "SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
)
def salted_lookup_join(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber"
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    joined = salted_join(lines, suppliers, "s_suppkey")
    return joined.select("l_orderkey", "l_linenumber", "s_name")


@query("SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def distinct_edges(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query(
    f"""
    WITH {EVENT_RELATIONS_SQL}
    SELECT DISTINCT user_id AS id, 'user_id::' || user_id AS name FROM event_relations
    UNION ALL SELECT DISTINCT node_id, rel || '::' || val FROM event_relations
    """
)
def union_vertices(spark, folder):
    relations = event_relations(spark, folder)
    users = relations.select("user_id").distinct().select(
        F.col("user_id").alias("id"), F.concat_ws("::", F.lit("user_id"), F.col("user_id").cast("string")).alias("name")
    )
    values = relations.select("node_id", "rel", "val").distinct().select(
        F.col("node_id").alias("id"), F.concat_ws("::", "rel", "val").alias("name")
    )
    return users.unionByName(values)


@query(
    f"WITH {EVENT_RELATIONS_SQL} SELECT rel, val, count(DISTINCT user_id) AS members FROM event_relations "
    "GROUP BY rel, val ORDER BY members DESC, rel, val LIMIT 20"
)
def top_shared_values(spark, folder):
    return ops.top_values(event_relations(spark, folder), ["rel", "val"], "user_id", 20)


@query(
    r"""
    SELECT word, count(*) AS n FROM (
      SELECT unnest(string_split_regex(text, '[ \t]')) AS word FROM documents)
    WHERE length(word) > 0 GROUP BY word
    """
)
def word_count(spark, folder):
    word = F.explode(scalar.words(F.col("text"))).alias("word")
    return table(spark, folder, "documents").select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS matches FROM documents WHERE contains(text, 'the')")
def grep_count(spark, folder):
    return table(spark, folder, "documents").where(F.col("text").contains("the")).agg(
        F.count(F.lit(1)).alias("matches")
    )


@query(
    """
    SELECT a.vec_id,
      CAST(floor(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i:
          a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)) * 1e4 + 0.5) AS BIGINT) AS dot,
      CAST(floor(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i:
          (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) * 1e4 + 0.5) AS BIGINT) AS distance
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
    """
)
def vector_distance(spark, folder):
    vectors = table(spark, folder, "embeddings")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    a, b = F.col("embedding"), F.col("other")
    return vectors.join(following, "vec_id").select(
        "vec_id",
        scalar.fixed_point(scalar.dot(a, b)).alias("dot"),
        scalar.fixed_point(scalar.squared_distance(a, b)).alias("distance"),
    )


@query(
    "SELECT c_custkey, sign(c_acctbal / 3) * floor(abs(c_acctbal / 3) * 100 + 0.5) / 100 AS third FROM customer"
)
def udf_round2(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", aggregates.round2(F.col("c_acctbal") / 3).alias("third")
    )


_AVERAGE_SQL = (
    "SELECT c_nationkey, CAST(floor(avg(c_acctbal) * 1e4 + 0.5) AS BIGINT) AS average FROM customer GROUP BY c_nationkey"
)


@query(_AVERAGE_SQL)
def udaf_average(spark, folder):
    aggregates.register_average(spark)
    partials = aggregates.average_partials(table(spark, folder, "customer"), ["c_nationkey"], "c_acctbal")
    view = f"partials_{uuid.uuid4().hex}"
    partials.createOrReplaceTempView(view)
    averages = spark.sql(f"SELECT c_nationkey, my_average(sum, count) AS average FROM {view} GROUP BY c_nationkey")
    return averages.withColumn("average", scalar.fixed_point(F.col("average")))


@query(_AVERAGE_SQL)
def native_average(spark, folder):
    return table(spark, folder, "customer").groupBy("c_nationkey").agg(
        scalar.fixed_point(aggregates.average(F.col("c_acctbal"))).alias("average")
    )


@query(_AVERAGE_SQL)
def udaf_average_typed(spark, folder):
    averages = aggregates.typed_average(table(spark, folder, "customer"), ["c_nationkey"], "c_acctbal")
    return averages.select("c_nationkey", scalar.fixed_point(F.col("average")).alias("average"))


@query(
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING'"
)
def row_maps(spark, folder):
    """Rows as maps of several columns, read back by key."""
    as_map = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    rows = table(spark, folder, "customer").where("c_acctbal > 0").select("c_custkey", as_map.alias("row"))
    return rows.where(F.col("row")["segment"] != "BUILDING").select(
        "c_custkey", F.col("row")["name"].alias("c_name"), F.col("row")["segment"].alias("c_mktsegment")
    )


