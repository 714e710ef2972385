"""Round trips through files, tables and views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallygraph.graph import model
from tallygraph.plans import csv_repair
from tallygraph.plans.group_detection import write_groups
from tallygraph.queries.inputs import EVENT_RELATIONS_SQL, event_relations
from tallygraph.queries.registry import query
from tallygraph.session import table
from tallygraph.sources import files, writers
from tallygraph.storage import materialize, scratch_path


@query("SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def parquet_roundtrip(spark, folder):
    """Overwrite, then append."""
    path = scratch_path(spark, "parquet")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    writers.write_parquet(rows, path, "overwrite")
    writers.write_parquet(rows, path, "append")
    return files.read_default(spark, path)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000007'")
def orc_roundtrip(spark, folder):
    path = scratch_path(spark, "orc")
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    writers.write_orc(rows, path, bloom_columns="c_name", dictionary_threshold=1.0, direct_encoding="c_mktsegment")
    return spark.read.orc(path).where(F.col("c_name") == "Customer#000000007")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def partitioned_roundtrip(spark, folder):
    path = scratch_path(spark, "partitioned")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    writers.write_parquet(rows, path, partition_by="o_orderstatus")
    return files.read_parquet(spark, path).where(F.col("o_orderstatus") == "F")


@query("SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority")
def csv_roundtrip(spark, folder):
    """Header and ``;`` as separator, the schema given on reading."""
    path = scratch_path(spark, "csv")
    rows = table(spark, folder, "orders")
    rows.write.options(sep=";", header=True).csv(path)
    orders = files.read_csv(spark, path, sep=";", schema=rows.schema)
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000")
def json_roundtrip(spark, folder):
    path = scratch_path(spark, "json")
    rows = table(spark, folder, "customer")
    rows.write.json(path)
    customer = files.read_json(spark, path, rows.schema)
    return customer.where(F.col("c_acctbal").between(1000, 2000)).select("c_custkey", "c_name")


@query("SELECT p_partkey, p_size FROM part")
def text_columns(spark, folder):
    """Delimited text lines as typed columns."""
    path = scratch_path(spark, "lines")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"))
    writers.write_lines(table(spark, folder, "part").select(line), path)
    return files.split_columns(files.read_lines(spark, path), [("p_partkey", "bigint"), ("p_size", "int")], "\t")


@query("SELECT count(*) AS words FROM (SELECT unnest(string_split_regex(text, '[ \t]')) AS w FROM conversations) WHERE length(w) > 0")
def word_count_roundtrip(spark, folder):
    """Words counted in a table and in its text copy; the two must agree."""
    from tallygraph.plans.word_count import words_before_and_after

    path = scratch_path(spark, "words")
    # One line per text, because a text file ends its lines at every line break.
    texts = table(spark, folder, "conversations").select(F.regexp_replace("text", "[\r\n]", "\u2028").alias("value"))
    counts = words_before_and_after(texts, path)
    return counts.where("before = after").select(F.col("after").alias("words"))


@query("SELECT n_name, n_regionkey FROM nation")
def sql_on_file(spark, folder):
    return files.query_file(spark, f"{folder}/nation.parquet").select("n_name", "n_regionkey")


@query("SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def global_view_sql(spark, folder):
    """A global view queried from another session."""
    name = writers.create_view(table(spark, folder, "nation"), f"nations_{uuid.uuid4().hex}", shared=True)
    counts = f"SELECT n_regionkey, count(*) AS nations FROM {name} GROUP BY n_regionkey"
    spark.newSession().sql(counts).first()
    return spark.sql(counts)


@query(
    "SELECT 'orders' AS file, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
)
def source_files(spark, folder):
    """Rows per table name of the files read."""
    read = [
        files.source_files(table(spark, folder, name).select(F.col(key)), excluded=("_tmp",))
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"))
    ]
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(/.*)?$", 1).alias("file")
    return read[0].unionByName(read[1]).groupBy(name).agg(F.sum("rows").alias("rows"))


@query("SELECT o_custkey, count(*) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def bucketed_join(spark, folder):
    """Join of two tables bucketed and sorted by the join key."""
    suffix = uuid.uuid4().hex
    order_rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    line_rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    buckets = writers.bucket_count(order_rows, line_rows)
    orders, lines = f"orders_{suffix}", f"lines_{suffix}"
    writers.save_table(
        order_rows, orders, bucket_by="o_orderkey", buckets=buckets, sort_by="o_orderkey", path=scratch_path(spark, orders),
    )
    writers.save_table(
        line_rows, lines, bucket_by="l_orderkey", buckets=buckets, sort_by="l_orderkey", path=scratch_path(spark, lines),
    )
    joined = spark.table(orders).join(spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(regexp_replace(text, '[\r\n]+', '', 'g'), '') AS text, source FROM documents"
)
def csv_repaired(spark, folder):
    """Whole texts written as quoted CSV fields, line breaks included, and read back one record per line."""
    path = scratch_path(spark, "broken-csv")
    rows = table(spark, folder, "documents").select("doc_id", "text", "source")
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quoteAll=True, escape='"', **kept).csv(path)
    return csv_repair.read_repaired(spark, path)


@query(
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS BIGINT) AS o_custkey, 1 AS part FROM orders WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT o_orderkey, NULL, o_custkey, 2 FROM orders WHERE o_orderstatus <> 'F'"
)
def schema_merge(spark, folder):
    """Two parts of a table with different columns, read as one."""
    path = scratch_path(spark, "merged")
    orders = table(spark, folder, "orders")
    finished = F.col("o_orderstatus") == "F"
    writers.write_parquet(orders.where(finished).select("o_orderkey", "o_totalprice"), f"{path}/part=1")
    others = orders.where(~finished).select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"))
    writers.write_parquet(others, f"{path}/part=2")
    return files.read_parquet(spark, path, merge_schema=True)


@query(
    "SELECT least(l_suppkey, l_partkey) AS src, greatest(l_suppkey, l_partkey) AS dst, count(*) AS edges "
    "FROM lineitem GROUP BY ALL"
)
def edge_list_file(spark, folder):
    """Edges of a text file with comments, each turned so that the smaller end comes first."""
    path = scratch_path(spark, "edges")
    line = F.concat_ws("\t", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    comment = F.concat(F.lit("# line "), F.col("l_linenumber").cast("string"))
    lines = table(spark, folder, "lineitem").select(F.explode(F.array(comment, line)).alias("value"))
    writers.write_lines(lines, path)
    return model.edge_list(spark, path, canonical=True).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("edges"))


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS src, o_orderstatus AS dst FROM orders")
def link_pairs_file(spark, folder):
    """Distinct pairs of a text file in which pairs repeat."""
    path = scratch_path(spark, "links")
    pair = F.concat_ws(" ", F.col("o_custkey").cast("string"), "o_orderstatus")
    writers.write_lines(table(spark, folder, "orders").select(pair), path)
    return model.link_pairs(spark, path)


@query(f"WITH {EVENT_RELATIONS_SQL} SELECT rel, 2 * count(*) AS rows, count(DISTINCT edge_id) AS edges FROM event_relations GROUP BY rel")
def managed_append(spark, folder):
    """Groups appended twice to a managed table partitioned by relation."""
    name = f"groups_{uuid.uuid4().hex}"
    relations = event_relations(spark, folder).select("rel", "user_id", "edge_id")
    for _ in range(2):
        write_groups(relations, name)
    counts = spark.table(name).groupBy("rel").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("edge_id").alias("edges")
    )
    counts = materialize(counts, "appended")
    writers.drop_table(spark, name)
    return counts
