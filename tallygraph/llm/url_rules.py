"""URL rules by host and path prefix, as a sort-merge range join. Native columns only.

Reversing the labels of a host ("www.example.com" -> "com.example.www.") turns "this host and all
its subdomains" into an interval of keys. Every rule host opens and closes one interval; between
two such bounds the stack of open intervals does not change, so each bound carries the stack that
holds from it on. URLs and bounds are sorted together, and the running last bound of a URL is the
stack of nested rules that are active at it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.session import table

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _bounds(rules: DataFrame) -> DataFrame:
    """One row per end of a rule host's interval: its key and the rules open from there on.

    The open rules are those of the host's own ancestors, found by joining on each ancestor key;
    a stack is as deep as the host has labels, never as long as the table.
    """
    own = rules.groupBy("_key").agg(
        F.collect_list(F.struct("_size", "host", "path", "rule", "verdict")).alias("_own")
    )
    labels = F.split("_key", r"\.")
    chain = own.select(
        "_key",
        F.posexplode(F.sequence(F.lit(1), F.size(labels) - 1)).alias("_depth", "_n"),
        labels.alias("_labels"),
    ).select("_key", F.concat(F.array_join(F.slice("_labels", 1, F.col("_n")), "."), F.lit(".")).alias("_up"))
    stacks = (
        chain.join(own.select(F.col("_key").alias("_up"), "_own"), "_up")
        .groupBy("_key")
        .agg(
            F.sort_array(F.flatten(F.collect_list("_own")), asc=False).alias("_open"),
            F.sort_array(
                F.flatten(F.collect_list(F.when(F.col("_up") != F.col("_key"), F.col("_own")))), asc=False
            ).alias("_rest"),
        )
    )
    # "/" is the byte after ".", so the interval of key k. is [k., k/).
    closing = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/"))
    return stacks.select("_key", F.col("_open").alias("_stack")).unionByName(
        stacks.select(closing.alias("_key"), F.col("_rest").alias("_stack"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Longest fitting rule and verdict of every URL.

    ``rules`` has ``host``, ``path`` and ``verdict``; rows with a null are ignored, of repeated
    (host, path) rules the smallest verdict counts. A rule fits a URL whose host is its host or
    a subdomain of it and whose path starts with its path. The longest rule text wins; of equally
    long ones the greater host does. Returns the columns of ``pages`` (those named like a result
    are replaced) and ``host, path, rule, verdict``; a URL without a fitting rule, a null or an
    empty one has no rule and the ``default`` verdict. Repeated pages are judged each.

    URLs are dealt out by content to as many sweeps as there are shuffle partitions, and each
    sweep gets the bounds of all rules: a host with a third of all pages is spread like any other,
    and no sweep holds more than its share plus the rules.
    """
    spark = pages.sparkSession
    sweeps = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .where("NOT host RLIKE '[/?#]'")
        .groupBy(_lower(F.col("host")).alias("host"), "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
        .withColumn("_size", F.length("rule"))
        .withColumn("_key", host_key(F.col("host")))
    )
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(
        F.struct(*[pages[c] for c in kept]).alias("_row"), host.alias("_host"), path.alias("_path")
    )
    hashed = [
        F.col(f"_row.`{f.name}`") for f in pages.select(*kept).schema if "map<" not in f.dataType.simpleString()
    ]
    rows = rows.select(
        F.pmod(F.xxhash64(*hashed), F.lit(sweeps)).alias("_sweep"),
        host_key(F.col("_host")).alias("_key"),
        F.lit(1).alias("_kind"),
        "_row",
        "_host",
        "_path",
    )
    bounds = _bounds(rules)
    stack_type = bounds.schema["_stack"].dataType
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(sweeps - 1).cast("bigint"))
    bounds = bounds.withColumn("_sweep", F.explode(numbers))
    both = bounds.withColumn("_kind", F.lit(0)).unionByName(
        rows.withColumn("_stack", F.lit(None).cast(stack_type)), allowMissingColumns=True
    )
    running = (
        Window.partitionBy("_sweep")
        .orderBy("_key", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # The stack is sorted from the longest rule on, so the first fitting one wins.
    fitting = F.filter("_active", lambda rule: F.startswith(F.col("_path"), rule["path"]))
    return (
        both.withColumn("_active", F.last("_stack", ignorenulls=True).over(running))
        .where("_kind = 1")
        .withColumn("_best", F.get(fitting, F.lit(0)))
        .select(
            "_row.*",
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.col("_best.rule").alias("rule"),
            F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


QUERY = op3_url_rules
ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, rule_host DESC) AS place
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON fits.page_id = parts.page_id AND place = 1
"""
