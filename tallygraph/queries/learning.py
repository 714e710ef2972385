"""Learning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygraph.functions.scalar import fixed_point
from tallygraph.learn import als, kmeans, logreg
from tallygraph.learn.batches import vector_sums
from tallygraph.queries.registry import query
from tallygraph.session import table
from tallygraph.storage import materialize

K = 5
ROUNDS = 5
LR_ROUNDS = 3
# Rounds of the SQL, more than the tables need until nothing changes.
SETTLED = 60


def _unrolled_kmeans_sql(rounds: int = ROUNDS) -> str:
    steps = [
        "points AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"cells AS MATERIALIZED (SELECT vec_id, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS x FROM points)",
        f"centre0 AS MATERIALIZED (SELECT vec_id AS cluster, v AS c FROM points WHERE vec_id < {K})",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
              SELECT vec_id, cluster FROM (
                SELECT vec_id, cluster, row_number() OVER (PARTITION BY vec_id ORDER BY
                  list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) ** 2)), cluster) AS place
                FROM points, centre{i - 1}) WHERE place = 1)"""
        )
        steps.append(
            f"""centre{i} AS MATERIALIZED (
              SELECT o.cluster, coalesce(m.c, o.c) AS c FROM centre{i - 1} o LEFT JOIN (
                SELECT cluster, list(x ORDER BY pos) AS c FROM (
                  SELECT cluster, pos, avg(x) AS x FROM cells JOIN near{i} USING (vec_id) GROUP BY cluster, pos)
                GROUP BY cluster) m USING (cluster))"""
        )
    return ",\n".join(steps)


@query(
    f"""
    WITH {_unrolled_kmeans_sql()}
    SELECT CAST(cluster AS INTEGER) AS cluster, unnest(range(0, len(c)))::INTEGER AS pos,
           CAST(floor(unnest(c) * 1e6 + 0.5) AS BIGINT) AS value FROM centre{ROUNDS}
    """
)
def kmeans_fixed_rounds(spark, folder):
    points = table(spark, folder, "embeddings")
    centres = kmeans.lloyd_rounds(points, "embedding", _start(points), ROUNDS)
    rows = spark.createDataFrame(list(enumerate(centres)), "cluster INT, c ARRAY<DOUBLE>")
    cells = rows.select("cluster", F.posexplode("c").alias("pos", "value"))
    return cells.withColumn("value", fixed_point(F.col("value"), 6))


def _start(points):
    return [row[0] for row in points.where(F.col("vec_id") < K).orderBy("vec_id").select("embedding").collect()]


@query(
    f"""
    WITH {_unrolled_kmeans_sql(SETTLED)}
    SELECT CAST(cluster AS INTEGER) AS cluster, unnest(range(0, len(c)))::INTEGER AS pos,
           CAST(floor(unnest(c) * 1e6 + 0.5) AS BIGINT) AS value FROM centre{SETTLED}
    """
)
def kmeans_converged(spark, folder):
    """Rounds until no point changes its centre."""
    points = table(spark, folder, "embeddings").select("vec_id", "embedding")
    centres = kmeans.lloyd(points, "embedding", _start(points))
    rows = spark.createDataFrame(list(enumerate(centres)), "cluster INT, c ARRAY<DOUBLE>")
    cells = rows.select("cluster", F.posexplode("c").alias("pos", "value"))
    return cells.withColumn("value", fixed_point(F.col("value"), 6))


def _unrolled_logreg_sql() -> str:
    steps = [
        "points AS MATERIALIZED (SELECT vec_id, CASE WHEN label % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS y, "
        "CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        "cells AS MATERIALIZED (SELECT vec_id, y, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS x FROM points)",
        "w0 AS MATERIALIZED (SELECT pos, 0.0::DOUBLE AS w FROM cells GROUP BY pos)",
    ]
    for i in range(1, LR_ROUNDS + 1):
        steps.append(
            f"f{i} AS MATERIALIZED (SELECT vec_id, (1 / (1 + exp(-any_value(y) * sum(x * w))) - 1) * any_value(y) AS f "
            f"FROM cells JOIN w{i - 1} USING (pos) GROUP BY vec_id)"
        )
        steps.append(
            f"w{i} AS MATERIALIZED (SELECT pos, any_value(w) - 0.01 * sum(f * x) AS w "
            f"FROM cells JOIN f{i} USING (vec_id) JOIN w{i - 1} USING (pos) GROUP BY pos)"
        )
    return ",\n".join(steps)


@query(
    f"WITH {_unrolled_logreg_sql()} SELECT CAST(pos - 1 AS INTEGER) AS pos, "
    f"CAST(floor(w * 1e6 + 0.5) AS BIGINT) AS weight FROM w{LR_ROUNDS}"
)
def logreg_fixed_rounds(spark, folder):
    points = table(spark, folder, "embeddings").withColumn("y", F.when(F.col("label") % 2 == 0, 1.0).otherwise(-1.0))
    width = points.select(F.size("embedding")).first()[0]
    weights = logreg.gradient_rounds(points, "y", "embedding", [0.0] * width, LR_ROUNDS, step=0.01)
    rows = spark.createDataFrame(list(enumerate(weights)), "pos INT, weight DOUBLE")
    return rows.withColumn("weight", fixed_point(F.col("weight"), 6))


@query(
    """
    SELECT label, CAST(pos - 1 AS INTEGER) AS pos, CAST(floor(sum(x) * 1e4 + 0.5) AS BIGINT) AS total FROM (
      SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
    GROUP BY label, pos
    """
)
def vector_sum_by_label(spark, folder):
    sums = vector_sums(table(spark, folder, "embeddings"), ["label"], "embedding")
    return sums.select("label", F.posexplode("sums").alias("pos", "total")).withColumn(
        "total", fixed_point(F.col("total"))
    )


@query(
    "SELECT CAST(floor(sqrt(avg((l_extendedprice - l_quantity * p_retailprice) ** 2)) * 100 + 0.5) AS BIGINT) AS rmse "
    "FROM lineitem JOIN part ON l_partkey = p_partkey"
)
def rmse(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    priced = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_extendedprice", (F.col("l_quantity") * F.col("p_retailprice")).alias("listed")
    )
    return als.rmse(priced, "listed", "l_extendedprice").select(fixed_point(F.col("rmse"), 2).alias("rmse"))


def _bought(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return materialize(als.ratings(bought, "o_custkey", "l_partkey", "l_quantity"), "bought")


@query()
def als_predictions(spark, folder):
    """Predicted quantity of every customer - part pair that was ordered."""
    triples = _bought(spark, folder)
    return als.factorize(triples, rank=8, rounds=3).transform(triples)


@query(
    """
    SELECT o_custkey AS "user", count(DISTINCT l_partkey) AS ratings, true AS solved
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
    """
)
def als_normal_equations(spark, folder):
    """Every customer whose factors solve the equations of the customer's own ratings."""
    triples = _bought(spark, folder)
    off = als.factorize(triples, rank=8, rounds=3).unsolved(triples)
    return off.select("user", "ratings", (F.col("off") < 1e-5).alias("solved"))
