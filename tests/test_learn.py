"""Learning rounds against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygraph.learn import als, kmeans, logreg
from tallygraph.learn.batches import vector_sums

RNG = np.random.default_rng(3)
POINTS = np.vstack([RNG.normal(c, 0.3, (30, 3)) for c in (0.0, 4.0, 9.0)])


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, [float(x) for x in p], 1.0 if i % 3 else -1.0) for i, p in enumerate(POINTS)]
    return spark.createDataFrame(rows, "id BIGINT, v ARRAY<DOUBLE>, y DOUBLE").repartition(3)


def test_vector_sums(points):
    got = vector_sums(points, ["y"], "v").where("y = 1").first()
    assert got["sums"] == pytest.approx(POINTS[np.arange(90) % 3 != 0].sum(axis=0))
    assert got["rows"] == 60


def test_lloyd(points):
    start = [list(POINTS[0]), list(POINTS[40]), list(POINTS[80])]
    centres = kmeans.lloyd(points, "v", start)
    assert np.array(centres) == pytest.approx(np.array([POINTS[i : i + 30].mean(axis=0) for i in (0, 30, 60)]))
    clusters = {r["id"]: r["cluster"] for r in kmeans.assign(points, "v", centres, "id").collect()}
    assert clusters == {i: i // 30 for i in range(90)}


def test_empty_cluster_keeps_its_centre_and_ties_go_low(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [3.0])], "id BIGINT, v ARRAY<DOUBLE>")
    centres = kmeans.lloyd_rounds(df, "v", [[2.0], [2.0], [100.0]], 1)
    assert centres == [[2.0], [2.0], [100.0]]
    assert {r["cluster"] for r in kmeans.assign(df, "v", centres, "id").collect()} == {0}


def test_sampled_centres_are_repeatable(points):
    first = kmeans.sample_centres(points, "id", "v", 4)
    assert first == kmeans.sample_centres(points.repartition(5), "id", "v", 4)
    assert first != kmeans.sample_centres(points, "id", "v", 4, seed=7)
    assert len({tuple(c) for c in first}) == 4


def test_gradient_rounds(points):
    w, y = np.zeros(3), np.where(np.arange(90) % 3, 1.0, -1.0)
    for _ in range(4):
        w = w - 0.01 * (((1 / (1 + np.exp(-y * (POINTS @ w))) - 1) * y) @ POINTS)
    assert logreg.gradient_rounds(points, "y", "v", [0.0] * 3, 4, step=0.01) == pytest.approx(list(w))


def test_ml_models(points):
    assert len(kmeans.ml_kmeans(points, "v", 3).clusterCenters()) == 3
    assert logreg.ml_logistic_regression(points, "y", "v").numFeatures == 3


def test_als_error_falls(spark):
    left, right = RNG.normal(1, 1, (12, 3)), RNG.normal(1, 1, (15, 3))
    rows = [(u, i, float(left[u] @ right[i])) for u in range(12) for i in range(15)]
    triples = als.ratings(spark.createDataFrame(rows, "u INT, i INT, r DOUBLE"), "u", "i", "r").cache()
    errors = [
        als.rmse(als.factorize(triples, 3, rounds).transform(triples), "prediction", "rating").first()["rmse"]
        for rounds in (1, 8)
    ]
    assert errors[1] < errors[0]
    assert errors[1] < 0.3


def _normal_equations(triples, factors):
    """Largest distance of a user's factors from the solution by numpy, relative to its size."""
    items = {r["item"]: np.array(r["v"]) for r in factors.items.collect()}
    worst = 0.0
    for row in factors.users.collect():
        mine = [(items[i], r) for u, i, r in triples if u == row["user"]]
        gram = sum(np.outer(v, v) for v, _ in mine) + factors.reg * len(mine) * np.eye(factors.rank)
        want = np.linalg.solve(gram, sum(r * v for v, r in mine))
        worst = max(worst, np.abs(want - row["u"]).max() / np.abs(want).max())
    return worst


def test_als_with_64_bit_ids_and_its_normal_equations(spark):
    far = 2**40
    triples = [(far + u, -far * i, float((u * i) % 5 + 1)) for u in range(25) for i in range(1, 20) if (u + i) % 3]
    df = spark.createDataFrame(triples, "user BIGINT, item BIGINT, rating FLOAT")
    odd = spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0), (2, 3, None)], df.schema)
    factors = als.factorize(df.unionByName(odd), rank=3, rounds=4, reg=0.1, ratings_per_block=20)
    assert _normal_equations(triples, factors) < 1e-3
    off = factors.unsolved(df).collect()
    assert len(off) == 25 and max(r["off"] for r in off) < 1e-5
    assert {r["user"]: r["ratings"] for r in off}[far] == sum(1 for t in triples if t[0] == far)
    moved = factors.users.withColumn("u", F.transform("u", lambda x: x * 1.01))
    wrong = als.Factors(moved, factors.items, factors.rank, factors.reg).unsolved(df)
    assert wrong.where("off < 1e-5").count() == 0
    assert factors.transform(df).count() == len(triples)


def test_als_carries_single_precision_and_multiplies_in_double(spark):
    triples = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9) if (u + i) % 3]
    df = spark.createDataFrame(triples, "user BIGINT, item BIGINT, rating FLOAT")
    factors = als.factorize(df, rank=3, rounds=2)
    assert factors.users.schema["u"].dataType.simpleString() == "array<float>"
    assert factors.items.schema["v"].dataType.simpleString() == "array<float>"
    u = {r["user"]: np.array(r["u"]) for r in factors.users.collect()}
    v = {r["item"]: np.array(r["v"]) for r in factors.items.collect()}
    for r in factors.transform(df).collect():
        assert r["prediction"] == np.float32(sum(a * b for a, b in zip(u[r["user"]], v[r["item"]])))


def test_lloyd_ends_when_no_point_changes(spark):
    """Sums of thirds differ in their last bits with the order of partitions, so moves need not reach 0."""
    values = [(i, [i / 3.0, (i % 7) / 9.0]) for i in range(400)]
    df = spark.createDataFrame(values, "id BIGINT, v ARRAY<DOUBLE>").repartition(7)
    centres = np.array(kmeans.lloyd(df, "v", [[0.0, 0.0], [1.0, 1.0], [2.0, 0.5]], converge=-1.0))
    data = np.array([v for _, v in values])
    nearest = ((data[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert centres == pytest.approx(np.array([data[nearest == i].mean(axis=0) for i in range(3)]))


def test_lloyd_reads_points_once(spark, monkeypatch):
    """The points are packed once, in blocks, and lead to the centres of rounds over all of them."""
    data = np.random.default_rng(5).normal(size=(600, 4)).astype(np.float32)
    df = spark.createDataFrame([(v.tolist(),) for v in data], "v ARRAY<FLOAT>").repartition(3)
    start = [[float(x) for x in v] for v in data[:5]] + [[90.0] * 4]
    before, current = None, np.array(start)
    while True:
        nearest = ((data[:, None].astype(float) - current[None]) ** 2).sum(axis=2).argmin(axis=1)
        if before is not None and (before == nearest).all():
            break
        current = np.array([data[nearest == i].mean(axis=0, dtype=float) if (nearest == i).any() else c for i, c in enumerate(current)])
        before = nearest
    pack, blocks = kmeans._pack, []
    monkeypatch.setattr(kmeans, "_BLOCK_BYTES", 1600)

    def counted(*args):
        packed = pack(*args)
        blocks.append(packed.count())
        return packed

    monkeypatch.setattr(kmeans, "_pack", counted)
    assert np.array(kmeans.lloyd(df, "v", start)) == pytest.approx(current, abs=1e-9)
    assert len(blocks) == 1 and 6 <= blocks[0] <= 8


def test_nearest_of_many_settles_ties_like_nearest():
    centres = np.array([[2.0, 0.0], [0.0, 0.0], [2.0, 0.0], [1e6, 1.0]])
    matrix = np.array([[1.0, 5.0], [3.0, 1.0], [0.1, 0.0], [1.0 + 1e-13, 1e5], [np.nan, 1.0], [np.inf, 0.0]])
    with np.errstate(invalid="ignore"):
        assert list(kmeans._nearest_of_many(matrix, centres)) == list(kmeans._nearest(matrix, centres))
        sums = kmeans._sums(matrix, np.array([0, 1, 0, 1, 2, 0]), 3)
    assert sums[1] == pytest.approx([4.0, 1e5 + 1, 2.0])


def test_dense_ids(spark, rows):
    keys = [(7,), (None,), (-3,), (2**50,), (7,)] + [(i * 1000,) for i in range(200)]
    df = spark.createDataFrame(keys, "k BIGINT").repartition(5)
    distinct = sorted({k for k, in keys if k is not None})
    assert sorted(tuple(r) for r in als.dense_ids(df, "k").collect()) == [(k, i) for i, k in enumerate(distinct)]
    assert als.dense_ids(df.limit(0), "k").count() == 0


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "p DOUBLE, a DOUBLE")
    assert als.rmse(df, "p", "a").first()["rmse"] == pytest.approx(np.sqrt(0.5))
    assert als.rmse(df.where(F.lit(False)), "p", "a").first()["rmse"] is None
