"""k-means: Lloyd's rounds with chosen start points, and the Spark ML estimator."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.learn.batches import as_matrix, partial_sums, plain_matrix, vector_sums
from tallygraph.storage import materialize

Centres = list[list[float]]

# Packed points: bytes of a block, and blocks that are handed to Python at once.
_BLOCK_BYTES = 2**20
_BLOCKS_A_BATCH = 16


def sample_centres(points: DataFrame, id_column: str, vector: str, k: int, seed: int = 42) -> Centres:
    """k different rows as start points: those of the smallest seeded hashes of their id."""
    chosen = points.orderBy(F.xxhash64(F.lit(seed), id_column), id_column).limit(k)
    return [[float(x) for x in row[0]] for row in chosen.select(vector).collect()]


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row, ties to the lowest index."""
    distances = np.stack([((matrix - c) ** 2).sum(axis=1) for c in centres], axis=1)
    return distances.argmin(axis=1)


def _new_centres(points: DataFrame, vector: str, centres: Centres) -> Centres:
    current = np.array(centres)

    def summarize(batch):
        matrix = as_matrix(batch.column(0))
        nearest = _nearest(matrix, current)
        keys, counts = np.unique(nearest, return_counts=True)
        return keys, counts, np.stack([matrix[nearest == key].sum(axis=0) for key in keys])

    parts = partial_sums(points.select(vector), summarize)
    counts = parts.groupBy("key").agg(F.sum("n").alias("n"))
    sums = vector_sums(parts, ["key"], "sums").select("key", "sums")
    # k rows come back, as many as there are centres; an empty cluster keeps its centre.
    moved = [list(c) for c in centres]
    for row in sums.join(counts, "key").collect():
        moved[row["key"]] = [total / row["n"] for total in row["sums"]]
    return moved


def _nearest_of_many(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The same as ``_nearest`` by one product of matrices; what is too close to call goes there."""
    if len(centres) < 2:
        return _nearest(matrix, centres)
    squares = (centres**2).sum(axis=1)
    scores = squares - 2 * (matrix @ centres.T)
    nearest = scores.argmin(axis=1)
    two = np.partition(scores, 1, axis=1)
    longest = np.sqrt((matrix**2).sum(axis=1)) + np.sqrt(squares.max())
    close = ~(two[:, 1] - two[:, 0] > 1e-10 * longest**2)
    if close.any():
        nearest[close] = _nearest(matrix[close], centres)
    return nearest


def _sums(matrix: np.ndarray, nearest: np.ndarray, k: int) -> np.ndarray:
    """Sums and counts of the rows of each centre."""
    of = (nearest[:, None] == np.arange(k)).astype(np.float64)
    sums = of.T @ matrix
    if not np.isfinite(sums).all():  # 0 times infinity is no number
        sums = np.stack([matrix[nearest == key].sum(axis=0) for key in range(k)])
    return np.column_stack([sums, of.sum(axis=0)])


def _pack(points: DataFrame, vector: str) -> DataFrame:
    """The vectors as written blocks of plain numbers, dealt out evenly: ``(numbers, kind, width)``.

    A round then copies bytes where it would read and convert every number of an array column.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = plain_matrix(batch.column(0))
            rows = max(1, _BLOCK_BYTES // max(1, matrix.strides[0]))
            for first in range(0, len(matrix), rows):
                block = np.ascontiguousarray(matrix[first : first + rows])
                cells = ([block.tobytes()], [block.dtype.str], [block.shape[1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cells, (pa.binary(), pa.string(), pa.int32()))],
                    ["numbers", "kind", "width"],
                )

    packed = points.select(vector).mapInArrow(run, "numbers BINARY, kind STRING, width INT")
    return materialize(packed.repartition(points.sparkSession.sparkContext.defaultParallelism), "points")


@contextmanager
def _few_a_batch(spark: SparkSession):
    """Inside, Python gets few rows at once, as each is a block of points."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(_BLOCKS_A_BATCH))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _round(packed: DataFrame, current: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, int | None]:
    """``_new_centres`` over packed points, as one stage without a shuffle.

    A task returns one row, the sums and counts of each centre and how many points changed theirs.
    """
    k, width = current.shape

    def run(batches):
        import pyarrow as pa

        part = np.zeros((k + 1, width + 1))
        for batch in batches:
            for numbers, kind, wide in zip(*batch.columns):
                block = np.frombuffer(numbers.as_buffer(), kind.as_py()).reshape(-1, wide.as_py())
                block = block.astype(np.float64, copy=False)
                nearest = _nearest_of_many(block, current)
                part[:k] += _sums(block, nearest, k)
                if before is not None:
                    part[k, 0] += np.count_nonzero(nearest != _nearest_of_many(block, before))
        yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary())], ["part"])

    told = packed.mapInArrow(run, "part BINARY").collect()
    total = sum((np.frombuffer(row["part"]).reshape(k + 1, width + 1) for row in told), np.zeros((k + 1, width + 1)))
    counts = total[:k, -1:]
    # An empty cluster keeps its centre.
    moved = np.where(counts > 0, total[:k, :-1] / np.maximum(counts, 1), current)
    return moved, None if before is None else int(total[k, 0])


def lloyd(
    points: DataFrame,
    vector: str,
    centres: Sequence[Sequence[float]],
    converge: float = 0.0,
) -> Centres:
    """Move the centres until the sum of their squared moves is at most ``converge``.

    It also ends as soon as no point has another nearest centre than in the round before. Moves
    that are left then come from sums added up in another order, and may never become 0. The rounds
    that takes grow with the points, so the points are read once and packed for the rounds.
    """
    before, current = None, np.array([[float(x) for x in c] for c in centres])
    if not len(current):
        return []
    packed = _pack(points, vector)
    with _few_a_batch(points.sparkSession):
        while True:
            moved, changed = _round(packed, current, before)
            shift = ((current - moved) ** 2).sum()
            before, current = current, moved
            if shift <= converge or changed == 0:
                return current.tolist()


def lloyd_rounds(points: DataFrame, vector: str, centres: Sequence[Sequence[float]], rounds: int) -> Centres:
    """The centres after a fixed number of rounds, settled or not."""
    current = [[float(x) for x in c] for c in centres]
    for _ in range(rounds):
        current = _new_centres(points, vector, current)
    return current


def assign(points: DataFrame, vector: str, centres: Centres, id_column: str) -> DataFrame:
    """``(id, cluster)`` of every point."""
    current = np.array(centres)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                nearest = _nearest(as_matrix(batch.column(1)), current)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(nearest, pa.int32())], [id_column, "cluster"]
                )

    kind = points.schema[id_column].dataType.simpleString()
    return points.select(id_column, vector).mapInArrow(run, f"`{id_column}` {kind}, cluster INT")


def ml_kmeans(points: DataFrame, vector: str, k: int, seed: int = 42, max_rounds: int = 20):
    """Spark ML model on the same points, for the usual case of free start points."""
    features = points.select(array_to_vector(F.col(vector)).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=max_rounds).fit(features)
