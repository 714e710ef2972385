"""Exact top-k search by inner product in M-trees of paged metric nodes.

Every vector x is lifted by one coordinate to the length of the longest of its block; then the
larger the inner product with a query, the smaller the distance to it, and distances obey the
triangle inequality. A block of vectors becomes one tree: pages hold routing objects with covering
radii and the distance to the routing object of the page above. A search takes pages in order of
the best score they can hold. Two stored numbers save computations: an entry is left out when the
distance of the query to the page's routing object and the entry's own to it already differ too
much, and a page when its ball lies beyond the k-th best.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.session import table
from tallygraph.storage import materialize

SCALE = 1024
BLOCK_ROWS = 20_000  # vectors of one tree
QUERY_ROWS = 5_000  # queries that meet a tree at once
LEAF_ROWS = 160
FANOUT = 12

_PAGE = (
    "_block bigint, page int, parent int, leaf boolean, length double, routing binary, radius double, "
    "parent_distance double, vectors binary, distances binary, ids array<array<bigint>>"
)


def scaled(vector: Column, factor: int = SCALE) -> Column:
    """Components as whole numbers, floor(factor * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("bigint"))


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


class _Build:
    """Pages of one tree, made from the top: routing objects far apart, every vector to the nearest."""

    def __init__(self, vectors: np.ndarray, ids: list, block: int):
        self.vectors, self.ids, self.block = vectors, ids, block
        lifted = vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", lifted, lifted)
        self.longest = float(norms.max())
        self.lifted = np.column_stack((lifted, np.sqrt(np.maximum(0.0, self.longest - norms))))
        self.pages: list[dict] = []
        self._grow(np.arange(len(vectors)), 0, None, -1)

    def _distances(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((self.lifted[rows] - self.lifted[to]) ** 2).sum(axis=1))

    def _grow(self, rows: np.ndarray, routing: int, above: int | None, parent: int) -> None:
        far = self._distances(rows, routing)
        page = len(self.pages)
        leaf = len(rows) <= LEAF_ROWS or float(far.max()) == 0.0
        self.pages.append(
            {
                "_block": self.block,
                "page": page,
                "parent": parent,
                "leaf": leaf,
                "length": self.longest,
                "routing": self.lifted[routing].tobytes(),
                "radius": float(far.max()),
                "parent_distance": 0.0 if above is None else float(self._distances(np.array([routing]), above)[0]),
                "vectors": self.vectors[rows].tobytes() if leaf else None,
                "distances": far.tobytes() if leaf else None,
                "ids": [self.ids[i] for i in rows.tolist()] if leaf else None,
            }
        )
        if leaf:
            return
        chosen, nearest = [routing], far
        owner = np.zeros(len(rows), np.int64)
        for n in range(1, FANOUT):
            pick = int(np.argmax(nearest))
            if nearest[pick] == 0.0:
                break
            chosen.append(int(rows[pick]))
            away = self._distances(rows, chosen[-1])
            owner = np.where(away < nearest, n, owner)
            nearest = np.minimum(away, nearest)
        for n, object_ in enumerate(chosen):
            self._grow(rows[owner == n], object_, routing, page)


class _Tree:
    """Pages read back for searching."""

    def __init__(self, pages: list[dict], size: int):
        self.pages = sorted(pages, key=lambda p: p["page"])
        self.longest = self.pages[0]["length"]
        children: dict[int, list[int]] = {}
        for p in self.pages:
            children.setdefault(p["parent"], []).append(p["page"])
        self.routing = np.array([np.frombuffer(p["routing"]) for p in self.pages])
        self.radius = np.array([p["radius"] for p in self.pages])
        self.parent_distance = np.array([p["parent_distance"] for p in self.pages])
        self.children = {k: np.array(v) for k, v in children.items()}
        self.leaves = {
            p["page"]: (
                np.frombuffer(p["vectors"], np.int64).reshape(len(p["ids"]), size),  # an empty vector is one
                np.frombuffer(p["distances"]),
                p["ids"],
            )
            for p in self.pages
            if p["leaf"]
        }

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, -id) of all vectors but those of the id ``own``."""
        lifted = np.append(query.astype(np.float64), 0.0)
        total = float(lifted @ lifted) + self.longest
        slack = 1e-9 * (total + 1.0)  # bounds are floating point, scores are exact
        best: list[tuple[int, int]] = []
        first = math.sqrt(float(((self.routing[0] - lifted) ** 2).sum()))
        queue = [(-math.inf, 0, first)]
        while queue:
            bound, page, distance = heapq.heappop(queue)
            full = len(best) == k
            if full and -bound < best[0][0]:
                break
            reach = math.sqrt(max(0.0, total - 2.0 * best[0][0]) + slack) if full else math.inf
            if page in self.leaves:
                vectors, distances, ids = self.leaves[page]
                near = np.flatnonzero(np.abs(distance - distances) <= reach)
                scores = vectors[near] @ query
                if full:
                    good = scores >= best[0][0]
                    near, scores = near[good], scores[good]
                for i, score in zip(near.tolist(), scores.tolist()):
                    for id_ in ids[i]:
                        if id_ == own:
                            continue
                        if len(best) < k:
                            heapq.heappush(best, (score, -id_))
                        elif (score, -id_) > best[0]:
                            heapq.heapreplace(best, (score, -id_))
                continue
            pages = self.children[page]
            pages = pages[np.abs(distance - self.parent_distance[pages]) - self.radius[pages] <= reach]
            away = np.sqrt(((self.routing[pages] - lifted) ** 2).sum(axis=1))
            close = np.maximum(0.0, away - self.radius[pages])
            bounds = (total - close * close + slack) / 2.0
            for p, b, d in zip(pages.tolist(), bounds.tolist(), away.tolist()):
                if not full or b >= best[0][0]:
                    heapq.heappush(queue, (-b, p, d))
        return best


def _vectors(df: DataFrame, id_: str, vector: str, factor: int) -> DataFrame:
    whole = scaled(F.col(vector), factor)
    return df.where(F.col(id_).isNotNull() & finite(F.col(vector))).select(
        F.col(id_).cast("bigint").alias("_id"), whole.alias("_vector")
    ).distinct()


def build_index(df: DataFrame, id_: str, vector: str, k: int, factor: int = SCALE) -> DataFrame:
    """Trees over all vectors, one row per page, written to the shared folder.

    Equal vectors are one entry with their k + 1 smallest ids: no search returns more of them, as
    ties go to smaller ids. A vector that a third of all rows share is one entry.
    """
    vectors = _vectors(df, id_, vector, factor)
    place = F.row_number().over(Window.partitionBy("_vector").orderBy("_id"))
    few = vectors.withColumn("_place", place).where(F.col("_place") <= k + 1)
    entries = few.groupBy("_vector").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    entries = materialize(entries, "vectors")
    blocks = max(1, math.ceil(entries.count() / BLOCK_ROWS))
    dealt = entries.withColumn("_part", F.pmod(F.xxhash64("_vector"), F.lit(blocks)))
    dealt = dealt.withColumn("_size", F.size("_vector"))

    def build(part: pa.Table) -> pa.Table:
        size = part["_size"][0].as_py()
        flat = part["_vector"].combine_chunks().flatten().to_numpy()
        block = part["_part"][0].as_py() + size * blocks
        pages = _Build(flat.reshape(part.num_rows, size), part["_ids"].to_pylist(), block).pages
        return pa.Table.from_pylist(pages, schema=_page_schema())

    pages = dealt.groupBy("_size", "_part").applyInArrow(build, _PAGE)
    return materialize(pages.repartition("_block"), "vector-pages")


def _page_schema() -> pa.Schema:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "boolean": pa.bool_(),
        "double": pa.float64(),
        "binary": pa.binary(),
        "array<array<bigint>>": pa.list_(pa.list_(pa.int64())),
    }
    return pa.schema([(n, kinds[t]) for n, t in (c.split(" ") for c in _PAGE.split(", "))])


def top_k(
    queries: DataFrame,
    df: DataFrame,
    id_: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    factor: int = SCALE,
) -> DataFrame:
    """The k largest integer inner products of every query: ``query_id, rank, vec_id, score``.

    Components count as floor(factor * x). Rows of the query's own id are no candidates; ties go to
    the smaller id. Vectors (or ids) that are null, or hold a null or non-finite component, take no
    part; vectors meet only vectors of their own number of components. Repeated rows count once.
    A query without candidates gives no row.

    Each query visits each tree once, in blocks of queries against pages of one tree.
    """
    pages = build_index(df, id_, vector, k, factor)
    asked = materialize(_vectors(queries, id_, vector, factor), "vector-queries")
    parts = max(1, math.ceil(asked.count() / QUERY_ROWS))
    trees = pages.where("page = 0").select("_block", (F.octet_length("routing") / 8 - 1).cast("int").alias("_size"))
    asked = asked.withColumn("_size", F.size("_vector")).withColumn(
        "_part", F.pmod(F.xxhash64("_id", "_vector"), F.lit(parts))
    )
    # One row per tree and number of components: the list of trees is as short as the index is paged.
    lists = trees.groupBy("_size").agg(F.collect_list("_block").alias("_blocks"))
    asked = asked.join(lists, "_size").select("_id", "_vector", "_part", F.explode("_blocks").alias("_block"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    served = pages.withColumn("_part", F.explode(numbers))

    def search(tree: pa.Table, wanted: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if tree.num_rows and wanted.num_rows:
            ids = wanted["_id"].to_pylist()
            vectors = wanted["_vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            index = _Tree(tree.to_pylist(), vectors.shape[1])
            for own, query in zip(ids, vectors):
                found += [(own, -id_, score) for score, id_ in index.search(query, own, k)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), columns)})

    met = served.groupBy("_block", "_part").cogroup(asked.groupBy("_block", "_part"))
    found = met.applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_metric_search(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best of all vectors for every hundredth one."""
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors.where("vec_id % 100 = 0"), vectors)


QUERY = op4_metric_search
ORACLE = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
