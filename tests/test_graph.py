"""Graph algorithms on a small graph with known answers.

Two triangles joined by a bridge, a self-loop, a repeated edge and an isolated vertex.
"""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallygraph.graph import components, labels, messages, model, pagerank, paths, slots, triangles
from tallygraph.graph.slots import bucketed, slotted
from tallygraph.queries import QUERIES
from tallygraph.storage import materialize

EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (7, 7), (1, 2)]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "src BIGINT, dst BIGINT")


@pytest.fixture
def vertices(spark):
    return spark.range(1, 9)


def test_edge_list_and_links(spark, rows, tmp_path):
    (tmp_path / "g.txt").write_text("# comment\n2 1\n1\t3\n\n2 1\n")
    path = f"{tmp_path}/g.txt"
    assert rows(model.edge_list(spark, path)) == [(1, 3), (2, 1), (2, 1)]
    assert rows(model.edge_list(spark, path, canonical=True)) == [(1, 2), (1, 2), (1, 3)]
    (tmp_path / "l.txt").write_text("a b\na b\nb   c\n")
    assert rows(model.link_pairs(spark, f"{tmp_path}/l.txt")) == [("a", "b"), ("b", "c")]


def test_degrees(edges, vertices, rows):
    assert dict(rows(model.degrees(vertices, edges))) == {1: 3, 2: 3, 3: 3, 4: 3, 5: 2, 6: 2, 7: 2, 8: 0}
    assert dict(rows(model.degree_histogram(vertices, edges))) == {0: 1, 2: 3, 3: 4}


def test_triangles(edges, vertices, rows):
    counts = triangles.triangle_count(edges, vertices)
    assert dict(rows(counts)) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 0, 8: 0}
    assert rows(triangles.triangle_total(counts)) == [(2,)]


def test_triangles_of_a_hub(spark):
    wheel = [(0, i) for i in range(1, 9)] + [(i, i % 8 + 1) for i in range(1, 9)]
    counts = triangles.triangle_count(spark.createDataFrame(wheel, "src BIGINT, dst BIGINT"))
    assert {r["id"]: r["triangles"] for r in counts.collect()} == {0: 8, **{i: 2 for i in range(1, 9)}}


def test_triangles_send_a_list_once_to_a_cell(spark, monkeypatch):
    """Vertices 100 to 119 are joined to one another and to all of 0 to 99: few lists, many edges."""
    sent = {}

    def counted(df, label):
        table = materialize(df, label)
        sent[label] = table.count()
        return table

    monkeypatch.setattr(triangles, "materialize", counted)
    monkeypatch.setattr(triangles, "EDGES_PER_CELL", 400)
    hubs = [(a, b) for a in range(100, 120) for b in range(a + 1, 120)]
    graph = hubs + [(v, h) for v in range(100) for h in range(100, 120)]
    counts = triangles.triangle_count(spark.createDataFrame(graph, "src BIGINT, dst BIGINT"))
    found = {r["id"]: r["triangles"] for r in counts.collect()}
    assert found == {v: 190 if v < 100 else 171 + 100 * 19 for v in range(120)}
    assert sent["pointed-edges"] == len(graph)
    assert sent["sent-successors"] < len(graph) / 10


def test_components(edges, vertices, rows):
    found = components.connected_components(edges, vertices)
    assert dict(rows(found)) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 7, 8: 8}
    assert rows(components.component_count(found)) == [(3,)]


def test_components_of_a_long_path(spark):
    path = spark.range(1, 200).selectExpr("id AS src", "id + 1 AS dst")
    found = components.connected_components(path)
    assert found.count() == 200
    assert found.where("component != 1").count() == 0


def test_components_without_edges(spark, vertices, rows):
    none = spark.createDataFrame([], "src BIGINT, dst BIGINT")
    assert components.connected_components(none).isEmpty()
    assert dict(rows(components.connected_components(none, vertices))) == {i: i for i in range(1, 9)}


def test_shortest_paths(edges, vertices, rows):
    found = paths.shortest_paths(vertices, edges, 1, F.lit(2))
    inf = float("inf")
    assert dict(rows(found)) == {1: 0, 2: 2, 3: 4, 4: 6, 5: 8, 6: 10, 7: inf, 8: inf}


def test_closure(edges, rows):
    left, right = (1, 2, 3), (4, 5, 6)
    want = set(itertools.product(left, left + right)) | set(itertools.product(right, right)) | {(7, 7)}
    everyone = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    found = paths.transitive_closure(edges, everyone)
    assert rows(found) == sorted(want)
    assert rows(paths.transitive_closure(found, everyone)) == sorted(want)
    from_three = everyone.where("id IN (3, 99)")
    assert rows(paths.transitive_closure(edges, from_three)) == sorted(p for p in want if p[0] == 3)


def test_closure_holds_starts_together(spark, rows, monkeypatch):
    """Working rows hold up to 64 starts: there are far fewer than pairs of a start and a vertex."""
    written = []

    def counted(df, label):
        table = materialize(df, label)
        written.append((label, table.count()))
        return table

    monkeypatch.setattr(paths, "materialize", counted)
    layered = [(s, m) for s in range(100) for m in range(1000, 1020)]
    layered += [(m, t) for m in range(1000, 1020) for t in range(2000, 2030)] + [(2000, 3000), (3000, 2000)]
    starts = spark.createDataFrame([(s,) for s in [*range(100), 5, None, 7000]], "id BIGINT")
    found = paths.transitive_closure(spark.createDataFrame(layered, "src BIGINT, dst BIGINT"), starts)
    ends = [*range(1000, 1020), *range(2000, 2030), 3000]
    assert rows(found) == sorted(((s, v) for s in range(100) for v in ends), key=repr)
    assert sum(n for label, n in written if label != "steps") < 100 * len(ends) / 10


def test_closure_of_many_starts(spark, rows, monkeypatch):
    """1,500 starts share few rows, and edges to vertices that have none are walked once, at the end."""
    written = []

    def counted(df, label):
        table = materialize(df, label)
        written.append((label, table.count()))
        return table

    monkeypatch.setattr(paths, "materialize", counted)
    wide = [(s, 5000 + s % 7) for s in range(1500)] + [(5000 + i, 5000 + i + 1) for i in range(7)]
    wide += [(5000 + i, 9000 + 10 * i + j) for i in range(8) for j in range(10)] + [(5003, 5001), (7777, 8888), (7777, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = rows(paths.transitive_closure(spark.createDataFrame(wide, "src BIGINT, dst BIGINT")))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    onward = {}
    for s, d in wide:
        onward.setdefault(s, set()).add(d)
    want = set()
    for s in onward:
        ends, more = set(), onward[s]
        while more:
            ends |= more
            more = set().union(*(onward.get(v, set()) for v in more)) - ends
        want |= {(s, v) for v in ends}
    assert found == sorted(want, key=repr)
    assert max(n for label, n in written if label.endswith("-bits") and label != "start-bits") <= 2 * 88


def test_closure_query_starts_anywhere(spark, rows, tmp_path):
    """Pairs from every supplier, also one of another nation and one that the supplier table lacks."""
    lines = spark.createDataFrame([(1, 2), (2, 9), (3, 1), (3, 3), (5, None), (None, 6), (1, 2)], "l_suppkey BIGINT, l_partkey BIGINT")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers = spark.createDataFrame([(1, 7), (2, 4)], "s_suppkey BIGINT, s_nationkey INT")
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    assert rows(QUERIES["transitive_closure"](spark, str(tmp_path))) == [(1, 2), (1, 9), (2, 9), (3, 1), (3, 2), (3, 9)]


def _pagerank(edge_list, ids, rounds, keep_all):
    out = Counter(s for s, _ in edge_list)
    rank = {v: 1.0 for v in (ids if keep_all else out)}
    for _ in range(rounds):
        sums = Counter()
        for s, d in edge_list:
            if s in rank:
                sums[d] += rank[s] / out[s]
        rank = {v: 0.15 + 0.85 * sums[v] for v in (ids if keep_all else sums)}
    if keep_all:
        scale = len(rank) / sum(rank.values())
        rank = {v: r * scale for v, r in rank.items()}
    return rank


@pytest.mark.parametrize("edges_per_slot", [1_000_000, 1])
def test_pagerank(edges, vertices, edges_per_slot):
    got = pagerank.pagerank_static(edges, 7, vertices, rounds_per_plan=3, edges_per_slot=edges_per_slot)
    got = {r["id"]: r["rank"] for r in got.collect()}
    assert got == pytest.approx(_pagerank(EDGES, range(1, 9), 7, True))
    assert sum(got.values()) == pytest.approx(8)
    links = pagerank.pagerank_links(edges, 4, rounds_per_plan=3, edges_per_slot=edges_per_slot)
    assert {r["id"]: r["rank"] for r in links.collect()} == pytest.approx(_pagerank(sorted(set(EDGES)), None, 4, False))


def test_pages_without_links_drop_out(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "src STRING, dst STRING")
    assert {r["id"] for r in pagerank.pagerank_links(links, 3).collect()} == {"b", "c"}


def test_pagerank_to_tolerance(edges, vertices):
    found = pagerank.pagerank_until(edges, 1e-8, vertices)
    want = _pagerank(EDGES, range(1, 9), 300, True)
    assert {r["id"]: r["rank"] for r in found.collect()} == pytest.approx(want, abs=1e-5)


def _labels(edge_list, rounds):
    label = {v: v for e in edge_list for v in e}
    for _ in range(rounds):
        votes = {v: Counter() for v in label}
        for s, d in edge_list:
            votes[s][label[d]] += 1
            votes[d][label[s]] += 1
        label = {v: min(c, key=lambda x: (-c[x], x)) for v, c in votes.items()}
    return label


@pytest.mark.parametrize("edges_per_slot", [1_000_000, 2])
def test_label_propagation(edges, rows, edges_per_slot):
    got = labels.label_propagation(edges, 5, rounds_per_plan=2, edges_per_slot=edges_per_slot)
    assert dict(rows(got)) == _labels(EDGES, 5)


def test_label_propagation_deals_edges_by_their_number(spark, rows, monkeypatch):
    """Few compressed bytes do not put all edges into a few tasks."""
    monkeypatch.setattr(slots, "EDGES_PER_TASK", 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    chain = [(i, i + 1) for i in range(200)]
    got = labels.label_propagation(spark.createDataFrame(chain, "src BIGINT, dst BIGINT"), 3, rounds_per_plan=2)
    assert got.rdd.getNumPartitions() == 20
    assert dict(rows(got)) == _labels(chain, 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_slotted_join_keeps_every_edge(spark, rows):
    star = spark.createDataFrame([(0, i) for i in range(50)] + [(1, 2)], "src BIGINT, dst BIGINT")
    dealt = slotted(star, "src", edges_per_slot=10)
    assert dealt.hubs.count() == 1
    assert dealt.edges.where("src = 0").select("_slot").distinct().count() > 1
    state = spark.createDataFrame([(0, "hub"), (1, "leaf")], "id BIGINT, name STRING")
    assert rows(dealt.join(state), "src", "dst", "name") == sorted(
        [(0, i, "hub") for i in range(50)] + [(1, 2, "leaf")], key=repr
    )


def test_older_followers(edges, vertices, rows):
    people = vertices.withColumn("age", F.col("id").cast("double"))
    got = messages.aggregate_messages(
        people, edges, F.col("src_age") > F.col("dst_age"), {"n": F.count(F.lit(1)), "mean": F.avg("src_age")}
    )
    assert rows(got) == [(1, 1, 3.0), (4, 1, 6.0)]


def test_pregel_with_both_ends(spark, rows):
    """Largest value spreads, only to vertices that have a smaller one."""
    vertices = spark.createDataFrame([(1, 9), (2, 1), (3, 4)], "id BIGINT, v INT")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "src BIGINT, dst BIGINT")
    got = messages.pregel(
        vertices, edges, {"m": F.col("src_v")}, {"m": F.max("m")}, {"v": F.greatest("v", "m")},
        F.col("m") > F.col("v"), send_when=F.col("src_v") > F.col("dst_v"), use_dst=True,
    )
    assert rows(got) == [(1, 9), (2, 9), (3, 9)]


def test_pregel_never_returns_an_unfinished_result(spark):
    vertices = spark.range(6).selectExpr("id", "IF(id = 0, 1, 0) AS v")
    edges = spark.range(5).selectExpr("id AS src", "id + 1 AS dst")
    spread = dict(send={"m": F.col("src_v")}, merge={"m": F.max("m")}, update={"v": F.greatest("v", "m")})
    with pytest.raises(RuntimeError, match="active"):
        messages.pregel(vertices, edges, **spread, changed=F.col("m") > F.col("v"), max_rounds=2)
    found = messages.pregel(vertices, edges, **spread, changed=F.col("m") > F.col("v"), max_rounds=7)
    assert found.where("v = 1").count() == 6


def test_subgraph_and_attributes(edges, vertices, rows):
    named = model.with_attributes(vertices, vertices.where("id < 4").withColumn("name", F.lit("n")), {"name": ""})
    kept, inner = model.subgraph(named, edges, F.col("name") != "")
    assert rows(kept.select("id")) == [(1,), (2,), (3,)]
    assert rows(inner) == [(1, 2), (1, 2), (2, 3), (3, 1)]


def _split(df):
    """Run a frame and tell whether a join of its final plan was split for skew."""
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def low_limits(spark):
    """Skew limits that small tables reach, several map tasks and no broadcasts."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_edges_of_a_hub_are_split(spark, low_limits):
    hub = spark.range(0, 60000, 1, 12).selectExpr("id AS src", "IF(id % 10 = 0, id % 97, 7L) AS dst")
    assert _split(model.in_neighbours(hub, 2, 1_000_000, distinct=False))
    people = model.vertices_of(hub.selectExpr("dst AS src", "src AS dst")).withColumn("age", F.col("id"))
    counts = {"n": F.count(F.lit(1)), "sum": F.sum("src_age")}
    assert _split(messages.aggregate_messages(people, hub, F.col("src_age") > F.col("dst_age"), counts))


def test_in_neighbours(edges, rows):
    assert rows(model.in_neighbours(edges, 1, 5)) == [(4, 2, [3, 6])]
    assert rows(model.in_neighbours(edges, 1, 5, distinct=False)) == [(2, 2, [1, 1]), (4, 2, [3, 6])]


@pytest.mark.parametrize("strategy", ["1d", "2d", "random", "canonical"])
def test_edge_partitioning(spark, strategy):
    edges = spark.range(2000).selectExpr("id % 50 AS src", "id % 37 AS dst")
    laid = model.partition_edges(edges, strategy, 9).withColumn("p", F.spark_partition_id())
    assert laid.count() == 2000
    per_src = laid.groupBy("src").agg(F.count_distinct("p").alias("n")).agg(F.max("n")).first()[0]
    if strategy == "1d":
        assert per_src == 1
    if strategy == "2d":
        assert per_src <= 3
    if strategy == "canonical":
        ends = laid.groupBy(F.least("src", "dst"), F.greatest("src", "dst")).agg(F.count_distinct("p").alias("n"))
        assert ends.where("n > 1").count() == 0


def test_unknown_partitioning(edges):
    with pytest.raises(ValueError):
        model.partition_edges(edges, "3d", 4)


@pytest.mark.parametrize("edges_per_slot", [1_000_000, 40])
def test_pregel_moves_the_frontier_to_the_edges(spark, rows, edges_per_slot):
    """One round: the state is exchanged, the bucketed edges are not; a hub fills several buckets."""
    hub = spark.range(300).selectExpr("0L AS src", "id + 1 AS dst", "1 AS w")
    chain = spark.range(1, 300).selectExpr("id AS src", "id + 1 AS dst", "CAST(NULL AS INT) AS w")
    laid = bucketed(slotted(hub.unionByName(chain), "src", edges_per_slot, present=["src", "dst"]))
    assert (laid.hubs is not None) == (edges_per_slot == 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = spark.range(300).withColumn("v", F.lit(1))
        joined = laid.join(state)
        assert joined.count() == 599
        scan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, below = scan.split("edges_", 1)
    assert "Bucketed: true" in below
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = (above + "edges_").splitlines()
    level = depth(lines[-1])
    for line in reversed(lines):
        if depth(line) < level:
            level = depth(line)
            assert "Exchange" not in line
    if laid.hubs is not None:
        assert max(r["count"] for r in laid.edges.where("src = 0").groupBy("_slot").count().collect()) < 100
    laid.drop()
    assert not spark.catalog.tableExists(laid.table)


def test_pregel_with_a_hub_and_null_weights(spark, rows):
    """Edges in slots give the distances of edges without; a null weight makes no offer, but stays an edge."""
    pairs = [(0, i, float(i % 7 + 1)) for i in range(1, 200)] + [(i, i + 1, 0.5) for i in range(1, 210)]
    pairs += [(210, 211, None), (None, 5, 1.0), (5, None, 1.0)]
    edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT, w DOUBLE")
    vertices = spark.range(213)
    want = rows(paths.shortest_paths(vertices, edges, 0, F.col("w")))
    assert dict(want)[211] == dict(want)[212] == float("inf") and dict(want)[0] == 0.0
    degree = dict(send={"m": F.lit(1)}, merge={"m": F.count("m")}, update={"n": F.coalesce("m", F.lit(0))}, changed=F.lit(False))
    got = messages.pregel(vertices.withColumn("n", F.lit(0)), edges, **degree, edges_per_slot=20)
    assert rows(got.where("id = 211")) == [(211, 1)]
    best = {i: float("inf") for i in range(213)} | {0: 0.0}
    for _ in range(213):
        for s, d, w in pairs:
            if None not in (s, d, w):
                best[d] = min(best[d], best[s] + w)
    assert dict(want) == best


def test_pagerank_ends_for_a_tolerance_below_rounding(spark, rows):
    """Either no rank moves at all any more, or moves stop shrinking, which is an error."""
    pairs = [(i, (i * 7 + j) % 20) for i in range(20) for j in range(1, 4) if i % 3]
    edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
    try:
        ranks = dict(rows(pagerank.pagerank_until(edges, 1e-300)))
    except ValueError as stuck:
        assert "rounding" in str(stuck)
    else:
        assert ranks == pytest.approx(dict(rows(pagerank.pagerank_until(edges, 1e-12))))
