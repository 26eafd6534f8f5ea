import itertools
import random
from collections import defaultdict, deque

import numpy as np
import pytest
from pyspark.sql import functions as F
from row_helpers import by

from wharfline.operators import network


def graph(spark, pairs):
    return spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src string, dst string, weight double")


def searched(pairs, directed):
    """Betweenness, closeness and distances by a plain search from every node."""
    near = defaultdict(set)
    for a, b in pairs:
        if a != b:
            near[a].add(b)
            if not directed:
                near[b].add(a)
    nodes = sorted({x for p in pairs for x in p})
    through, dist = dict.fromkeys(nodes, 0.0), {}
    for s in nodes:
        depth, count, before, order, queue = {s: 0}, defaultdict(float, {s: 1.0}), defaultdict(list), [], deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in depth:
                    depth[w] = depth[v] + 1
                    queue.append(w)
                if depth[w] == depth[v] + 1:
                    count[w] += count[v]
                    before[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += count[v] / count[w] * (1 + delta[w])
            if w != s:
                through[w] += delta[w]
        dist[s] = depth
    n = len(nodes)
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    closeness = {}
    for u in nodes:
        into = [dist[v][u] for v in nodes if v != u and u in dist[v]]
        closeness[u] = (len(into) / sum(into)) * len(into) / (n - 1) if into else 0.0
    return {v: through[v] * scale for v in nodes}, closeness


def random_pairs(n, m, seed):
    pick = random.Random(seed)
    return sorted({(f"n{pick.randrange(n):02d}", f"n{pick.randrange(n):02d}") for _ in range(m)})


GRAPHS = {
    "path": [("a", "b"), ("b", "c"), ("c", "d")],
    "star": [("h", x) for x in "abcde"],
    "cycle": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")],
    "pair": [("a", "b")],
    "random": random_pairs(20, 45, 2),
}


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("directed", [True, False])
def test_path_metrics(spark, name, directed):
    between, close = searched(GRAPHS[name], directed)
    rows = by(network.path_metrics(graph(spark, GRAPHS[name]), directed))
    assert {r["node"] for r in rows} == set(between)
    for r in rows:
        assert r["betweenness"] == pytest.approx(between[r["node"]], abs=1e-9)
        assert r["closeness"] == pytest.approx(close[r["node"]], abs=1e-9)


def test_rounds_of_sources_change_nothing(spark):
    edges = graph(spark, GRAPHS["random"])
    once = by(network.path_metrics(edges), "node")
    split = by(network.path_metrics(edges, pairs_per_round=150), "node")
    for a, b in zip(once, split):
        assert a["node"] == b["node"] and a["betweenness"] == pytest.approx(b["betweenness"])
        assert a["closeness"] == pytest.approx(b["closeness"])


def test_path_search_ends_after_its_rounds(spark, monkeypatch):
    search, calls = network._search, []

    def counted(hops, sources):
        calls.append(1)
        assert len(calls) <= 3, "searches on after the last round"
        return search(hops, sources)

    monkeypatch.setattr(network, "_search", counted)
    edges = graph(spark, GRAPHS["cycle"])
    assert network.path_metrics(edges).count() == 4 and len(calls) == 1
    calls.clear()
    assert network.path_metrics(edges, pairs_per_round=6).count() == 4 and len(calls) == 3


def test_average_path_needs_strong_connection(spark):
    ring = network.average_path_length(network.path_metrics(graph(spark, GRAPHS["cycle"]))).first()
    assert ring["strongly_connected"] and ring["average_path_length"] == pytest.approx(2.0)
    path = network.average_path_length(network.path_metrics(graph(spark, GRAPHS["path"]))).first()
    assert not path["strongly_connected"] and path["average_path_length"] is None


def test_components(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    pairs = chain + [("x", "y"), ("y", "z"), ("z", "x"), ("s", "s")] + random_pairs(30, 20, 9)
    parent = {v: v for p in pairs for v in p}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    rows = by(network.components(graph(spark, pairs)))
    assert {r["node"]: r["component"] for r in rows} == {v: root(v) for v in parent}
    alone = spark.createDataFrame([("x",), ("lonely",)], "node string")
    labels = {r["node"]: r["component"] for r in by(network.components(graph(spark, [("x", "y")]), alone))}
    assert labels == {"x": "x", "lonely": "lonely"}


def test_eigenvector(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "a")]
    names = "abcd"
    m = np.zeros((4, 4))
    for a, b in pairs:
        m[names.index(b), names.index(a)] = 1
    values, vectors = np.linalg.eig(m)
    lead = np.abs(vectors[:, np.argmax(values.real)].real)
    rows = by(network.eigenvector_centrality(graph(spark, pairs)), "node")
    assert all(r["converged"] for r in rows)
    np.testing.assert_allclose([r["eigenvector"] for r in rows], lead / np.linalg.norm(lead), atol=1e-4)
    open_end = by(network.eigenvector_centrality(graph(spark, GRAPHS["path"]), max_iter=6))
    assert not any(r["converged"] for r in open_end)


def test_planted_communities(spark):
    left, right = [f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]
    pairs = [*itertools.combinations(left, 2), *itertools.combinations(right, 2), ("a0", "b0")]
    rows = by(network.communities(graph(spark, pairs)))
    groups = defaultdict(set)
    for r in rows:
        groups[r["community"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [left, right]
    assert rows[0]["modularity"] == pytest.approx(30 / 31 - 0.5, abs=1e-6)


def test_repeated_edges_keep_the_last_row(spark):
    rows = [("a", "b", 1.0, 1), ("a", "b", 9.0, 2), ("b", "a", 5.0, 3), ("a", "b", 4.0, 0)]
    df = spark.createDataFrame(rows, "s string, t string, w double, at int")
    directed = by(network.build_edges(df, "s", "t", "w", order=["at"]), "src")
    assert [(r["src"], r["dst"], r["weight"]) for r in directed] == [("a", "b", 9.0), ("b", "a", 5.0)]
    plain = by(network.build_edges(df, "s", "t", "w", order=["at"], directed=False))
    assert [(r["src"], r["dst"], r["weight"]) for r in plain] == [("a", "b", 5.0)]


def test_features_and_degrees(spark):
    df = spark.createDataFrame([("s1", "d1", 2.0), ("s1", "d1", 3.0), ("s2", "d1", 1.0)], "s string, t string, q double")
    rows = by(network.network_features(df, "s", "t", "q"), "s", "q")
    assert len(rows) == 3 and rows[0]["s_out_degree"] == 1 and rows[0]["s_weighted_out"] == 5.0
    assert rows[0]["t_in_degree"] == 2 and rows[0]["t_weighted_in"] == 6.0 and rows[0]["t_closeness"] == pytest.approx(1.0)
    loop = {r["node"]: r for r in by(network.degrees(graph(spark, [("a", "a"), ("a", "b")])))}
    assert (loop["a"]["degree"], loop["b"]["degree"]) == (3, 1)


def test_critical_nodes_and_resilience(spark):
    edges = graph(spark, [("h", x) for x in "abcde"] + [("a", "h"), ("b", "h")])
    critical = network.critical_nodes(network.centrality_metrics(edges, eigenvector=False), 2)
    assert critical.count() == 10
    consensus = {r["node"]: r["votes"] for r in by(network.consensus_nodes(critical))}
    assert consensus["h"] == 5
    hub = spark.createDataFrame([("h",)], "node string")
    row = network.resilience(edges, removed=hub).first()
    assert row["node_loss_percentage"] == pytest.approx(100 / 6) and row["edge_loss_percentage"] == 100.0
    assert row["fragmentation_increase"] == 4 and row["nodes_removed"] == ["h"]


def test_density_and_clustering(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")]
    assert network.density(graph(spark, pairs)).first()["density"] == pytest.approx(4 / 12)
    rows = {r["node"]: r for r in by(network.clustering(graph(spark, pairs)))}
    assert rows["a"]["clustering"] == 1.0 and rows["c"]["clustering"] == pytest.approx(1 / 3) and rows["d"]["clustering"] == 0.0
    assert rows["c"]["triangles"] == 1


def test_lane_queries_cover_all_lanes(spark, tmp_path):
    """Every lane query is also registered over the lanes that are not heavier than the mean."""
    from wharfline.plans import network_queries, registered
    from wharfline.sources import views

    names = [n.removeprefix("busy_") for n in registered.queries() if n.startswith("busy_")]
    assert len(names) == 10 and {f"whole_{n}" for n in names} <= set(registered.queries())
    with_sql = {n for n in names if f"busy_{n}" in registered.oracle_sql()}
    assert {f"whole_{n}" for n in with_sql} <= set(registered.oracle_sql())
    rows = {
        "nation": [(i,) for i in range(3)],
        "customer": [(i, i) for i in range(3)],
        "supplier": [(i, i) for i in range(3)],
        "orders": [(i, i) for i in range(3)],
        "lineitem": [(o, s, 1.0 + 10 * o) for o in range(3) for s in range(3)],
    }
    columns = {
        "nation": "n_nationkey int", "customer": "c_custkey int, c_nationkey int", "supplier": "s_suppkey int, s_nationkey int",
        "orders": "o_orderkey int, o_custkey int", "lineitem": "l_orderkey int, l_suppkey int, l_quantity double",
    }
    for name in rows:
        spark.createDataFrame(rows[name], columns[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    assert views.trade_lanes(spark, str(tmp_path)).count() == 6
    assert registered.queries()["whole_lane_density"](spark, str(tmp_path)).first()["density"] == 1.0
    assert 0 < network_queries.lanes(spark, str(tmp_path)).count() < 6


def test_search_levels_shuffle_only_their_frontier(spark):
    """Nodes reached before are read where they are stored: no exchange below their union."""
    edges = spark.createDataFrame([(f"n{i}", f"n{(i * 7 + k) % 40}") for i in range(40) for k in range(1, 4)], "src string, dst string")
    hops = network._hops(edges, True)
    plans, stored = [], network.durable
    network.durable = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df)
    try:
        levels = network._search(hops, network.node_set(edges))
    finally:
        network.durable = stored
    assert len(levels) > 3
    for plan in plans[2:]:  # after the start and the first level
        after_union = plan[plan.index("Union") :]
        assert "Exchange" not in after_union and plan.count("Exchange") == 2, plan
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_rounds_follow_the_pairs_within_reach(spark, monkeypatch):
    """Many sources that reach few nodes are one search, however many pairs of nodes there are."""
    pairs = [(f"S{i}", f"N{i % 3}") for i in range(60)] + [(f"N{i}", f"R{j}") for i in range(3) for j in range(2)]
    edges, search, calls = graph(spark, pairs), network._search, []
    monkeypatch.setattr(network, "_search", lambda hops, sources: calls.append(1) or search(hops, sources))
    between, close = searched(pairs, True)
    rows = by(network.path_metrics(edges, pairs_per_round=400), "node")
    assert len(rows) == 65 and len(calls) == 1
    for r in rows:
        assert r["betweenness"] == pytest.approx(between[r["node"]]) and r["closeness"] == pytest.approx(close[r["node"]])
    hops, nodes = network._hops(edges, True), network.node_set(edges)
    assert network._pair_bound(hops, nodes, nodes, 65) == 60 * 4 + 3 * 3 + 2
    ring = graph(spark, [(f"n{i}", f"n{(i + 1) % 50}") for i in range(50)])
    assert network._pair_bound(network._hops(ring, True), network.node_set(ring), network.node_set(ring), 50) == 2500


def test_supply_edges_are_computed_once(spark, monkeypatch):
    from wharfline.plans import network_queries

    runs = spark.sparkContext.accumulator(0)

    def joined(x):
        runs.add(1)
        return x

    once = F.udf(joined, "string").asNondeterministic()  # not repeated within a plan
    edges = graph(spark, [("S1", "N1"), ("S2", "N1"), ("N1", "R1")]).withColumn("src", once("src"))
    monkeypatch.setattr(network_queries.views, "supply_edges", lambda *_: edges)
    assert network_queries.supply_path_metrics(spark, "").count() == 4
    assert runs.value == 3


def test_components_keep_one_round_and_shuffle_contracted_edges(spark, monkeypatch, tmp_path):
    """Pairs of former rounds are gone, and no task hands on more edges than stars need."""
    place, sizes = str(tmp_path / "pairs"), []
    monkeypatch.setattr(network, "scratch_path", lambda _, name: f"{place}-{len(sizes)}-{name}")
    written = network.stored_at
    monkeypatch.setattr(network, "stored_at", lambda df, path: sizes.append(0) or written(df, path))
    pairs = [(f"O{i}", f"P{(i * k) % 37}") for i in range(200) for k in (1, 2, 3)] + [("x", "y")]
    found = {r["node"]: r["component"] for r in network.components(graph(spark, pairs)).collect()}
    # Multiples of 37 meet in P0 alone, all others in one component.
    assert found == {v: "x" if v in "xy" else "O1" if int(v[1:]) % 37 else "O0" for p in pairs for v in p}
    assert len(sizes) > 2 and not list(tmp_path.iterdir())
    edges = graph(spark, pairs).select("src", "dst").toDF("u", "v").coalesce(1)
    assert network.contracted(edges).count() == len(found) - len(set(found.values())) < len(pairs) / 2
    monkeypatch.setattr(network, "EDGES_AT_ONCE", 7)
    numbers = spark.range(40).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r["component"] for r in network.components(numbers).collect()} == {0}


def test_partitions_follow_the_size_of_the_graph(spark, monkeypatch):
    """A component's rounds use more partitions for more edges, and leave the session as it was."""
    monkeypatch.setattr(network, "ROWS_PER_TASK", 10)
    key, seen, stored = "spark.sql.shuffle.partitions", set(), network.durable
    before = {k: spark.conf.get(k) for k in (key, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    monkeypatch.setattr(network, "durable", lambda df: seen.add(int(spark.conf.get(key))) or stored(df))
    edges = graph(spark, [(f"O{i}", f"P{i % 4}") for i in range(60)] + [("O9", None), ("Q", "Q")])
    found = {r["node"]: r["component"] for r in network.components(edges).collect()}
    assert seen == {13} and {k: spark.conf.get(k) for k in before} == before
    least = [min(f"O{i}" for i in range(60) if i % 4 == k) for k in range(4)]
    assert found == {f"O{i}": least[i % 4] for i in range(60)} | {f"P{k}": least[k] for k in range(4)} | {None: None, "Q": "Q"}
