"""Graph and clustering operators against brute force."""

import itertools
import math
import random
from collections import defaultdict, deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import clustering as CL, graph as G


@pytest.fixture(scope="module")
def g():
    rng = random.Random(4)
    e = {tuple(sorted(rng.sample(range(24), 2))) for _ in range(40)} | {(100, 101)}
    return sorted(e)


@pytest.fixture(scope="module")
def edges(spark, g):
    return spark.createDataFrame(g, "u long, v long")


def adjacency(g):
    a = defaultdict(set)
    for u, v in g:
        a[u].add(v)
        a[v].add(u)
    return a


def bfs(a, s):
    d, q = {s: 0}, deque([s])
    while q:
        x = q.popleft()
        for y in a[x]:
            if y not in d:
                d[y] = d[x] + 1
                q.append(y)
    return d


def test_paths_closeness_betweenness(spark, edges, g):
    a = adjacency(g)
    n = len(a)
    p = G.shortest_paths(edges)
    assert {(r[0], r[1]): r[2] for r in p.collect()} == {(s, t): d for s in a for t, d in bfs(a, s).items()}
    c = {r[0]: r[1] for r in G.closeness(p).collect()}
    for s in a:
        d = bfs(a, s)
        k = len(d) - 1
        assert c[s] == pytest.approx(k / sum(d.values()) * k / (n - 1))
    for words in (1, 16):  # one word a portion: several portions
        sums = {r.node: (r.reached, r.total, r.farthest) for r in G.distance_sums(edges, words=words).collect()}
        assert sums == {s: (len(d) - 1, sum(d.values()), max(d.values())) for s in a for d in [bfs(a, s)]}
    few = sorted(a)[:3]
    sums = {r.node: r.total for r in G.distance_sums(edges, spark.createDataFrame([(s,) for s in few], "source long")).collect()}
    assert sums == {x: sum(bfs(a, s).get(x, 0) for s in few) for x in a}
    assert {r[0]: r[1] for r in G.closeness_from_sums(G.distance_sums(edges)).collect()} == pytest.approx(c)
    want = defaultdict(float)
    for s in a:  # Brandes
        order, pred, sigma, dist = [], defaultdict(list), defaultdict(float), {s: 0}
        sigma[s], q = 1.0, deque([s])
        while q:
            x = q.popleft()
            order.append(x)
            for y in a[x]:
                if y not in dist:
                    dist[y] = dist[x] + 1
                    q.append(y)
                if dist[y] == dist[x] + 1:
                    sigma[y] += sigma[x]
                    pred[y].append(x)
        delta = defaultdict(float)
        for y in reversed(order):
            for x in pred[y]:
                delta[x] += sigma[x] / sigma[y] * (1 + delta[y])
            if y != s:
                want[y] += delta[y]
    for rows in (G.PORTION_ROWS, n * n // 4):
        b = {r[0]: r[1] for r in G.betweenness(edges, portion_rows=rows).collect()}
        for x in a:
            assert b[x] == pytest.approx(want[x] / ((n - 1) * (n - 2)))


def test_bucketed_edges_are_not_shuffled(spark):
    from tallyframe.session import bucketed

    e = spark.range(5000).select((F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    ranks = spark.range(97).select(F.col("id").alias("a"), F.lit(1.0).alias("s")).hint("merge")
    with bucketed(e, "a") as t:
        plan = t.join(ranks, "a")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and t.join(ranks, "a").count() == 5000
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("bucketed_")]


def test_triangles_components(edges, g):
    a = adjacency(g)
    tri = {x: sum(1 for y, z in itertools.combinations(a[x], 2) if z in a[y]) for x in a}
    assert {r["node"]: r["triangles"] for r in G.clustering(edges).collect()} == tri
    comp = {r[0]: r[1] for r in G.connected_components(edges).collect()}
    assert comp == {s: min(bfs(a, s)) for s in a}


def test_components_of_a_long_chain(spark):
    e = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert [tuple(r) for r in G.connected_components(e).groupBy("component").count().collect()] == [(0, 301)]


def test_pagerank_sums_to_one_with_dangling(spark, edges):
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().union(spark.createDataFrame([(999,)], "node long"))
    r = G.pagerank(edges, 100, tol=1e-9, nodes=nodes)
    assert r.agg(F.sum("rank")).first()[0] == pytest.approx(1)
    assert r.where("node = 999").first()["rank"] < r.agg(F.avg("rank")).first()[0]


def test_communities_of_two_cliques(spark):
    e = list(itertools.combinations(range(6), 2)) + list(itertools.combinations(range(10, 16), 2)) + [(5, 10)]
    d = spark.createDataFrame(e, "u long, v long")
    c = G.communities(d)
    groups = defaultdict(set)
    for r in c.collect():
        groups[r["community"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(6)), list(range(10, 16))]
    assert G.modularity(d, c).first()["modularity"] == pytest.approx(30 / 31 - 2 * (31 / 62) ** 2)


def dbscan_reference(pts, eps, k):
    near = {i: [j for j, q in pts.items() if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for i, p in pts.items()}
    core = {i for i in pts if len(near[i]) >= k}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        label[i], q = i, [i]
        while q:
            for j in near[q.pop()]:
                if j in core and j not in label:
                    label[j] = i
                    q.append(j)
    out = {i: label.get(i, -1) for i in pts}
    for i in pts:
        if i not in core:
            c = [label[j] for j in near[i] if j in core]
            out[i] = min(c) if c else -1
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_dbscan_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pts = {}
    for c in ((0, 0), (1.1, 0.2), (3, 3)):
        for _ in range(60):
            pts[len(pts)] = (round(rng.gauss(c[0], 0.3), 3), round(rng.gauss(c[1], 0.3), 3))
    for _ in range(30):
        pts[len(pts)] = (round(rng.uniform(-2, 5), 3), round(rng.uniform(-2, 5), 3))
    for _ in range(200):  # one cell holds most of the points
        pts[len(pts)] = (round(3 + rng.random() * 0.05, 4), round(3 + rng.random() * 0.05, 4))
    d = spark.createDataFrame([(i, *p) for i, p in pts.items()], "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in CL.dbscan(d, "id", "x", "y", 0.3, 5).collect()}
    assert got == dbscan_reference(pts, 0.3, 5)
    assert len(set(got.values())) > 2


def test_dbscan_with_a_crowded_cell(spark):
    """Most points fill one cell; the others lie around it, so that their circles cut through the crowd."""
    rng = np.random.default_rng(4)
    crowd = rng.uniform(0.001, 0.211, (100_000, 2))
    around = np.array([[0.1, 0.35], [0.39, 0.1], [0.45, 0.45], [-0.2, 0.1], [0.1, 0.512], [0.9, 0.9], [0.5105, 0.2]])
    pts = np.vstack([crowd, around])
    d = spark.createDataFrame(pd.DataFrame({"id": range(len(pts)), "x": pts[:, 0], "y": pts[:, 1]}))
    d = d.unionByName(spark.createDataFrame([(-1, None, 0.1), (-2, float("nan"), 0.1), (-3, 0.1, float("inf"))], "id long, x double, y double"))
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in CL.dbscan(d, "id", "x", "y", 0.3, 5).collect()}
    assert len(got) == len(pts) + 3 and all(got[i] == (0, True) for i in range(len(crowd))) and all(got[i] == (-1, False) for i in (-1, -2, -3))
    for k, q in enumerate(around, len(crowd)):
        gap = ((pts - q) ** 2).sum(axis=1)
        core = (gap <= 0.09).sum() >= 5
        near = core or (gap[:len(crowd)] <= 0.09).any() or any(((around[i - len(crowd)] - q) ** 2).sum() <= 0.09 and got[i][1] for i in range(len(crowd), len(pts)))
        assert got[k] == (0 if near else -1, bool(core)), q


def test_within_reach_counts(spark):
    rng = np.random.default_rng(9)
    side, eps = 0.3 / math.sqrt(2), 0.3
    t = np.vstack([rng.uniform(0, side, (3000, 2)), np.full((500, 2), 0.1)])
    q = rng.uniform(-0.3, 0.5, (40, 2))
    targets = spark.createDataFrame(pd.DataFrame({"x": t[:, 0], "y": t[:, 1]})).select(
        F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"), "x", "y")
    points = spark.createDataFrame(pd.DataFrame({"id": range(40), "x": q[:, 0], "y": q[:, 1]})).withColumns(
        {"nx": F.lit(0).cast("long"), "ny": F.lit(0).cast("long")})
    want = {i: int((((t - p) ** 2).sum(axis=1) <= eps * eps).sum()) for i, p in enumerate(q)}
    want = {i: n for i, n in want.items() if n}
    got = {r["id"]: r["k"] for r in CL.within_reach(points, targets, ["id"], eps, side, 10 ** 9).collect()}
    assert got == want
    some = {r["id"]: r["k"] for r in CL.within_reach(points, targets, ["id"], eps, side, 5).collect()}
    assert set(some) == set(want) and all(min(some[i], 5) == min(want[i], 5) for i in want)


def test_silhouette_by_hand(spark):
    d = spark.createDataFrame([([0.0], 0), ([1.0], 0), ([10.0], 1), ([5.0], -1)], "v array<double>, c int")
    r = CL.silhouette(d, "v", "c").first()
    assert r["n"] == 3
    assert r["silhouette"] == pytest.approx(((100 - 1) / 100 + (81 - 1) / 81 + 0) / 3)
