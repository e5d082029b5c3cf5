"""Graph operators on graphs with hubs."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.operators import graph as G, packed


def test_triangles_from_either_side(spark):
    rng = random.Random(2)
    hubs = {(h, 100 + i) for i in range(60) for h in rng.sample(range(12), 6)} | {(h, 50) for h in range(12)} | {(50, 100 + i) for i in range(0, 60, 2)}
    fans = {(10 * i, 10 * i + j) for i in range(1, 5) for j in range(1, 8)} | {(1000 + i, 1001 + i) for i in range(20)} | {(1000, 1002), (1003, 1005)}
    for g in (hubs, fans, set()):
        a = {}
        for u, v in g:
            a.setdefault(u, set()).add(v)
            a.setdefault(v, set()).add(u)
        want = {x: n for x in a if (n := sum(1 for y, z in itertools.combinations(a[x], 2) if z in a[y]))}
        e = spark.createDataFrame(sorted(g), "u long, v long")
        assert {r.node: r.triangles for r in G.triangles(e).collect()} == want


def test_loops_and_parallel_edges_count_as_from_the_lowest_node(spark):
    """Over pairs of targets of one source, whichever side the triangles are sought from."""
    g = [(h, 100 + i) for h in range(1, 6) for i in range(10)] + [(1, 2), (1, 2), (2, 3), (3, 3), (1, 100), (100, 100), (101, 101)]
    deg = Counter(x for e in g for x in e)
    o = [tuple(sorted(e, key=lambda x: (deg[x], x))) for e in g]
    want = Counter()
    for (s, a), (z, b) in itertools.product(o, o):
        if s == z and a < b:
            for e in o:
                if tuple(sorted(e)) == (a, b):
                    want.update([s, a, b])
    pairs, paths = G._wedges(spark.createDataFrame(o, "s long, t long"))
    assert {r.node: r.triangles for r in G.triangles(spark.createDataFrame(g, "u long, v long")).collect()} == want
    assert paths <= pairs


def test_wedges_are_counted(spark):
    o = [(1, 2), (1, 3), (1, 4), (2, 3), (3, 4), (5, 3)]
    assert G._wedges(spark.createDataFrame(o, "s long, t long")) == (3, 1 + 3)
    assert G._wedges(spark.createDataFrame([], "s long, t long")) == (0, 0)


def test_best_gains_are_found_without_sorting_rows(spark, monkeypatch):
    """Communities of two cliques and a bridge, with the smaller number among equal gains; no step sorts rows to find a maximum."""
    e = list(itertools.combinations(range(6), 2)) + list(itertools.combinations(range(10, 16), 2)) + [(5, 10)]
    plans, write = [], G.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(G, "checkpointed", seen)
    got = {r.node: r.community for r in G.communities(spark.createDataFrame(e, "u long, v long")).collect()}
    assert [len({got[x] for x in r}) for r in (range(6), range(10, 16), got)] == [1, 1, 2]
    assert plans and not [p for p in plans if "SortAggregate" in p]


def test_all_sources_advance_together(spark, monkeypatch):
    """Distance sums write as many tables for four parts of the sources as for one, and runs of parts add up."""
    rng = random.Random(8)
    e = spark.createDataFrame(sorted({(i, rng.randrange(min(i, 3))) for i in range(1, 200)} | {(900, 901)}), "u long, v long")
    written = []
    for name in ("checkpointed", "bucketed"):
        monkeypatch.setattr(G, name, lambda *a, f=getattr(G, name): written.append(1) or f(*a))
    want, one = sorted(G.distance_sums(e, words=4).collect()), len(written)
    assert sorted(G.distance_sums(e, words=1).collect()) == want and len(written) == 2 * one
    assert sorted(G.distance_sums(e, words=1, state_rows=500).collect()) == want


def test_distance_sums_of_few_sources_and_null_nodes(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (3, 3), (7, 8), (1, 2), (None, None)], "u long, v long")
    one = spark.createDataFrame([(4,), (4,), (99,)], "source long")
    got = {r.node: (r.reached, r.total, r.farthest) for r in G.distance_sums(e, one).collect()}
    assert got == {1: (1, 3, 3), 2: (1, 2, 2), 3: (1, 1, 1), 4: (0, 0, 0), 7: (0, 0, 0), 8: (0, 0, 0), None: (0, 0, 0)}
    assert {r.node: r.reached for r in G.distance_sums(e).collect()} == {1: 3, 2: 3, 3: 3, 4: 3, 7: 1, 8: 1, None: 0}


def searched(edges, sources):
    """``{node: (reached, total, farthest)}`` by plain search."""
    a = {}
    for u, v in edges:
        a.setdefault(u, set()).add(v)
        a.setdefault(v, set()).add(u)
    out = {x: [0, 0, 0] for x in a}
    for s in set(sources) & set(a):
        d, level = {s: 0}, [s]
        while level:
            level = sorted({y for x in level for y in a[x]} - set(d))
            d |= {y: max(d.values()) + 1 for y in level}
        for x, k in d.items():
            out[x] = [out[x][0] + (k > 0), out[x][1] + k, max(out[x][2], k)]
    return {x: tuple(r) for x, r in out.items()}


@pytest.mark.parametrize("words", [1, 3])
def test_packed_search_is_the_search_by_level(spark, monkeypatch, words):
    """Hubs, chains, several components, loops, parallel edges, text nodes; nothing is written from level to level."""
    rng = random.Random(3)
    g = [(0, i) for i in range(1, 150)] + [(1, i) for i in range(100, 260)] + [(300 + i, 301 + i) for i in range(70)] + [(5, 300), (7, 7), (0, 1), (1, 0)]
    g += [(500 + i, 500 + rng.randrange(i)) for i in range(1, 90)] + [(900, 900)]
    few = [0, 150, 350, 501, 589, 900, 12345]
    calls = []
    for name in ("checkpointed", "bucketed"):
        monkeypatch.setattr(G, name, lambda *a, f=getattr(G, name): calls.append(1) or f(*a))
    e, named = spark.createDataFrame(g, "u long, v long"), spark.createDataFrame([(f"n{u}", f"n{v}") for u, v in g], "u string, v string")
    rows = lambda d: {r.node: (r.reached, r.total, r.farthest) for r in d.collect()}
    assert rows(G.distance_sums(e, words=words)) == searched(g, range(1000)) and len(calls) <= 3
    assert rows(G.distance_sums(e, spark.createDataFrame([(x,) for x in few], "source long"), words=words)) == searched(g, few)
    assert rows(G.distance_sums(named, words=words)) == {f"n{x}": r for x, r in searched(g, range(1000)).items()}


def test_graphs_too_large_for_a_task_are_searched_by_level(spark):
    g = [(i, i // 3) for i in range(1, 40)] + [(100, 101)]
    e = spark.createDataFrame(g, "u long, v long")
    assert packed.pack(e, len(g) - 1) is None and len(packed.pack(e, len(g)).names) == 42
    assert sorted(G.distance_sums(e, packed_edges=0).collect()) == sorted(G.distance_sums(e).collect())
    assert packed.pack(spark.createDataFrame([(1, None), (1, 2)], "u long, v long"), 9) is None
    assert len(packed.pack(spark.createDataFrame([(None, None), (3, 3)], "u long, v long"), 9).names) == 0


def test_components_of_packed_edges():
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(200)] + [(300 + i, 300 + rng.randrange(i)) for i in range(1, 60)] + [(400, 401)]
    rng.shuffle(pairs)
    g = packed.pack_arrays(pa.table({"u": [u for u, _ in pairs], "v": [v for _, v in pairs]}))
    label = dict(zip(g.names.to_pylist(), packed.components(g)[g.row].tolist()))
    assert [len({label[x] for x in r}) for r in (range(201), range(300, 360), (400, 401))] == [1, 1, 1] and len(set(label.values())) == 3


def test_nodes_with_the_same_few_edges_share_a_row():
    """By their one or two edges, parallel ones counted; nodes of higher degree never."""
    pairs = [(1, 2), (3, 2), (4, 2), (4, 2), (5, 2), (5, 6), (7, 6), (7, 2), (8, 6), (8, 2), (8, 9), (10, 6), (10, 2), (10, 9)]
    t = pa.table({"u": [u for u, _ in pairs], "v": [v for _, v in pairs]})
    for parallel in (False, True):
        g = packed.pack_arrays(t, parallel)
        rows = {}
        for x, r in zip(g.names.to_pylist(), g.row.tolist()):
            rows.setdefault(r, set()).add(x)
        alike = [{1, 3}, {4}] if parallel else [{1, 3, 4}]
        assert sorted(map(sorted, rows.values())) == sorted(map(sorted, [*alike, {2}, {5, 7}, {6}, {8}, {9}, {10}]))
        assert all(g.many[r] == len(x) for r, x in rows.items()) and (np.diff(np.diff(g.ptr)) <= 0).all()


def test_packed_betweenness_counts_every_path(spark, monkeypatch):
    """Nodes alike, hubs, a cycle of four, parallel edges, loops and several components, from all and from some sources, as level by level."""
    rng = random.Random(4)
    g = [(0, i) for i in range(1, 90)] + [(rng.randrange(100, 104), i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(3)]
    g += [(200, 201), (201, 202), (202, 203), (203, 200), (5, 200), (300, 301), (300, 301), (301, 302), (7, 7), (0, 1), (1, 0)]
    e = spark.createDataFrame(g, "u long, v long")
    rows = lambda d: {r.node: r.betweenness for r in d.collect()}
    some = spark.createDataFrame([(x,) for x in (0, 3, 3, 50, 51, 201, 301, 999)], "source long")
    for sources in (None, some):
        want = rows(G.betweenness(e, sources, packed_edges=0))
        for columns in (3, 32):
            monkeypatch.setattr(packed, "COLUMNS", columns)
            assert rows(G.betweenness(e, sources)) == pytest.approx(want)


def test_betweenness_writes_no_table_a_level(spark, monkeypatch):
    calls = []
    for name in ("checkpointed", "bucketed"):
        monkeypatch.setattr(G, name, lambda *a, f=getattr(G, name): calls.append(1) or f(*a))
    e = spark.createDataFrame([(i, i + 1) for i in range(30)], "u long, v long")
    got = {r.node: r.betweenness for r in G.betweenness(e).collect()}
    assert got == pytest.approx({i: 2 * i * (30 - i) / (30 * 29) for i in range(31)}) and len(calls) <= 4


@pytest.mark.parametrize("nodes", [1 << 20, 3])
def test_edges_are_not_shuffled_to_the_communities(spark, monkeypatch, nodes):
    """Where the tables by community may be broadcast, all joins of the edges with them are; the labels are the same without."""
    rng = random.Random(9)
    g = sorted({(min(p), max(p)) for b in range(4) for p in ((20 * b + rng.randrange(12), 20 * b + rng.randrange(12)) for _ in range(40)) if p[0] != p[1]} | {(0, 20), (25, 40), (41, 60)})
    e = spark.createDataFrame(g, "u long, v long")
    want = sorted(G.communities(e).collect())
    plans, write = [], G.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(G, "checkpointed", seen)
    monkeypatch.setattr(G, "BROADCAST_NODES", nodes)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(G.communities(e).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    best = [p for p in plans if "bigger" in p and "most" in p]
    assert best and all(("SortMergeJoin" not in p) == (nodes > 3) for p in best)
