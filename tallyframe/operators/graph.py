"""Graph measures on an undirected edge table (u, v) with u <> v and one row per pair.

Iterations are joins and aggregations; the state of a round is written to the
shared checkpoint folder, so the plan stays short, lost executors cost at most
that round, and the planner knows the state's size when it picks the next join.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import packed
from tallyframe.operators.ordered import one_row, row_index
from tallyframe.session import bucketed, checkpointed


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def graph_stats(edges: DataFrame) -> DataFrame:
    return degrees(edges).agg(
        F.count(F.lit(1)).alias("nodes"), (F.sum("degree") / 2).cast("long").alias("edges"), F.avg("degree").alias("mean_degree"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    d = degrees(edges)
    n = d.agg(F.count(F.lit(1))).scalar()
    return d.withColumn("centrality", F.try_divide(F.col("degree"), n - 1))


def degree_distribution(edges: DataFrame) -> DataFrame:
    return degrees(edges).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


def pagerank(edges: DataFrame, rounds: int = 100, damping: float = 0.85, tol: float | None = 1e-6,
             nodes: DataFrame | None = None, every: int = 1) -> DataFrame:
    """Uniform start, both edge directions, the rank of nodes without edges spread evenly.

    Contributions are summed before the shuffle, so a hub costs one row per task. The loop ends when the summed
    change is below n·tol and raises if ``rounds`` do not get there; without ``tol`` it makes exactly ``rounds``.
    """
    with bucketed(both_ways(edges), "a") as e:
        deg = e.groupBy("a").agg(F.count(F.lit(1)).alias("deg"))
        base = deg if nodes is None else nodes.select(F.col("node").alias("a")).join(deg, "a", "left").na.fill(0, ["deg"])
        base = checkpointed(base)
        n = base.count()
        has_dangling = nodes is not None
        r = base.select("a", "deg", F.lit(1.0 / n).alias("rank"))
        for i in range(rounds):
            share = r.where("deg > 0").select("a", (F.col("rank") / F.col("deg")).alias("s"))
            got = e.join(share, "a").groupBy(F.col("b").alias("__b")).agg(F.sum("s").alias("s"))
            loose = F.coalesce(r.where("deg = 0").agg(F.sum("rank")).scalar(), F.lit(0.0)) if has_dangling else F.lit(0.0)
            nxt = r.join(got, F.col("a") == F.col("__b"), "left").select(
                "a", "deg", F.col("rank").alias("old"),
                ((1 - damping) / n + damping * (F.coalesce("s", F.lit(0.0)) + loose / n)).alias("rank"))
            last = i + 1 == rounds
            if (i + 1) % every == 0 or last or tol is not None:
                nxt = checkpointed(nxt)
            if tol is not None and nxt.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] < n * tol:
                r = nxt
                break
            r = nxt.drop("old")
        else:
            if tol is not None:
                raise RuntimeError(f"PageRank did not converge in {rounds} rounds")
    return r.select(F.col("a").alias("node"), "rank")


def shortest_paths(edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """BFS distances (source, node, dist) from all nodes, or from the given ones.

    The result has one row per reachable pair, so all sources at once suit
    graphs whose node count is small; for others pass the sources in portions.
    """
    e = checkpointed(both_ways(edges))
    src = (e.select(F.col("a").alias("source")).distinct() if sources is None else sources).select("source")
    seen = checkpointed(src.select("source", F.col("source").alias("node"), F.lit(0).alias("dist")))
    frontier, d = seen, 0
    while True:
        d += 1
        step = frontier.join(e, frontier.node == e.a).select("source", F.col("b").alias("node")).distinct()
        frontier = checkpointed(step.join(seen, ["source", "node"], "left_anti").withColumn("dist", F.lit(d)))
        if frontier.isEmpty():
            return seen
        seen = checkpointed(seen.unionByName(frontier))


def path_summary(paths: DataFrame) -> DataFrame:
    """Average distance over reachable ordered pairs, and the diameter."""
    return paths.where("dist > 0").agg(
        F.count(F.lit(1)).alias("pairs"), F.avg("dist").alias("mean_distance"), F.max("dist").alias("diameter"))


def closeness(paths: DataFrame) -> DataFrame:
    """(reachable / sum of distances), scaled by the reached share of the graph."""
    g = paths.groupBy("source").agg(F.sum((F.col("dist") > 0).cast("long")).alias("r"), F.sum("dist").alias("s"))
    n = g.agg(F.count(F.lit(1))).scalar()
    return g.select(F.col("source").alias("node"), F.coalesce(
        F.try_divide(F.col("r"), F.col("s")) * F.try_divide(F.col("r"), n - 1), F.lit(0.0)).alias("closeness"))


#: Rows of (node, part of the sources) that a run of ``distance_sums`` holds at a level.
STATE_ROWS = 1 << 24


def distance_sums(edges: DataFrame, sources: DataFrame | None = None, words: int = 16, state_rows: int = STATE_ROWS,
                  packed_edges: int = packed.PACKED_EDGES) -> DataFrame:
    """``(node, reached, total, farthest)`` over the shortest paths between each node and the sources (default: all nodes).

    A graph of at most ``packed_edges`` edges travels with the tasks, which search from blocks of 64 * ``words`` sources. A larger
    one is searched level by level as a table.
    """
    edges = checkpointed(edges.select("u", "v"))
    g = packed.pack(edges, packed_edges)
    if g is None:
        return _distances_by_level(edges, sources, words, state_rows)
    zero = F.lit(0).cast("long")
    out = both_ways(edges).select(F.col("a").alias("node")).distinct().select(
        "node", zero.alias("reached"), zero.alias("total"), F.lit(0).alias("farthest"))
    if len(g.names):
        out = out.unionByName(packed.distance_sums(edges, g, sources, words))
    return checkpointed(out.groupBy("node").agg(F.sum("reached").alias("reached"), F.sum("total").alias("total"), F.max("farthest").alias("farthest")))


def _distances_by_level(edges: DataFrame, sources: DataFrame | None, words: int, state_rows: int) -> DataFrame:
    """``distance_sums`` of a graph of any size.

    Breadth-first search from all sources at once: the sources are cut into parts of 64 * ``words``, and a row holds the sources
    of one part that lie within the level of a node, one bit each. A level is one ``bit_or`` over a node's own row and those
    neighbours' rows that grew; the distance sums follow from the number of bits at every level, so no table of pairs is kept.
    Rows are bucketed by part: where the planner broadcasts the edges, a level shuffles nothing. Runs of at most
    ``state_rows`` rows follow one another and add to the sums.
    """
    bits = [f"s{k}" for k in range(words)]
    hops = both_ways(edges).distinct()
    hops = checkpointed(hops.withColumn("own", F.lit(False)).unionByName(
        hops.select("a", F.col("a").alias("b")).distinct().withColumn("own", F.lit(True))))
    nodes = checkpointed(hops.where("own").select(F.col("a").alias("node")))
    src = nodes if sources is None else nodes.join(sources.select(F.col("source").alias("node")).distinct(), "node", "left_semi")
    numbered = checkpointed(row_index(src.where("node is not null"), "node", "node").select("node", (F.col("rn") - 1).alias("i")))
    parts, run = -(-numbered.count() // (64 * words)), max(1, state_rows // max(1, nodes.count()))
    sums = []
    for p in range(0, parts, run):
        here = numbered.withColumn("part", F.floor(F.col("i") / (64 * words)).cast("int")).where((F.col("part") >= p) & (F.col("part") < p + run))
        bit = F.expr("shiftleft(1L, cast(i % 64 as int))")
        state = here.select("node", "part", *[F.when(F.floor(F.col("i") / 64) % words == k, bit).otherwise(F.lit(0).cast("long")).alias(s)
                                              for k, s in enumerate(bits)], F.lit(1).cast("long").alias("c"), F.lit(True).alias("grew"))
        counts, level, grew = None, 0, True
        with ExitStack() as tables:
            while grew:
                state = tables.enter_context(bucketed(state, "part"))
                per = checkpointed(state.groupBy("node").agg(F.sum("c").alias("c"), F.max("grew").alias("grew")).withColumn("k", F.lit(level)))
                counts = per if counts is None else counts.unionByName(per)
                grew = per.where("grew").limit(1).count() > 0
                got = state.join(hops, (F.col("node") == F.col("a")) & (F.col("grew") | F.col("own"))).groupBy("part", "b").agg(
                    *[F.bit_or(s).alias(s) for s in bits], F.max(F.when(F.col("own"), F.col("c"))).alias("old"))
                now = sum((F.bit_count(s) for s in bits), F.lit(0)).cast("long")
                state = got.withColumn("c", now).select(F.col("b").alias("node"), "part", *bits, "c", (F.col("c") > F.coalesce("old", F.lit(0))).alias("grew"))
                level += 1
        # a node's sources at distance d are missing from its counts of the levels before d
        sums.append(checkpointed(counts.groupBy("node").agg(
            (F.max("c") - F.sum(F.when(F.col("k") == 0, F.col("c")).otherwise(0))).alias("reached"),
            (level * F.max("c") - F.sum("c")).alias("total"), (-F.max(F.struct("c", (-F.col("k")).alias("k")))["k"]).alias("farthest"))))
    zero = F.lit(0).cast("long")
    out = nodes.select("node", zero.alias("reached"), zero.alias("total"), F.lit(0).alias("farthest"))
    for x in sums:
        out = out.unionByName(x)
    return checkpointed(out.groupBy("node").agg(F.sum("reached").alias("reached"), F.sum("total").alias("total"), F.max("farthest").alias("farthest")))


def closeness_from_sums(sums: DataFrame) -> DataFrame:
    """Closeness of every node from the distance sums over all nodes; a node that reaches none has 0."""
    n = sums.agg(F.count(F.lit(1))).scalar()
    c = F.try_divide(F.col("reached").cast("double"), F.col("total")) * F.try_divide(F.col("reached").cast("double"), n - 1)
    return sums.select("node", F.coalesce(c, F.lit(0.0)).alias("closeness"))


#: Rows of (source, node) that a portion of a betweenness run holds at a level.
PORTION_ROWS = 1 << 26


def betweenness(edges: DataFrame, sources: DataFrame | None = None, portion_rows: int = PORTION_ROWS,
                packed_edges: int = packed.PACKED_EDGES) -> DataFrame:
    """Share of shortest paths through each node, normalised by (n-1)(n-2)/2.

    Path counts grow level by level outward, dependencies are summed level by level inward. A graph of at most ``packed_edges``
    edges travels with the tasks, which count from blocks of sources. In a larger one sources advance in portions, so
    that a portion's states stay below ``portion_rows`` rows; a portion leaves one sum per node. ``sources`` takes some
    nodes only (as pivots on graphs too large for all); their sums are not scaled up.
    """
    edges = checkpointed(edges.select("u", "v"))
    nodes = checkpointed(both_ways(edges).select(F.col("a").alias("node")).distinct())
    n, g = nodes.count(), packed.pack(edges, packed_edges, parallel=True)
    total = _portions(edges, nodes, n, sources, portion_rows) if g is None else packed.dependencies(edges, g, sources)
    got = nodes.join(total.groupBy("node").agg(F.sum("delta").alias("delta")), "node", "left")
    share = F.coalesce("delta", F.lit(0.0)) / F.lit(float((n - 1) * (n - 2))) if n > 2 else F.lit(0.0)
    return checkpointed(got.select("node", share.alias("betweenness")))


def _portions(edges: DataFrame, nodes: DataFrame, n: int, sources: DataFrame | None, portion_rows: int) -> DataFrame:
    with bucketed(both_ways(edges), "a") as e:
        src = nodes.select(F.col("node").alias("source")) if sources is None else sources.select("source").distinct()
        k = max(1, -(-src.count() * n // portion_rows))
        src = checkpointed(src.withColumn("portion", F.pmod(F.xxhash64("source"), F.lit(k))))
        parts = [_dependencies(e, src.where(F.col("portion") == p).select("source")) for p in range(k)]
        total = parts[0]
        for x in parts[1:]:
            total = total.unionByName(x)
        return total


def _dependencies(e: DataFrame, sources: DataFrame) -> DataFrame:
    """``(node, delta)``: what all shortest paths from the sources pass through each node, written."""
    level = checkpointed(sources.select("source", F.col("source").alias("node"), F.lit(1.0).alias("sigma")))
    levels, seen = [level], level.select("source", "node")
    while True:
        nxt = e.join(level.withColumnRenamed("node", "a"), "a").groupBy("source", F.col("b").alias("node")).agg(F.sum("sigma").alias("sigma"))
        level = checkpointed(nxt.join(seen, ["source", "node"], "left_anti"))
        if level.isEmpty():
            break
        levels.append(level)
        seen = levels[-2].select("source", "node").unionByName(level.select("source", "node"))  # a neighbour is at most one level back
    total, below = None, None  # (source, node, sigma, delta) of the level further out
    for cur in reversed(levels[1:]):
        if below is None:
            d = cur.withColumn("delta", F.lit(0.0))
        else:
            unit = below.select("source", F.col("node").alias("a"), ((1 + F.col("delta")) / F.col("sigma")).alias("unit"))
            gain = e.join(unit, "a").groupBy("source", F.col("b").alias("node")).agg(F.sum("unit").alias("unit"))
            d = cur.join(gain, ["source", "node"], "left").select(
                "source", "node", "sigma", F.coalesce(F.col("sigma") * F.col("unit"), F.lit(0.0)).alias("delta"))
        below = checkpointed(d)
        part = below.groupBy("node").agg(F.sum("delta").alias("delta"))
        total = part if total is None else total.unionByName(part)
    if total is None:
        total = levels[0].select("node", F.lit(0.0).alias("delta"))
    return checkpointed(total.groupBy("node").agg(F.sum("delta").alias("delta")))


def _wedges(o: DataFrame) -> tuple[int, int]:
    """Of directed edges (s, t): the pairs of edges with the same source, and the paths of two edges."""
    end = lambda c, out: F.struct(F.col(c).alias("node"), F.lit(out).alias("o"), F.lit(1 - out).alias("i"))
    per = o.select(F.inline(F.array(end("s", 1), end("t", 0)))).groupBy("node").agg(F.sum("o").cast("double").alias("o"), F.sum("i").cast("double").alias("i"))
    row = per.agg(F.sum(F.col("o") * (F.col("o") - 1) / 2), F.sum(F.col("o") * F.col("i"))).first()
    return int(row[0] or 0), int(row[1] or 0)


def triangles(edges: DataFrame) -> DataFrame:
    """Triangles per node. Each edge points from the lower to the higher degree, so a hub
    has few outgoing edges and no node pairs up all its neighbours. Triangles are sought from their lowest or their middle
    node, whichever has fewer candidates in all; few edges go out of a hub, so the middle is mostly the better."""
    deg = degrees(edges)
    d1 = deg.select(F.col("node").alias("u"), F.col("degree").alias("du"))
    d2 = deg.select(F.col("node").alias("v"), F.col("degree").alias("dv"))
    e = edges.select("u", "v").join(d1, "u").join(d2, "v")
    up = F.struct("du", "u") < F.struct("dv", "v")
    o = checkpointed(e.select(F.when(up, F.col("u")).otherwise(F.col("v")).alias("s"), F.when(up, F.col("v")).otherwise(F.col("u")).alias("t")))
    pairs, paths = _wedges(o)
    if paths <= pairs:  # paths s -> t1 -> t2, closed by s -> t2
        wedge = o.select("s", F.col("t").alias("t1")).join(o.select(F.col("s").alias("t1"), F.col("t").alias("t2")), "t1").where("t1 <> t2")  # loops are not sides
        tri = wedge.join(o.select("s", F.col("t").alias("t2")), ["s", "t2"])
    else:  # pairs of targets of s, closed by an edge between them
        wedge = o.select("s", F.col("t").alias("t1")).join(o.select("s", F.col("t").alias("t2")), "s").where(F.col("t1") < F.col("t2"))
        tri = wedge.join(o.select(F.least("s", "t").alias("t1"), F.greatest("s", "t").alias("t2")), ["t1", "t2"])
    return tri.select(F.explode(F.array("s", "t1", "t2")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))


def clustering(edges: DataFrame) -> DataFrame:
    """Local clustering coefficient per node; below two neighbours it is 0."""
    d = degrees(edges).join(triangles(edges), "node", "left").na.fill(0, ["triangles"])
    return d.withColumn("clustering", F.coalesce(
        F.try_divide(2.0 * F.col("triangles"), F.col("degree") * (F.col("degree") - 1)), F.lit(0.0)))


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component = smallest node), by alternating large-star and small-star steps (logarithmic rounds)."""
    def stars(e, large):
        pairs = both_ways(e.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct() if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        m = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        j = pairs.join(m, "a")
        if large:
            return j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return j.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            m.where("a <> m").select("a", F.col("m").alias("b")))

    e = checkpointed(edges.select(F.col("u").alias("a"), F.col("v").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        e = checkpointed(stars(stars(e, True), False).distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    comp = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    everyone = nodes if nodes is not None else both_ways(edges).select(F.col("a").alias("node")).distinct()
    return everyone.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Modularity of a labelling (node, community)."""
    deg = degrees(edges).join(labels, "node").groupBy("community").agg(F.sum("degree").alias("d"))
    l1 = labels.select(F.col("node").alias("u"), F.col("community").alias("cu"))
    l2 = labels.select(F.col("node").alias("v"), F.col("community").alias("cv"))
    inner = edges.join(l1, "u").join(l2, "v").agg(
        F.count_if(F.col("cu") == F.col("cv")).alias("i"), F.count(F.lit(1)).alias("m"))
    p = one_row(inner)
    d = deg.withColumn("p", p)
    return d.groupBy("p").agg(F.sum(F.pow(F.col("d") / (2 * F.col("p.m")), 2)).alias("s")).select(
        (F.col("p.i") / F.col("p.m") - F.col("s")).alias("modularity"), F.col("p.m").alias("edges"))


#: Communities whose degrees, gains and merges are broadcast, about 50 bytes each; more meet the edges by the planner's joins.
BROADCAST_NODES = 1 << 20


def communities(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Greedy modularity in rounds. Each community names its best positive gain; of two that name
    each other the one with more edges becomes a root, and every community that named a root joins it.
    A round that would lower the modularity merges the mutual pairs only, which always raises it.
    Returns (node, community).

    The edges are shuffled once, into a table by node, which holds all rows of the largest round in place. Tables by community go
    to the edges as broadcasts up to ``BROADCAST_NODES`` nodes, so that a round shuffles sums only.
    """
    with bucketed(both_ways(edges).select(F.col("a").alias("i"), F.col("b").alias("j"), F.lit(1.0).alias("w")), "i") as w:
        return _merged(w, max_rounds)


def _best_gains(w: DataFrame, deg: DataFrame, m2: float, sent: Callable[[DataFrame], DataFrame] = F.broadcast) -> DataFrame:
    """``(i, j, bigger)``: the neighbour of most gain (ties: the smallest) and whether i has more edges than it, the lower number among equals.

    The gain, rounded to 12 digits, is found as a maximum, then the neighbour as a minimum: both are numbers, so no rows are sorted
    for them. Rounding keeps the order, so only the largest gains and those near them are rounded.
    """
    here, there = sent(deg.select("i", "d")), sent(deg.select(F.col("i").alias("j"), F.col("d").alias("dj")))
    gain = w.where("i <> j").join(there, "j").join(here, "i")  # the join that groups by i comes last
    gain = gain.select("i", "j", (2 * (F.col("w") / m2 - F.col("d") * F.col("dj") / m2 / m2)).alias("q")).where("q > 0")
    most = gain.groupBy("i").agg(F.round(F.max("q"), 12).alias("most")).where("most > 0")
    best = gain.join(sent(most), "i").where((F.col("q") > F.col("most") - 1e-12) & (F.round("q", 12) == F.col("most"))).groupBy("i").agg(F.min("j").alias("j"))
    bigger = (F.col("dj") < F.col("d")) | ((F.col("dj") == F.col("d")) & (F.col("j") > F.col("i")))
    return best.join(here, "i").join(there, "j").select("i", "j", bigger.alias("bigger"))


def _merged(w: DataFrame, max_rounds: int) -> DataFrame:
    def degree(w):
        inner = F.sum(F.when(F.col("i") == F.col("j"), F.col("w")).otherwise(0.0))
        return checkpointed(w.groupBy("i").agg(F.sum("w").alias("d"), inner.alias("w")))

    def rename(d, merge, c):
        # the merge table is as large as the number of communities that move
        return d.join(sent(merge), d[c] == merge["from"], "left").withColumn(c, F.coalesce("to", F.col(c))).drop("from", "to")

    def quality(deg):
        return deg.agg(F.sum(F.col("w") / m2 - F.pow(F.col("d") / m2, 2))).first()[0]

    deg = degree(w)
    label = checkpointed(deg.select(F.col("i").alias("node"), F.col("i").alias("community")))
    m2 = deg.agg(F.sum("d")).first()[0]
    if not m2:
        return label
    sent = F.broadcast if deg.count() <= BROADCAST_NODES else lambda d: d
    score = quality(deg)
    for _ in range(max_rounds):
        best = checkpointed(_best_gains(w, deg, m2, sent))
        mutual = best.join(best.select(F.col("i").alias("j"), F.col("j").alias("back")), "j").where("i = back")
        root = checkpointed(mutual.where("bigger").select(F.col("i").alias("to")))
        if root.isEmpty():
            break
        move = best.join(root, F.col("j") == F.col("to")).select(F.col("i").alias("from"), "to")
        for merge in (move, mutual.join(root, F.col("j") == F.col("to")).select(F.col("i").alias("from"), "to")):
            merge = checkpointed(merge)
            w2 = checkpointed(rename(rename(w, merge, "i"), merge, "j").groupBy("i", "j").agg(F.sum("w").alias("w")))
            deg2 = degree(w2)
            score2 = quality(deg2)
            if score2 > score:
                break
        if score2 <= score:
            break
        w, deg, score = w2, deg2, score2
        label = checkpointed(rename(label, merge, "community"))
    else:
        raise RuntimeError(f"communities still merge after {max_rounds} rounds")
    return label
