"""Graph queries on graphs whose nodes and edges grow with the tables: most on the market graph, those over all
shortest paths on the sparser graph of main suppliers and home nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import graph as G
from tallyframe.plans import views
from tallyframe.plans.registry import query
from tallyframe.session import checkpointed

DEG = "dg AS (SELECT a AS node, count(*) AS degree FROM gg GROUP BY 1)"


@query("graph_stats", f"""
WITH {views.MARKET}, {DEG} SELECT count(*) AS nodes, CAST(sum(degree) / 2 AS BIGINT) AS edges, round(avg(degree), 8) AS mean_degree FROM dg""")
def graph_stats(t):
    return G.graph_stats(views.market_graph(t)).withColumn("mean_degree", F.round("mean_degree", 8))


@query("degree_centrality", f"""
WITH {views.MARKET}, {DEG} SELECT node, degree, round(degree / ((SELECT count(*) FROM dg) - 1), 10) AS centrality FROM dg""")
def degree_centrality(t):
    return G.degree_centrality(views.market_graph(t)).withColumn("centrality", F.round("centrality", 10))


@query("degree_distribution", f"WITH {views.MARKET}, {DEG} SELECT degree, count(*) AS nodes FROM dg GROUP BY 1")
def degree_distribution(t):
    return G.degree_distribution(views.market_graph(t))


def _ranks(rounds):
    out = ["r0 AS (SELECT node, degree, 1.0::DOUBLE / (SELECT count(*) FROM dg) AS rank FROM dg)"]
    for i in range(1, rounds + 1):
        out.append(f"""r{i} AS MATERIALIZED (SELECT x.node, x.degree, 0.15 / (SELECT count(*) FROM dg) + 0.85 * s AS rank FROM dg x JOIN
          (SELECT b, sum(rank / degree) AS s FROM gg JOIN r{i - 1} ON a = node GROUP BY 1) ON b = x.node)""")
    return ", ".join(out)


ROUNDS = 100


def _first_converged(rounds):
    steps = " UNION ALL ".join(f"SELECT {i} AS i, node, rank FROM r{i}" for i in range(rounds + 1))
    return f"""allr AS (SELECT *, rank - lag(rank) OVER (PARTITION BY node ORDER BY i) AS d FROM ({steps})),
    done AS (SELECT min(i) AS i FROM (SELECT i, sum(abs(d)) AS s FROM allr WHERE i > 0 GROUP BY i) WHERE s < 1e-6 * (SELECT count(*) FROM dg))"""


@query("pagerank", f"WITH {views.MARKET.replace('gg AS', 'gg AS MATERIALIZED')}, {DEG}, {_ranks(ROUNDS)}, {_first_converged(ROUNDS)} "
       "SELECT node, round(rank, 10) AS rank FROM allr JOIN done USING (i)")
def pagerank(t):
    return G.pagerank(views.market_graph(t), ROUNDS).withColumn("rank", F.round("rank", 10))


LEVELS = 12


def _levels() -> str:
    """Path counts of every source level by level; the levels past the last are empty."""
    out = ["l0 AS MATERIALIZED (SELECT DISTINCT a AS source, a AS node, 1::DOUBLE AS sigma FROM gg)"]
    for k in range(1, LEVELS + 1):
        old = f"SELECT source, node FROM l{k - 1}" + (f" UNION ALL SELECT source, node FROM l{k - 2}" if k > 1 else "")
        out.append(f"""l{k} AS MATERIALIZED (SELECT * FROM (SELECT source, b AS node, sum(sigma) AS sigma FROM l{k - 1} JOIN gg ON node = a GROUP BY 1, 2) x
          WHERE NOT EXISTS (SELECT 1 FROM ({old}) o WHERE o.source = x.source AND o.node = x.node))""")
    return ", ".join(out)


def _inward() -> str:
    """Dependencies of every source, from the outermost level inward."""
    out = [f"d{LEVELS} AS (SELECT *, 0::DOUBLE AS delta FROM l{LEVELS})"]
    for k in range(LEVELS - 1, 0, -1):
        out.append(f"""d{k} AS MATERIALIZED (SELECT l.source, l.node, l.sigma, coalesce(l.sigma * g.unit, 0) AS delta FROM l{k} l LEFT JOIN
          (SELECT source, b AS node, sum((1 + delta) / sigma) AS unit FROM d{k + 1} JOIN gg ON node = a GROUP BY 1, 2) g USING (source, node))""")
    return ", ".join(out)


PATHS = f"{views.HOME}, {_levels()}, sp AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT source, node, {k} AS dist FROM l{k}" for k in range(LEVELS + 1)) + \
    "), sums AS (SELECT node, count(*) FILTER (dist > 0) AS reached, CAST(sum(dist) AS BIGINT) AS total, max(dist) AS farthest FROM sp GROUP BY 1)"


@query("shortest_paths", f"""WITH {PATHS} SELECT node, reached, total, farthest, round(total / nullif(reached, 0), 8) AS mean_distance,
  round((SELECT sum(total) / sum(reached) FROM sums), 8) AS graph_mean FROM sums""")
def shortest_paths(t):
    """Reached nodes, distance sum, farthest and mean distance of every node, and the mean over all pairs."""
    s = G.distance_sums(views.home_graph(t))
    mean = s.agg(F.try_divide(F.sum("total"), F.sum("reached"))).scalar()
    return s.select("node", "reached", "total", "farthest", F.round(F.try_divide("total", "reached"), 8).alias("mean_distance"),
                    F.round(mean, 8).alias("graph_mean"))


@query("closeness_centrality", f"""
WITH {PATHS} SELECT node, round(coalesce(reached / nullif(total, 0) * reached / ((SELECT count(*) FROM sums) - 1), 0), 10) AS closeness FROM sums""")
def closeness_centrality(t):
    return G.closeness_from_sums(G.distance_sums(views.home_graph(t))).withColumn("closeness", F.round("closeness", 10))


@query("betweenness_centrality", f"""
WITH {views.HOME}, {_levels()}, {_inward()}, tr AS (SELECT node, sum(delta) AS delta FROM (
  {" UNION ALL ".join(f"SELECT node, delta FROM d{k}" for k in range(1, LEVELS + 1))}) GROUP BY 1), n AS (SELECT DISTINCT a AS node FROM gg)
SELECT node, round(coalesce(delta, 0) / (((SELECT count(*) FROM n) - 1) * ((SELECT count(*) FROM n) - 2)), 8) AS betweenness FROM n LEFT JOIN tr USING (node)""")
def betweenness_centrality(t):
    return G.betweenness(views.home_graph(t)).withColumn("betweenness", F.round("betweenness", 8))


@query("clustering_coefficient", f"""
WITH {views.MARKET}, {DEG},
tri AS (SELECT x.u AS p, x.v AS q, y.v AS r FROM g x JOIN g y ON x.v = y.u JOIN g z ON z.u = x.u AND z.v = y.v),
tn AS (SELECT n AS node, count(*) AS c FROM (SELECT p AS n FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY 1)
SELECT dg.node, degree, coalesce(c, 0) AS triangles, round(coalesce(2.0 * coalesce(c, 0) / nullif(degree * (degree - 1), 0), 0)::DOUBLE, 8) AS clustering
FROM dg LEFT JOIN tn ON dg.node = tn.node""")
def clustering_coefficient(t):
    return G.clustering(checkpointed(views.market_graph(t))).withColumn("clustering", F.round("clustering", 8))


@query("communities")
def communities(t):
    """Community of each node, its size, and the modularity of the whole labelling."""
    e = checkpointed(views.market_graph(t))
    c = checkpointed(G.communities(e))
    size = c.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    return c.join(size, "community").withColumn("modularity", G.modularity(e, c).select("modularity").scalar())


@query("community_modularity", f"""
WITH {views.MARKET}, {DEG}, lb AS (SELECT node, node % 3 AS c FROM dg), m AS (SELECT count(*) AS m FROM g),
i AS (SELECT count(*) AS i FROM g JOIN lb x ON u = x.node JOIN lb y ON v = y.node WHERE x.c = y.c),
d AS (SELECT c, sum(degree) AS d FROM dg JOIN lb USING (node) GROUP BY 1)
SELECT round(min(i) / min(m) - sum(pow(d / (2 * m), 2)), 8) AS modularity, min(m) AS edges FROM d, m, i""")
def community_modularity(t):
    """Modularity of a given labelling: the kind of node."""
    e = views.market_graph(t)
    labels = G.degrees(e).select("node", (F.col("node") % 3).alias("community"))
    return G.modularity(e, labels).withColumn("modularity", F.round("modularity", 8))
