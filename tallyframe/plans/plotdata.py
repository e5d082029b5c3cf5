"""Chart-table queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallyframe.operators import plotdata as PD, relational as R
from tallyframe.operators.ordered import one_row
from tallyframe.plans import views
from tallyframe.plans.registry import query


def month():
    return F.date_format("o_orderdate", "yyyy-MM")


@query("histogram_bins", """
WITH r AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b, count(*) AS n FROM lineitem),
h AS (SELECT CAST(least(floor((l_extendedprice - a) / ((b - a) / 30)), 29) AS INT) AS bin, count(*) AS c FROM lineitem, r GROUP BY 1)
SELECT CAST(g.i AS INT) AS bin, round(a + g.i * ((b - a) / 30), 4) AS low, coalesce(c, 0) AS n, round(coalesce(c, 0) / (n * ((b - a) / 30)), 12) AS density,
  (SELECT round(avg(l_extendedprice), 4) FROM lineitem) AS mean, (SELECT round(quantile_cont(l_extendedprice, 0.5), 4) FROM lineitem) AS median
FROM (SELECT unnest(range(30)) AS i) g LEFT JOIN h ON g.i = h.bin, r""")
def histogram_bins(t):
    h = PD.histogram(t.lineitem, "l_extendedprice", 30)
    return h.withColumn("m", one_row(PD.center_marks(t.lineitem, "l_extendedprice"))).select(
        "bin", F.round("low", 4).alias("low"), "n", F.round("density", 12).alias("density"),
        F.round("m.mean", 4).alias("mean"), F.round("m.median", 4).alias("median"))


@query("facet_histogram", """
WITH e AS (SELECT event_type, user_id % 2 = 0 AS even_user, value FROM events), r AS (SELECT min(value) AS a, max(value) AS b FROM e),
h AS (SELECT event_type, even_user, CAST(least(floor((value - a) / ((b - a) / 20)), 19) AS INT) AS bin, count(*) AS c FROM e, r GROUP BY 1, 2, 3),
f AS (SELECT DISTINCT event_type, even_user FROM e)
SELECT f.event_type, f.even_user, CAST(i AS INT) AS bin, coalesce(c, 0) AS n FROM f CROSS JOIN (SELECT unnest(range(20)) AS i)
LEFT JOIN h ON h.event_type = f.event_type AND h.even_user = f.even_user AND h.bin = i""")
def facet_histogram(t):
    e = t.events.select("event_type", (F.col("user_id") % 2 == 0).alias("even_user"), "value")
    return PD.histogram(e, "value", 20, ["event_type", "even_user"]).select("event_type", "even_user", "bin", "n")


@query("box_stats", """
WITH q AS (SELECT o_orderpriority AS p, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT o_orderpriority, round(min(q1), 4) AS q1, round(min(q2), 4) AS q2, round(min(q3), 4) AS q3, min(n) AS n,
  min(o_totalprice) FILTER (o_totalprice BETWEEN lo AND hi) AS whisker_low, max(o_totalprice) FILTER (o_totalprice BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (NOT o_totalprice BETWEEN lo AND hi) AS n_outliers,
  round(min(q2 - 1.57 * (q3 - q1) / sqrt(n)), 4) AS notch_low, round(min(q2 + 1.57 * (q3 - q1) / sqrt(n)), 4) AS notch_high
FROM orders JOIN b ON o_orderpriority = p GROUP BY 1""")
def box_stats(t):
    b = PD.box_stats(t.orders, "o_totalprice", ["o_orderpriority"])
    return b.withColumns({c: F.round(c, 4) for c in ["q1", "q2", "q3", "notch_low", "notch_high"]})


GRID = [float(g) for g in range(0, 400, 20)]


@query("kde_curve", f"""
WITH s AS (SELECT event_type, count(*) AS n, stddev(value) * pow(count(*), -0.2) AS h FROM events GROUP BY 1)
SELECT e.event_type, CAST(g AS DOUBLE) AS x, round(sum(exp(-0.5 * pow((g - value) / h, 2))) / (min(n) * min(h) * sqrt(2 * pi())), 9) AS density
FROM events e JOIN s ON e.event_type = s.event_type, (SELECT unnest({GRID}) AS g) GROUP BY 1, 2""")
def kde_curve(t):
    return PD.kde(t.events, "value", "event_type", GRID).withColumn("density", F.round("density", 9))


@query("regression_line", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  regr_count(l_extendedprice, l_quantity)::BIGINT AS n FROM lineitem""")
def regression_line(t):
    r = PD.regression_line(t.lineitem, "l_extendedprice", "l_quantity")
    return r.select(F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@query("group_mean_ci", """
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(avg(value) - 1.96 * stddev(value) / sqrt(count(*)), 6) AS low,
  round(avg(value) + 1.96 * stddev(value) / sqrt(count(*)), 6) AS high FROM events GROUP BY 1""")
def group_mean_ci(t):
    return PD.group_mean_ci(t.events, "value", "event_type").withColumns({c: F.round(c, 6) for c in ["mean", "low", "high"]})


@query("group_mean_bootstrap")
def group_mean_bootstrap(t):
    return PD.group_mean_bootstrap(t.events, "value", "event_type", "event_id", 100)


PC = ["l_discount", "l_extendedprice", "l_quantity"]
PP = [(a, b) for i, a in enumerate(PC) for b in PC[i + 1:]]


@query("pair_grid", " UNION ALL ".join(
    f"SELECT 'corr' AS part, l_returnflag AS grp, '{a}' AS c1, '{b}' AS c2, round(corr({a}, {b}), 6) AS v1, NULL::DOUBLE AS v2 FROM lineitem GROUP BY 2"
    for a, b in PP) + """ UNION ALL SELECT 'point', l_returnflag, 'l_quantity', 'l_extendedprice', l_quantity, l_extendedprice FROM (
  SELECT * FROM lineitem ORDER BY md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)), l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 100)""")
def pair_grid(t):
    c = PD.pair_correlations(t.lineitem, PC, "l_returnflag").select(
        F.lit("corr").alias("part"), F.col("l_returnflag").alias("grp"), "c1", "c2", F.round("r", 6).alias("v1"), F.lit(None).cast("double").alias("v2"))
    s = PD.hashed_sample(t.lineitem, 100, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").select(
        F.lit("point").alias("part"), F.col("l_returnflag").alias("grp"), F.lit("l_quantity").alias("c1"), F.lit("l_extendedprice").alias("c2"),
        F.col("l_quantity").alias("v1"), F.col("l_extendedprice").alias("v2"))
    return c.unionByName(s)


DL = views.DIRTY_LINEITEM_COLUMNS


@query("missing_matrix", f"""
WITH {views.DIRTY_LINEITEM}, r AS (SELECT *, row_number() OVER (ORDER BY {", ".join(c + " NULLS FIRST" for c in DL)}) AS row FROM dl)
""" + " UNION ALL ".join(
    f"""SELECT CAST(row AS INT) AS "row", '{c}' AS "column", CAST({c} IS NULL AS INT) AS is_missing FROM r WHERE row <= 100""" for c in DL))
def missing_matrix(t):
    return PD.missing_matrix(views.dirty_lineitem(t), DL, DL)


@query("animation_frames", """
WITH g AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, sum(o_totalprice) AS s FROM orders GROUP BY 1, 2)
SELECT month, o_orderpriority, round(s, 2) AS total, round(max(s) OVER () * 1.1, 2) AS axis_max FROM g""")
def animation_frames(t):
    f = PD.frames(t.orders, month(), "o_orderpriority", "o_totalprice")
    return f.withColumns({c: F.round(c, 2) for c in ["total", "axis_max"]})


@query("category_bars", """
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean, (SELECT round(avg(o_totalprice), 6) FROM orders) AS overall FROM orders GROUP BY 1""")
def category_bars(t):
    return PD.category_bars(t.orders, "o_orderpriority", "o_totalprice").withColumns({c: F.round(c, 6) for c in ["mean", "overall"]})


@query("dashboard_tables", """
WITH r AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
SELECT 'histogram' AS part, CAST(CAST(least(floor((o_totalprice - a) / ((b - a) / 25)), 24) AS INT) AS VARCHAR) AS key, count(*)::DOUBLE AS v1, NULL::DOUBLE AS v2 FROM orders, r GROUP BY 2
UNION ALL SELECT 'means', o_orderpriority, round(avg(o_totalprice), 6), NULL FROM orders GROUP BY 2
UNION ALL SELECT 'shares', o_orderstatus, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6), NULL FROM orders GROUP BY 2
UNION ALL SELECT 'scatter', CAST(o_orderkey AS VARCHAR), o_totalprice, CAST(o_custkey AS DOUBLE) FROM (SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 200)""")
def dashboard_tables(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    row = lambda d, part, key, v1, v2=None: d.select(
        F.lit(part).alias("part"), F.col(key).cast("string").alias("key"), v1.cast("double").alias("v1"),
        (v2 if v2 is not None else F.lit(None)).cast("double").alias("v2"))
    parts = [
        row(PD.histogram(o, "o_totalprice", 25).where("n > 0"), "histogram", "bin", F.col("n")),
        row(PD.category_bars(o, "o_orderpriority", "o_totalprice"), "means", "o_orderpriority", F.round("mean", 6)),
        row(R.share_of_total(o, "o_orderstatus"), "shares", "o_orderstatus", F.round("pct", 6)),
        row(PD.hashed_sample(o, 200, "o_orderkey"), "scatter", "o_orderkey", F.col("o_totalprice"), F.col("o_custkey")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
