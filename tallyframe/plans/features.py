"""Feature queries (the ones that fit models are in ``models``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import features as FE
from tallyframe.plans import views
from tallyframe.plans.registry import query

KEY = ["l_orderkey", "l_linenumber"]


def li(t, *cols):
    return t.lineitem.select(*KEY, *cols)


@query("ratio_features", """
WITH s AS (SELECT o_custkey, sum(o_totalprice) AS debt, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey, round(debt / n / nullif(c_acctbal, 0), 6) AS instalment_ratio, round(debt / nullif(c_acctbal, 0), 6) AS debt_ratio,
       round(debt / nullif(c_acctbal * 12, 0), 6) AS credit_multiple, round(c_acctbal - debt / n, 6) AS free_income
FROM customer JOIN s ON c_custkey = o_custkey""")
def ratio_features(t):
    s = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("debt"), F.count(F.lit(1)).alias("n"))
    d = t.customer.join(s, F.col("c_custkey") == F.col("o_custkey"))
    bal, debt, part = F.col("c_acctbal"), F.col("debt"), F.col("debt") / F.col("n")
    return d.select("c_custkey", F.round(FE.ratio(part, bal), 6).alias("instalment_ratio"),
                    F.round(FE.ratio(debt, bal), 6).alias("debt_ratio"),
                    F.round(FE.ratio(debt, bal * 12), 6).alias("credit_multiple"),
                    F.round(bal - part, 6).alias("free_income"))


@query("cut_bins", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 1 THEN NULL WHEN l_quantity <= 10 THEN 'low' WHEN l_quantity <= 30 THEN 'mid'
  WHEN l_quantity <= 45 THEN 'high' END AS band FROM lineitem""")
def cut_bins(t):
    return li(t, FE.cut("l_quantity", [1, 10, 30, 45], ["low", "mid", "high"]).alias("band"))


@query("qcut_bins", """
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM orders)
SELECT o_orderkey, CAST(greatest(len(list_filter(e, lambda x: x < o_totalprice)) - 1, 0) AS INT) AS bin FROM orders, e""")
def qcut_bins(t):
    return FE.qcut(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 5).select("o_orderkey", "bin")


def _skew(x):
    return f"""(SELECT round(avg(pow({x} - m, 3)) / pow(min(s), 3), 5)
        FROM orders, (SELECT avg({x}) AS m, stddev_pop({x}) AS s FROM orders))"""


@query("log_sqrt_features", f"""
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price, round(sqrt(o_totalprice), 6) AS root_price,
  {_skew("o_totalprice")} AS skew_raw, {_skew("ln(1 + o_totalprice)")} AS skew_log, {_skew("sqrt(o_totalprice)")} AS skew_root FROM orders""")
def log_sqrt_features(t):
    p = F.col("o_totalprice")
    s = t.orders.agg(F.skewness(p).alias("a"), F.skewness(F.log1p(p)).alias("b"), F.skewness(F.sqrt(p)).alias("c"))
    from tallyframe.operators.ordered import one_row

    return t.orders.select("o_orderkey", p).withColumn("s", one_row(s)).select(
        "o_orderkey", F.round(F.log1p(p), 6).alias("log_price"), F.round(F.sqrt(p), 6).alias("root_price"),
        F.round("s.a", 5).alias("skew_raw"), F.round("s.b", 5).alias("skew_log"), F.round("s.c", 5).alias("skew_root"))


@query("interaction_terms", f"""
WITH {views.DIRTY_LINEITEM}, f AS (SELECT l_orderkey, l_linenumber,
  coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM dl)) AS q, l_extendedprice AS p,
  coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM dl)) AS d FROM dl)
SELECT l_orderkey, l_linenumber, round(q * p, 3) AS qp, round(q * d, 5) AS qd, round(p * d, 6) AS pd FROM f""")
def interaction_terms(t):
    c = ["l_quantity", "l_extendedprice", "l_discount"]
    d = FE.interaction_terms(views.dirty_lineitem(t), c)
    return d.select(*KEY, F.round("l_quantity__l_extendedprice", 3).alias("qp"), F.round("l_quantity__l_discount", 5).alias("qd"),
                    F.round("l_extendedprice__l_discount", 6).alias("pd"))


@query("calendar_features", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(isodow(o_orderdate) - 1 AS INT) AS weekday, CAST(dayofyear(o_orderdate) AS INT) AS day_of_year,
  CAST(week(o_orderdate) AS INT) AS iso_week, CAST(quarter(o_orderdate) AS INT) AS quarter,
  CAST(isodow(o_orderdate) >= 6 AS INT) AS is_weekend, CAST(month(o_orderdate) <= 3 AS INT) AS is_first_quarter,
  CAST(month(o_orderdate) >= 10 AS INT) AS is_last_quarter FROM orders""")
def calendar_features(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in FE.calendar_features(F.col("o_orderdate")).items()])


@query("cyclic_features", """
SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 6) AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) AS month_cos,
  round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) AS weekday_sin, round(cos(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) AS weekday_cos
FROM orders""")
def cyclic_features(t):
    return t.orders.select("o_orderkey", *[
        F.round(c, 6).alias(n) for n, c in FE.cyclic_features(F.col("o_orderdate")).items()])


def late_orders(t):
    """Orders with their customer's nation and a 0/1 target: still open."""
    return t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_nationkey", (F.col("o_orderstatus") == "O").cast("double").alias("y"))


LATE = """lo AS (SELECT o_orderkey, o_orderdate, c_nationkey, CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0 END AS y
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("target_encode", f"""
WITH {LATE}, tr AS (SELECT * FROM lo WHERE o_orderdate < DATE '2000-01-01' AND c_nationkey <> 7),
g AS (SELECT avg(y) AS g FROM tr), s AS (SELECT c_nationkey AS k, count(*) AS n, sum(y) AS s FROM tr GROUP BY 1)
SELECT o_orderkey, round(coalesce((s + 10 * g) / (n + 10), g), 6) AS encoded FROM lo LEFT JOIN s ON c_nationkey = k, g
WHERE o_orderdate >= DATE '2000-01-01'""")
def target_encode(t):
    d = late_orders(t)
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    train = d.where((F.col("o_orderdate") < cut) & (F.col("c_nationkey") != 7))
    return FE.target_encode(train, d.where(F.col("o_orderdate") >= cut), "c_nationkey", "y").select(
        "o_orderkey", F.round("encoded", 6).alias("encoded"))


@query("target_encode_loo", f"""
WITH {LATE} SELECT o_orderkey, round((sum(y) OVER w - y) / (count(*) OVER w - 1), 6) AS encoded FROM lo WINDOW w AS (PARTITION BY c_nationkey)""")
def target_encode_loo(t):
    return FE.target_encode_loo(late_orders(t), "c_nationkey", "y").select("o_orderkey", F.round("encoded", 6).alias("encoded"))


@query("standard_scale", """
WITH p AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - m1) / s1, 6) AS l_quantity, round((l_extendedprice - m2) / s2, 6) AS l_extendedprice FROM lineitem, p""")
def standard_scale(t):
    c = ["l_quantity", "l_extendedprice"]
    return FE.standard_scale(li(t, *c), c).select(*KEY, *[F.round(x, 6).alias(x) for x in c])


@query("minmax_scale", """
WITH p AS (SELECT min(l_quantity) AS a1, max(l_quantity) AS b1, min(l_extendedprice) AS a2, max(l_extendedprice) AS b2 FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - a1) / nullif(b1 - a1, 0), 6) AS l_quantity,
  round((l_extendedprice - a2) / nullif(b2 - a2, 0), 6) AS l_extendedprice FROM lineitem, p""")
def minmax_scale(t):
    c = ["l_quantity", "l_extendedprice"]
    return FE.minmax_scale(li(t, *c), c).select(*KEY, *[F.round(x, 6).alias(x) for x in c])


@query("robust_scale", """
WITH p AS (SELECT quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - a[2]) / (a[3] - a[1]), 6) AS l_quantity,
  round((l_extendedprice - b[2]) / (b[3] - b[1]), 6) AS l_extendedprice FROM lineitem, p""")
def robust_scale(t):
    c = ["l_quantity", "l_extendedprice"]
    return FE.robust_scale(li(t, *c), c).select(*KEY, *[F.round(x, 6).alias(x) for x in c])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"""CAST(o_orderpriority = '{p}' AS INT) AS "o_orderpriority={p}" """ for p in PRIORITIES) + " FROM orders")
def one_hot(t):
    cats = FE.fitted_categories(t.orders, "o_orderpriority")
    return FE.one_hot(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", cats).drop("o_orderpriority")


@query("one_hot_sparse", """
WITH tr AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
ix AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, md5(CAST(o_custkey AS VARCHAR))) - 1 AS i FROM tr WHERE o_custkey IS NOT NULL GROUP BY 1)
SELECT o_orderkey, CAST((SELECT count(*) FROM ix) AS INT) AS size, CAST(i AS INT) AS position, CAST(i IS NOT NULL AS INT) AS entries
FROM orders LEFT JOIN ix USING (o_custkey)""")
def one_hot_sparse(t):
    """Customers as categories: fitted on the orders before 2000, so later customers are unknown."""
    train = t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    d = FE.one_hot_sparse(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", FE.category_index(train, "o_custkey"))
    return d.select("o_orderkey", "hot.size", F.try_element_at("hot.indices", F.lit(1)).alias("position"), F.size("hot.values").alias("entries"))


@query("ordinal_encode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 3 ELSE -1 END AS rank
FROM orders""")
def ordinal_encode(t):
    return t.orders.select("o_orderkey", FE.ordinal("o_orderpriority", ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]).alias("rank"))


CT_NUM = ["o_totalprice", "c_acctbal"]


@query("column_transformer", f"""
WITH {views.DIRTY_ORDERS}, x AS (SELECT o_orderkey, o_orderdate, o_totalprice, c_acctbal, o_orderpriority, o_orderstatus
  FROM dorders JOIN customer ON o_custkey = c_custkey),
tr AS (SELECT * FROM x WHERE o_orderdate < DATE '2000-01-01'),
md AS (SELECT quantile_cont(o_totalprice, 0.5) AS m1, quantile_cont(c_acctbal, 0.5) AS m2,
  (SELECT o_orderpriority FROM tr WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mp FROM tr),
q AS (SELECT quantile_cont(coalesce(o_totalprice, m1), [0.25, 0.5, 0.75]) AS a, quantile_cont(coalesce(c_acctbal, m2), [0.25, 0.5, 0.75]) AS b
      FROM tr, md),
te AS (SELECT o_orderkey, coalesce(o_totalprice, m1) AS p, coalesce(c_acctbal, m2) AS b0, coalesce(o_orderpriority, mp) AS op, o_orderstatus AS s
       FROM x, md WHERE o_orderdate >= DATE '2000-01-01')
SELECT o_orderkey, round((p - a[2]) / (a[3] - a[1]), 6) AS o_totalprice, round((b0 - b[2]) / (b[3] - b[1]), 6) AS c_acctbal,
  CAST(s = 'F' AS INT) AS "o_orderstatus=F", CAST(s = 'O' AS INT) AS "o_orderstatus=O", CAST(s = 'P' AS INT) AS "o_orderstatus=P",
  CASE op WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 ELSE 4 END AS o_orderpriority_rank
FROM te, q""")
def column_transformer(t):
    d = views.dirty_orders(t).join(t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    train, test = d.where(F.col("o_orderdate") < cut), d.where(F.col("o_orderdate") >= cut)
    cats = FE.fitted_categories(train, "o_orderstatus")
    out = FE.column_transformer(train, test, "o_orderkey", CT_NUM, {"o_orderstatus": cats}, {"o_orderpriority": PRIORITIES[::-1]})
    return out.withColumns({c: F.round(c, 6) for c in CT_NUM})


VT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("variance_threshold", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(var_pop({c}), 4) AS variance, var_pop({c}) > 0.01 AS keep FROM lineitem""" for c in VT))
def variance_threshold(t):
    return FE.variance_threshold(t.lineitem, VT).withColumn("variance", F.round("variance", 4))


def _fscore(c, g, table):
    return f"""SELECT '{c}' AS "column", round((sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))), 6) AS f
    FROM (SELECT {g}, count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS ss FROM {table} GROUP BY 1),
         (SELECT avg({c}) AS gm FROM {table})"""


@query("select_k_best_f", "SELECT * FROM (" + " UNION ALL ".join(_fscore(c, "l_returnflag", "lineitem") for c in VT)
       + ") ORDER BY f DESC LIMIT 2")
def select_k_best_f(t):
    f = FE.f_scores(t.lineitem, VT, "l_returnflag")
    return f.select("column", F.round("f", 6).alias("f")).orderBy(F.desc("f"), "column").limit(2)


@query("mutual_information", """
WITH b AS (SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x, l_returnflag AS y FROM lineitem),
j AS (SELECT x, y, count(*) AS n FROM b GROUP BY 1, 2), px AS (SELECT x, count(*) AS nx FROM b GROUP BY 1),
py AS (SELECT y, count(*) AS ny FROM b GROUP BY 1), tt AS (SELECT count(*) AS t FROM b)
SELECT round(sum(n / t * ln(n * t / (nx * ny))), 8) AS mi FROM j JOIN px USING (x) JOIN py USING (y), tt""")
def mutual_information(t):
    b = t.lineitem.select(F.floor(F.col("l_quantity") / 5).alias("x"), F.col("l_returnflag").alias("y"))
    return FE.mutual_information(b, "x", "y").select(F.round("mi", 8).alias("mi"))
