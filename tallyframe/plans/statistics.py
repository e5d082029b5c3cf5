"""Statistics queries. Statistics are compared; tail probabilities are unit-tested."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import distributions as D
from tallyframe.operators import features as FE, stats as S
from tallyframe.plans.registry import query

COLS = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]
PAIRS = [(a, b) for i, a in enumerate(COLS) for b in COLS[i + 1:]]


@query("pearson_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr({a}, {b}), 3) + 0.0 AS r FROM lineitem" if a != b else
    f"SELECT '{a}' AS c1, '{a}' AS c2, 1.0::DOUBLE AS r" for a in COLS for b in COLS))
def pearson_matrix(t):
    m = S.correlation_matrix(S.pearson_pairs(t.lineitem, COLS), COLS)
    return m.select("c1", "c2", F.round("r", 3).alias("r"))


RANKS = "rk AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in COLS) + " FROM lineitem)"


@query("spearman_matrix", f"WITH {RANKS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS c1, '{b}' AS c2, round(corr({a}, {b}), 6) AS r FROM rk" for a, b in PAIRS))
def spearman_matrix(t):
    return S.spearman_pairs(t.lineitem, COLS).select("c1", "c2", F.round("r", 6).alias("r"))


@query("kendall_tau", """
WITH s AS (SELECT c_custkey, c_acctbal AS x, count(o_orderkey) AS y FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2),
p AS (SELECT sign(a.x - b.x) * sign(a.y - b.y) AS s, a.x = b.x AS tx, a.y = b.y AS ty FROM s a JOIN s b ON a.c_custkey < b.c_custkey)
SELECT (SELECT count(*) FROM s) AS n, count(*) FILTER (s > 0) AS concordant, count(*) FILTER (s < 0) AS discordant,
  round(sum(s) / sqrt(CAST(count(*) FILTER (NOT tx) AS DOUBLE) * count(*) FILTER (NOT ty)), 8) AS tau FROM p""")
def kendall_tau(t):
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("y"))
    d = t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"))
    return S.kendall_tau(d, "c_acctbal", "y").withColumn("tau", F.round("tau", 8))


@query("pearson_pvalues", " UNION ALL ".join(f"""
SELECT '{a}' AS c1, '{b}' AS c2, count(*) AS n, round(corr({a}, {b}), 6) AS r,
  round(corr({a}, {b}) * sqrt((count(*) - 2) / (1 - pow(corr({a}, {b}), 2))), 4) AS t FROM lineitem""" for a, b in PAIRS))
def pearson_pvalues(t):
    d = S.pearson_pvalues(t.lineitem, COLS)
    return d.select("c1", "c2", "n", F.round("r", 6).alias("r"), F.round("t", 4).alias("t"))


@query("ols_regression")
def ols_regression(t):
    """l_extendedprice ~ l_quantity + l_discount + C(l_returnflag) + l_tax: coefficients and summary in one table."""
    coef, summary, _ = S.ols(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"],
                             {"l_returnflag": FE.fitted_categories(t.lineitem, "l_returnflag")})
    s = summary.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("term"), F.col(c).cast("double").alias("coef")) for c in summary.columns])))
    return coef.unionByName(s, allowMissingColumns=True)


@query("simple_regression", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def simple_regression(t):
    _, summary, beta = S.ols(t.lineitem, "l_extendedprice", ["l_quantity"])
    return summary.select(F.round(F.lit(beta["l_quantity"]), 6).alias("slope"),
                          F.round(F.lit(beta["Intercept"]), 4).alias("intercept"), F.round("r2", 6).alias("r2"))


BINS = 30


@query("residual_diagnostics", f"""
WITH c AS (SELECT regr_slope(o_totalprice, c_acctbal) AS a, regr_intercept(o_totalprice, c_acctbal) AS b
           FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT o_orderkey, a * c_acctbal + b AS fitted, o_totalprice - (a * c_acctbal + b) AS residual FROM orders JOIN customer ON o_custkey = c_custkey, c),
q AS (SELECT *, row_number() OVER (ORDER BY residual, o_orderkey) AS rn, count(*) OVER () AS n, min(residual) OVER () AS lo, max(residual) OVER () AS hi FROM r),
p AS (SELECT *, CASE WHEN rn = 1 THEN 1 - pow(0.5, 1.0 / n) WHEN rn = n THEN pow(0.5, 1.0 / n) ELSE (rn - 0.3175) / (n + 0.365) END::DOUBLE AS p,
  CAST(least(floor((residual - lo) / (hi - lo) * {BINS}), {BINS - 1}) AS INT) AS bin FROM q)
SELECT o_orderkey, round(fitted, 3) AS fitted, round(residual, 3) AS residual, rn, round({D.normal_ppf_sql("p")}, 8) AS theoretical,
  bin, count(*) OVER (PARTITION BY bin) AS bin_rows FROM p""")
def residual_diagnostics(t):
    """Fitted values, residuals, their Q-Q points and the histogram bin each falls into."""
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_acctbal")
    _, _, beta = S.ols(d, "o_totalprice", ["c_acctbal"])
    r = S.with_histogram(S.fitted_residuals(d, "o_totalprice", beta, ["c_acctbal"]), "residual", BINS)
    return S.qq_points(r, "residual", "o_orderkey").select(
        "o_orderkey", F.round("fitted", 3).alias("fitted"), F.round("residual", 3).alias("residual"), "rn", F.round("theoretical", 8).alias("theoretical"),
        "bin", "bin_rows")


@query("vif")
def vif(t):
    return S.vif(t.lineitem, COLS)


@query("ks_normal", f"""
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS s, count(value) AS n FROM events),
v AS (SELECT value, count(*) AS c, sum(count(*)) OVER (ORDER BY value) AS upto FROM events WHERE value IS NOT NULL GROUP BY 1),
z AS (SELECT *, (value - m) / s AS z FROM v, s), f AS (SELECT *, {D.normal_cdf_sql("z")} AS f FROM z),
d AS (SELECT max(greatest(upto / n - f, f - (upto - c) / n)) AS d, min(n) AS n FROM f)
SELECT round(d, 10) AS d, n, round(least(greatest(2 * (SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * n * d * d))
  FROM (SELECT unnest(range(1, 101)) AS k)), 0), 1), 8) AS p FROM d""")
def ks_normal(t):
    k = S.ks_normal(t.events, "value")
    return k.select(F.round("d", 10).alias("d"), "n", F.round("p", 8).alias("p"))


def _mom(x):
    return f"(SELECT '{x}' AS version, count(*)::DOUBLE AS n, avg(pow(v - m, 3)) / pow(min(s), 3) AS g1, avg(pow(v - m, 4)) / pow(min(s), 4) - 3 AS g2 FROM (SELECT {x} AS v, avg({x}) OVER () AS m, stddev_pop({x}) OVER () AS s FROM orders))"


@query("normaltest", f"""
WITH m AS ({" UNION ALL ".join("SELECT * FROM " + _mom(x) for x in ("o_totalprice", "ln(1 + o_totalprice)", "sqrt(o_totalprice)"))}),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2 FROM m),
b AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2,
  (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM a),
c AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS zs, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS aa FROM b),
d AS (SELECT *, (1 - 2 / (9 * aa) - cbrt((1 - 2 / aa) / (1 + x * sqrt(2 / (aa - 4))))) / sqrt(2 / (9 * aa)) AS zk FROM c)
SELECT version, round(zs, 3) AS z_skew, round(zk, 3) AS z_kurt, round(zs * zs + zk * zk, 2) AS k2 FROM d""")
def normaltest(t):
    p = F.col("o_totalprice")
    d = S.normaltest(t.orders, {"o_totalprice": p, "ln(1 + o_totalprice)": F.log1p(p), "sqrt(o_totalprice)": F.sqrt(p)})
    return d.select("version", F.round("z_skew", 3).alias("z_skew"), F.round("z_kurt", 3).alias("z_kurt"), F.round("k2", 2).alias("k2"))


@query("shapiro_wilk")
def shapiro_wilk(t):
    return S.shapiro_wilk(t.events, "value", ["ts", "event_id"])


@query("ttest_one_sample", """
SELECT round(avg(o_totalprice), 4) AS mean, count(*) - 1 AS df,
  round((avg(o_totalprice) - 250000) / (stddev(o_totalprice) / sqrt(count(*))), 6) AS t FROM orders""")
def ttest_one_sample(t):
    d = S.ttest_one_sample(t.orders, "o_totalprice", 250000)
    return d.select(F.round("mean", 4).alias("mean"), "df", F.round("t", 6).alias("t"))


WELCH = """
w AS (SELECT count(*) FILTER (o_orderstatus = 'F') AS n1, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m1, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v1,
             count(*) FILTER (o_orderstatus = 'O') AS n2, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m2, var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS v2 FROM orders)
"""


@query("ttest_welch", f"""
WITH {WELCH} SELECT round(m1, 4) AS m1, round(m2, 4) AS m2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
  round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS df FROM w""")
def ttest_welch(t):
    d = S.ttest_welch(t.orders, "o_totalprice", "o_orderstatus", "F", "O")
    return d.select(F.round("m1", 4).alias("m1"), F.round("m2", 4).alias("m2"), F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("cohens_d", f"""
WITH {WELCH} SELECT round((m1 - m2) / sqrt((v1 + v2) / 2), 6) AS d,
  CASE WHEN abs((m1 - m2) / sqrt((v1 + v2) / 2)) > 0.8 THEN 'large' WHEN abs((m1 - m2) / sqrt((v1 + v2) / 2)) > 0.5 THEN 'medium' ELSE 'small' END AS size FROM w""")
def cohens_d(t):
    d = S.ttest_welch(t.orders, "o_totalprice", "o_orderstatus", "F", "O")
    return d.select(F.round("d", 6).alias("d"), S.effect_size(F.col("d")).alias("size"))


@query("anova_oneway", """
WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) * count(*) AS ss FROM orders GROUP BY 1),
t AS (SELECT avg(o_totalprice) AS gm FROM orders),
s AS (SELECT count(*) AS k, sum(n)::BIGINT AS n, sum(n * pow(m - gm, 2)) AS ssb, sum(ss) AS ssw FROM g, t)
SELECT k - 1 AS df1, n - k AS df2, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f, round(ssb / (ssb + ssw), 8) AS eta2 FROM s""")
def anova_oneway(t):
    a = S.anova(t.orders, "o_totalprice", "o_orderpriority")
    return a.select("df1", "df2", F.round("f", 6).alias("f"), F.round("eta2", 8).alias("eta2"))


@query("posthoc_pairwise", """
WITH g AS (SELECT o_orderpriority AS p, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT a.p AS a, b.p AS b, round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS t FROM g a JOIN g b ON a.p < b.p""")
def posthoc_pairwise(t):
    return S.posthoc_pairwise(t.orders, "o_totalprice", "o_orderpriority", "holm").select("a", "b", F.round("t", 6).alias("t"))


@query("posthoc_corrected")
def posthoc_corrected(t):
    """Holm's p-values of all pairs; the t law has no SQL form."""
    d = S.posthoc_pairwise(t.orders, "o_totalprice", "o_orderpriority", "holm")
    return d.select("a", "b", F.round("t", 6).alias("t"), "p", "p_corr", (F.col("p_corr") < 0.05).alias("differs"))


def _chi(table, a, b):
    yates = """CASE WHEN (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM o) = 1
               THEN sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) ELSE sum(pow(o - e, 2) / e) END"""
    return f"""
WITH o AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {table} GROUP BY 1, 2),
e AS (SELECT o.a, o.b, o, (SELECT sum(o) FROM o x WHERE x.a = o.a) * (SELECT sum(o) FROM o x WHERE x.b = o.b) / (SELECT sum(o) FROM o) AS e FROM o)
SELECT '{a}' AS a, '{b}' AS b, (SELECT sum(o)::BIGINT FROM o) AS n,
  (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM o) AS df, {yates} AS chi2,
  (SELECT least(count(DISTINCT a), count(DISTINCT b)) - 1 FROM o) AS m FROM e"""


CHI = [("lineitem", "l_returnflag", "l_linestatus"), ("orders", "o_orderstatus", "o_orderpriority")]


@query("chi_square", " UNION ALL ".join(
    f"SELECT a, b, n, df, round(chi2, 6) AS chi2 FROM ({_chi(*c)})" for c in CHI))
def chi_square(t):
    return _both(t).select("a", "b", "n", "df", F.round("chi2", 6).alias("chi2"))


def _both(t):
    one = lambda tab, a, b: S.chi_square(getattr(t, tab), a, b).withColumns({"a": F.lit(a), "b": F.lit(b)})
    return one(*CHI[0]).unionByName(one(*CHI[1]))


@query("cramers_v", " UNION ALL ".join(f"SELECT a, b, round(sqrt(chi2 / (n * m)), 8) AS v FROM ({_chi(*c)})" for c in CHI))
def cramers_v(t):
    return _both(t).select("a", "b", F.round("v", 8).alias("v"))


LAMBDAS = [-1.0, -0.5, 0.0, 0.5, 1.0, 2.0]


def _bc(l):
    tr = "ln(o_totalprice)" if l == 0 else f"(pow(o_totalprice, {l}) - 1) / {l}"
    return f"SELECT {l}::DOUBLE AS lambda, round(-count(*) / 2 * ln(var_pop({tr})) + ({l} - 1) * sum(ln(o_totalprice)), 2) AS llf FROM orders"


@query("box_cox", f"WITH b AS ({' UNION ALL '.join(map(_bc, LAMBDAS))}) SELECT *, llf = (SELECT max(llf) FROM b) AS best FROM b")
def box_cox(t):
    return S.box_cox_grid(t.orders, "o_totalprice", LAMBDAS).withColumn("llf", F.round("llf", 2))
