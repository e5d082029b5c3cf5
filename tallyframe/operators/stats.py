"""Correlation, regression and hypothesis tests. Rows are reduced to sufficient
statistics (counts, sums, cross products) on the executors; only those reach a test formula."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions import distributions as D
from tallyframe.operators.features import column_pairs
from tallyframe.operators.ordered import bucketize, lookup_join, null_safe_join, one_row, prefix_sums, row_index, value_ranks
from tallyframe.session import checkpointed


# -- correlation -----------------------------------------------------------------------------

def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per pair c1 < c2: r and n, all pairs in one pass."""
    pairs = column_pairs(cols)
    one = df.agg(*[e for i, (a, b) in enumerate(pairs) for e in (
        F.corr(a, b).alias(f"r{i}"), F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("c1"), F.lit(b).alias("c2"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"))
        for i, (a, b) in enumerate(pairs)])))


def correlation_matrix(pairs: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairs mirrored, with the unit diagonal, in long form."""
    p = pairs.select("c1", "c2", "r")
    diag = p.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "c1 string, c2 string, r double")
    return p.unionByName(p.select(F.col("c2").alias("c1"), F.col("c1").alias("c2"), "r")).unionByName(diag)


def spearman_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson on tie-averaged ranks. Ranks are found on distinct values and joined back."""
    base = d = df.select(*cols).na.drop()
    for c in cols:
        d = lookup_join(d, value_ranks(base, c).select(c, F.col("avg_rank").alias(f"rank_{c}")), [c])
    return pearson_pairs(d.select(*[F.col(f"rank_{c}").alias(c) for c in cols]), cols)


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("n.s.")


def pearson_pvalues(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    d = pearson_pairs(df, cols)
    t = F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r")))
    d = d.withColumn("t", t).withColumn("p", D.t_pvalue(F.col("t"), F.col("n") - 2))
    return d.withColumn("stars", stars(F.col("p")))


def kendall_tau(df: DataFrame, x: str, y: str, bits: int = 40) -> DataFrame:
    """Tau-b with ties, without forming pairs.

    y becomes its dense rank. For each bit of the rank, rows with the same
    higher bits form a group; in it every row with bit 0 counts the rows of
    smaller x with bit 1. Each discordant pair is met once, at the highest bit
    where the ranks differ, so n·log(n) rows replace n² pairs.
    """
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    cells = d.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    yr = prefix_sums(cells.groupBy("y").agg(F.sum("n").alias("n")), {"r": F.lit(1).cast("long")}, "y", None,
                     inclusive=False).select("y", "r")
    c = lookup_join(cells, yr, ["y"])  # few values of y would each be a hot key
    top = yr.agg(F.coalesce(F.max("r"), F.lit(0))).scalar()
    levels = F.sequence(F.lit(0), F.greatest(F.length(F.bin(F.col("top"))) - 1, F.lit(0)))
    e = c.withColumn("top", top).select("x", "n", "r", F.explode(levels).alias("b"))
    e = e.select(
        "b", F.expr("shiftright(r, b + 1)").alias("g"), "x",
        F.when(F.expr("shiftright(r, b) & 1") == 1, F.col("n")).otherwise(0).alias("ones"),
        F.when(F.expr("shiftright(r, b) & 1") == 0, F.col("n")).otherwise(0).alias("zeros"),
    ).groupBy("b", "g", "x").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    e = prefix_sums(e, {"before": F.col("ones")}, "x", None, by=["b", "g"], inclusive=False)
    big = lambda c: F.col(c).cast("decimal(19,0)")  # products of counts pass 64 bits from about 3e9 rows
    dis = e.agg(F.sum(big("zeros") * big("before")).cast("double")).scalar()
    pairs = lambda n: n.cast("double") * (n - 1) / 2
    ties = lambda k: cells.groupBy(*k).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    base = cells.agg(F.sum("n").alias("n")).select(
        "n", F.coalesce(dis, F.lit(0.0)).alias("discordant"), ties(["x"]).alias("tx"), ties(["y"]).alias("ty"),
        ties(["x", "y"]).alias("txy"))
    n0 = pairs(F.col("n"))
    con = n0 - F.col("tx") - F.col("ty") + F.col("txy") - F.col("discordant")
    return base.select(
        "n", con.cast("long").alias("concordant"), F.col("discordant").cast("long").alias("discordant"),
        F.try_divide(con - F.col("discordant"), F.sqrt((n0 - F.col("tx")) * (n0 - F.col("ty")))).alias("tau"))


# -- group statistics and mean tests -----------------------------------------------------------

def group_stats(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Long form (column, group, n, mean, var sample) from one grouped aggregate."""
    one = df.groupBy(by).agg(*[e for c in cols for e in (
        F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.var_samp(c).alias(f"v_{c}"))])
    return one.select(F.col(by).alias("group"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"m_{c}").alias("mean"),
                 F.coalesce(f"v_{c}", F.lit(0.0)).alias("var")) for c in cols])))


def anova_from_groups(gs: DataFrame) -> DataFrame:
    g = gs.groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean")).alias("sx"),
        F.sum((F.col("n") - 1) * F.col("var")).alias("ssw"))
    d = gs.select("column", F.col("n").alias("gn"), F.col("mean").alias("gm")).join(
        g.withColumn("gmean", F.col("sx") / F.col("n")), "column")
    s = d.groupBy("column", "k", "n", "ssw").agg(
        F.sum(F.col("gn") * F.pow(F.col("gm") - F.col("gmean"), 2)).alias("ssb"))
    s = s.withColumns({"df1": F.col("k") - 1, "df2": F.col("n") - F.col("k")})
    s = s.withColumn("f", F.try_divide(F.col("ssb") / F.col("df1"), F.col("ssw") / F.col("df2")))
    return s.withColumn("eta2", F.col("ssb") / (F.col("ssb") + F.col("ssw")))


def anova(df: DataFrame, col: str, by: str) -> DataFrame:
    a = anova_from_groups(group_stats(df, [col], by))
    return a.withColumn("p", D.f_pvalue(F.col("f"), F.col("df1"), F.col("df2")))


def ttest_one_sample(df: DataFrame, col: str, popmean: float) -> DataFrame:
    s = df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"), F.count(col).alias("n"))
    s = s.withColumn("t", (F.col("mean") - popmean) / (F.col("sd") / F.sqrt("n"))).withColumn("df", F.col("n") - 1)
    return s.withColumn("p", D.t_pvalue(F.col("t"), F.col("df")))


def _welch(d: DataFrame) -> DataFrame:
    """Adds t, df and Cohen's d to rows holding n1, m1, v1, n2, m2, v2."""
    a, b = F.try_divide("v1", "n1"), F.try_divide("v2", "n2")
    diff = F.col("m1") - F.col("m2")
    return d.withColumns({
        "t": F.try_divide(diff, F.sqrt(a + b)),
        "df": F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col("n1") - 1) + F.try_divide(b * b, F.col("n2") - 1)),
        "d": F.try_divide(diff, F.sqrt((F.col("v1") + F.col("v2")) / 2)),
    })


def ttest_welch(df: DataFrame, col: str, by: str, first, second) -> DataFrame:
    part = lambda v, i: [
        F.count(F.when(F.col(by) == v, F.col(col))).alias(f"n{i}"), F.avg(F.when(F.col(by) == v, F.col(col))).alias(f"m{i}"),
        F.var_samp(F.when(F.col(by) == v, F.col(col))).alias(f"v{i}")]
    d = _welch(df.where(F.col(by).isin(first, second)).agg(*part(first, 1), *part(second, 2)))
    return d.withColumn("p", D.t_pvalue(F.col("t"), F.col("df")))


def effect_size(d: Column) -> Column:
    return F.when(F.abs(d) > 0.8, "large").when(F.abs(d) > 0.5, "medium").otherwise("small")


def posthoc_pairwise(df: DataFrame, col: str, by: str, correction: str = "none", blocks: int = 16) -> DataFrame:
    """t and p of each pair of groups a < b, with ``p_corr`` by Bonferroni or Holm.

    Works on one row per group. Groups fall into ``blocks`` parts by hash, and parts meet part by part, so no task holds all
    groups. Groups of one row have no variance and give null p; a null group takes no part.
    """
    gs = group_stats(df.where(F.col(by).isNotNull()), [col], by).select("group", "n", "mean", "var")
    gs = checkpointed(gs.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(blocks)).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    side = lambda i, own, met: gs.select(
        F.col("group").alias("ab"[i - 1]), F.col("n").alias(f"n{i}"), F.col("mean").alias(f"m{i}"), F.col("var").alias(f"v{i}"),
        F.col("part").alias(own), other.alias(met))
    pairs = side(1, "pa", "pb").join(side(2, "pb", "pa"), ["pa", "pb"]).where("a < b").drop("pa", "pb")
    d = _welch(pairs)
    d = d.withColumn("p", D.t_pvalue(F.col("t"), F.col("df")))
    if correction == "none":
        return d.withColumn("p_corr", F.col("p"))
    d = checkpointed(d)
    m = d.where("p IS NOT NULL").count()
    if correction == "bonferroni":
        return d.withColumn("p_corr", F.least(F.col("p") * m, F.lit(1.0)))
    # Holm: the running maximum of p times what is left; buckets of p carry the maximum of the buckets before them
    d = d.withColumn("pair", F.xxhash64("a", "b"))
    known = row_index(d.where("p IS NOT NULL"), "p", "pair")
    known = bucketize(known.withColumn("h", F.least(F.col("p") * (m - F.col("rn") + 1), F.lit(1.0))), "rn")
    local = F.max("h").over(W.partitionBy("__b").orderBy("rn").rowsBetween(W.unboundedPreceding, 0))
    tops = known.groupBy("__b").agg(F.max("h").alias("top"))
    before = tops.select("__b", F.max("top").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    done = known.withColumn("h", local).join(before, "__b").withColumn("p_corr", F.greatest("h", "before"))
    out = done.select(*[c for c in d.columns if c != "pair"], "p_corr")
    return out.unionByName(d.where("p IS NULL").drop("pair").withColumn("p_corr", F.lit(None).cast("double")))


# -- contingency -------------------------------------------------------------------------------

def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed ``o`` and expected ``e`` of each cell that occurs, with its marginals ``na``, ``nb`` and the total ``n``.

    Rows with a null label take no part. Cells that do not occur are not formed: their number is that of both label sets
    multiplied, and what they add to the statistics follows from the marginals.
    """
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(
        F.count(F.lit(1)).alias("o"))
    cells = checkpointed(cells)
    margin = lambda c: cells.groupBy(c).agg(F.sum("o").alias(f"n{c}"))
    d = lookup_join(lookup_join(cells, margin("a"), ["a"]), margin("b"), ["b"])
    d = d.withColumn("n", one_row(cells.agg(F.sum("o").alias("n")))["n"])
    return d.withColumn("e", F.col("na").cast("double") * F.col("nb") / F.col("n"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square (Yates only for 2 by 2), df, p and Cramér's V; nulls where a variable has fewer than two labels.

    An empty cell adds its expected count, so all empty cells add what the cells that occur leave of n. In a table of 2 by 2 all
    four gaps are equal and the sum of 1/e is n times the sums of both inverse marginals.
    """
    d = checkpointed(contingency(df, a, b))
    gap = F.col("o") - F.col("e")
    margin = lambda c, k, inv: one_row(d.groupBy(c).agg(F.first(f"n{c}").alias("m")).agg(
        F.count(F.lit(1)).alias(k), F.sum(1 / F.col("m").cast("double")).alias(inv)))
    s = d.agg(F.count(F.lit(1)).alias("seen"), F.max("n").alias("n"), F.sum(gap * gap / F.col("e")).alias("part"),
              F.sum("e").alias("covered"), F.max(F.abs(gap)).alias("gap"))
    s = s.select("*", margin("a", "r", "ia").alias("__a"), margin("b", "c", "ib").alias("__b")).select("*", "__a.*", "__b.*")
    empty = F.when(F.col("seen") == F.col("r") * F.col("c"), F.lit(0.0)).otherwise(F.col("n") - F.col("covered"))
    yates = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * F.col("n") * F.col("ia") * F.col("ib")
    s = s.withColumn("df", (F.col("r") - 1) * (F.col("c") - 1))
    s = s.withColumn("chi2", F.when(F.col("df") == 1, yates).when(F.col("df") > 1, F.col("part") + empty))
    s = s.withColumn("p", F.when(F.col("chi2").isNotNull(), D.chi2_pvalue(F.col("chi2"), F.col("df"))))
    s = s.withColumn("v", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.least("r", "c") - 1))))
    return s.select("r", "c", "n", "df", "chi2", "p", "v")


# -- normality ---------------------------------------------------------------------------------

def normaltest(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """D'Agostino-Pearson K² from skewness and kurtosis, p = exp(-K²/2)."""
    one = df.agg(*[e for n, c in cols.items() for e in (
        F.count(c).cast("double").alias(f"n_{n}"), F.skewness(c).alias(f"s_{n}"), F.kurtosis(c).alias(f"k_{n}"))])
    d = one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("version"), F.col(f"n_{n}").alias("n"), F.col(f"s_{n}").alias("skew"),
                 F.col(f"k_{n}").alias("kurt")) for n in cols])))
    n = F.col("n")
    # skewness to a normal score (D'Agostino 1970)
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (b2 - 1))
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    d = d.withColumn("z_skew", delta * F.log(y / alpha + F.sqrt(F.pow(y / alpha, 2) + 1)))
    # kurtosis to a normal score (Anscombe and Glynn 1983)
    e = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurt") + 3 - e) / F.sqrt(var)
    sb1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / sb1 * (2 / sb1 + F.sqrt(1 + 4 / (sb1 * sb1)))
    den = 1 + x * F.sqrt(2 / (a - 4))
    term = F.cbrt((1 - 2 / a) / den)
    d = d.withColumn("z_kurt", (1 - 2 / (9 * a) - term) / F.sqrt(2 / (9 * a)))
    d = d.withColumn("k2", F.col("z_skew") * F.col("z_skew") + F.col("z_kurt") * F.col("z_kurt"))
    return d.withColumn("p", F.exp(-F.col("k2") / 2))


def ks_normal(df: DataFrame, col: str) -> DataFrame:
    """One-sample Kolmogorov-Smirnov against N(mean, population std); asymptotic p."""
    p = one_row(df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s"), F.count(col).alias("n")))
    vc = value_ranks(df, col).withColumn("__p", p)
    below = F.col("avg_rank") - (F.col("cnt") + 1) / 2
    d = vc.withColumn("cdf", D.normal_cdf_column((F.col(col) - F.col("__p.m")) / F.col("__p.s")))
    gap = F.greatest((below + F.col("cnt")) / F.col("__p.n") - F.col("cdf"), F.col("cdf") - below / F.col("__p.n"))
    s = d.agg(F.max(gap).alias("d"), F.max("__p.n").alias("n"))
    return s.withColumn("p", D.kolmogorov_pvalue(F.sqrt("n") * F.col("d")))


def shapiro_w(values) -> float:
    """Royston's W of a short sorted-able sample."""
    x = np.sort(np.asarray(values, float))
    n = len(x)
    m = D.normal_ppf((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    mm = float(m @ m)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0, math.sqrt(0.5)])
    else:
        c = m / math.sqrt(mm)
        u = 1 / math.sqrt(n)
        # fixed values: Royston (1995) polynomial weights for the two largest order statistics
        an = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, c[-1]], u)
        a = np.empty(n)
        if n > 5:
            an1 = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, c[-2]], u)
            phi = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an ** 2 - 2 * an1 ** 2)
            a[2:-2] = m[2:-2] / math.sqrt(phi)
            a[1], a[-2] = -an1, an1
        else:
            phi = (mm - 2 * m[-1] ** 2) / (1 - 2 * an ** 2)
            a[1:-1] = m[1:-1] / math.sqrt(phi)
        a[0], a[-1] = -an, an
    return float((a @ x) ** 2 / np.sum((x - x.mean()) ** 2))


def shapiro_pvalue(w: float, n: int) -> float:
    """Royston's normal approximation of the tail (4 <= n <= 5000)."""
    if n <= 11:
        g = -2.273 + 0.459 * n
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sd = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
        z = (-math.log(g - math.log(1 - w)) - mu) / sd
    else:
        ln = math.log(n)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sd = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
        z = (math.log(1 - w) - mu) / sd
    return float(D.normal_sf(z))


def shapiro_wilk(df: DataFrame, col: str, order: Sequence[str], n: int = 500) -> DataFrame:
    """W over the first n values (the test's own sample rule; n is capped at 5000).

    The top-k sort is distributed; only those n values meet in one task.
    """
    if n > 5000:
        raise ValueError("the approximation holds up to 5000 values")
    first = df.where(F.col(col).isNotNull()).orderBy(*order).limit(n).select(F.col(col).cast("double").alias("v"))
    one = first.agg(F.collect_list("v").alias("vs"))

    @F.pandas_udf("w double, p double")
    def test(vs):
        import pandas as pd

        ws = [shapiro_w(v) for v in vs]
        return pd.DataFrame({"w": ws, "p": [shapiro_pvalue(w, len(v)) for w, v in zip(ws, vs)]})

    return one.select(F.size("vs").alias("n"), test("vs").alias("r")).select("n", "r.w", "r.p")


def box_cox_grid(df: DataFrame, col: str, lambdas: Sequence[float]) -> DataFrame:
    """Profile log-likelihood per lambda, all in one pass; ``best`` marks the largest."""
    x = F.col(col)
    out = []
    for i, l in enumerate(lambdas):
        tr = F.log(x) if l == 0 else (F.pow(x, F.lit(float(l))) - 1) / l
        out.append(F.var_pop(tr).alias(f"v{i}"))
    one = df.agg(F.count(col).alias("n"), F.sum(F.log(x)).alias("sl"), *out)
    d = one.select(F.inline(F.array(*[
        F.struct(F.lit(float(l)).alias("lambda"),
                 (-F.col("n") / 2 * F.log(f"v{i}") + (l - 1) * F.col("sl")).alias("llf")) for i, l in enumerate(lambdas)])))
    best = d.agg(F.max_by("lambda", "llf")).scalar()
    return d.withColumn("best", F.col("lambda") == best)


# -- regression --------------------------------------------------------------------------------

def design_columns(numeric: Sequence[str], categories: dict[str, Sequence[str]]) -> dict[str, Column]:
    """Intercept, numeric columns, and treatment dummies with the first level dropped."""
    cols = {"Intercept": F.lit(1.0)}
    for c, levels in categories.items():
        cols |= {f"{c}[{v}]": (F.col(c) == v).cast("double") for v in list(levels)[1:]}
    return cols | {c: F.col(c).cast("double") for c in numeric}


def normal_sums(df: DataFrame, design: dict[str, Column], y: str) -> DataFrame:
    """X'X, X'y, y'y, sum y and n in one aggregate; its size depends on the columns only."""
    names = list(design)
    k = len(names)
    d = df.select(F.col(y).cast("double").alias("__y"), *[c.alias(f"x{i}") for i, c in enumerate(design.values())]).na.drop()
    aggs = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"a{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.sum(F.col(f"x{i}") * F.col("__y")).alias(f"b{i}") for i in range(k)]
    return d.agg(*aggs, F.sum(F.col("__y") * F.col("__y")).alias("yy"), F.sum("__y").alias("sy"), F.count(F.lit(1)).alias("n"))


def ols(df: DataFrame, y: str, numeric: Sequence[str], categories: dict[str, Sequence[str]] | None = None):
    """Fit by the normal equations. Returns (coefficient table, summary table).

    The driver solves a system as large as the number of columns.
    """
    design = design_columns(numeric, categories or {})
    names, k = list(design), len(design)
    row = normal_sums(df, design, y).first().asDict()
    a = np.array([[row[f"a{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
    b = np.array([row[f"b{i}"] for i in range(k)], float)
    n, yy, sy = row["n"], row["yy"], row["sy"]
    scale = np.sqrt(np.diag(a))
    inv = np.linalg.inv(a / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inv @ b
    rss = float(yy - beta @ b)
    tss = yy - sy * sy / n
    dfr = n - k
    se = np.sqrt(np.diag(inv) * rss / dfr)
    t = beta / se
    half = D.t_ppf(0.975, dfr) * se
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(rss / n) + 1)
    r2 = 1 - rss / tss
    f = ((tss - rss) / (k - 1)) / (rss / dfr) if k > 1 else float("nan")
    spark = df.sparkSession
    coef = spark.createDataFrame(
        [(nm, *map(float, v)) for nm, *v in zip(names, beta, se, t, D.t_sf2(t, dfr), beta - half, beta + half)],
        "term string, coef double, std_err double, t double, p double, ci_low double, ci_high double")
    summary = spark.createDataFrame(
        [(n, float(r2), float(1 - (1 - r2) * (n - 1) / dfr), float(f), float(D.f_sf(f, k - 1, dfr)),
          float(2 * k - 2 * llf), float(k * math.log(n) - 2 * llf), float(rss))],
        "n long, r2 double, adj_r2 double, f double, f_p double, aic double, bic double, rss double")
    return coef, summary, dict(zip(names, map(float, beta)))


def fitted_residuals(df: DataFrame, y: str, beta: dict[str, float], numeric: Sequence[str],
                     categories: dict[str, Sequence[str]] | None = None) -> DataFrame:
    design = design_columns(numeric, categories or {})
    fit = sum((c * beta[n] for n, c in design.items()), F.lit(0.0))
    return df.withColumn("fitted", fit).withColumn("residual", F.col(y) - F.col("fitted"))


def with_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Adds the equal-width ``bin`` of each row (0 to bins - 1; the largest value is in the last) and the rows in it, ``bin_rows``.

    Nulls have no bin; where all values are equal the bin is 0.
    """
    p = one_row(df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")))
    part = F.coalesce(F.try_divide(F.col(col) - p["lo"], p["hi"] - p["lo"]), F.lit(0.0))
    d = df.withColumn("bin", F.when(F.col(col).isNotNull(), F.least(F.floor(part * bins), F.lit(bins - 1)).cast("int")))
    counts = d.where("bin IS NOT NULL").groupBy("bin").agg(F.count(F.lit(1)).alias("bin_rows"))
    return d.join(F.broadcast(counts), "bin", "left")  # one row a bin


def qq_points(df: DataFrame, col: str, tie: str) -> DataFrame:
    """Ordered values against normal quantiles with Filliben's plotting positions."""
    d = row_index(df.where(F.col(col).isNotNull()), col, tie)
    n = df.agg(F.count(col)).scalar()
    d = d.withColumn("n", n)
    first = 1 - F.pow(F.lit(0.5), 1 / F.col("n"))
    pos = F.when(F.col("rn") == 1, first).when(F.col("rn") == F.col("n"), 1 - first).otherwise(
        (F.col("rn") - 0.3175) / (F.col("n") + 0.365))
    return d.withColumn("theoretical", D.normal_ppf_column(pos)).drop("n")


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Diagonal of the inverse correlation matrix; the matrix comes from one aggregate."""
    k = len(cols)
    m = np.eye(k)
    for r in pearson_pairs(df, cols).collect():
        i, j = cols.index(r["c1"]), cols.index(r["c2"])
        m[i, j] = m[j, i] = r["r"]
    v = np.diag(np.linalg.inv(m))
    return df.sparkSession.createDataFrame(
        [(c, float(x), bool(x < 10)) for c, x in zip(cols, v)], "column string, vif double, acceptable boolean")
