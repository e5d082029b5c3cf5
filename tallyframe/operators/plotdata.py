"""The tables behind charts: binned, summarised or bounded, never raw rows to the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators.features import column_pairs
from tallyframe.operators.ordered import lookup_join, null_safe_join, one_row, quantiles_wide
from tallyframe.operators.relational import unpivot


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the joint range, last bin closed, empty bins included: count and density."""
    r = one_row(df.agg(F.min(col).cast("double").alias("a"), F.max(col).cast("double").alias("b")))
    d = df.where(F.col(col).isNotNull()).withColumn("__r", r)
    width = (F.col("__r.b") - F.col("__r.a")) / bins
    b = F.least(F.coalesce(F.floor(F.try_divide(F.col(col) - F.col("__r.a"), width)), F.lit(0).cast("long")), F.lit(bins - 1).cast("long"))
    g = d.groupBy(*by, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    if by:
        t = g.groupBy(*by).agg(F.sum("n").alias("__n"))
        grid = t.select(*by, "__n", all_bins)
    else:
        grid = g.agg(F.sum("n").alias("__n")).select("__n", all_bins)
    out = null_safe_join(grid, g, [*by, "bin"], "left").withColumn("__r", r)
    n = F.coalesce("n", F.lit(0).cast("long"))
    return out.select(*by, "bin", (F.col("__r.a") + F.col("bin") * width).alias("low"), n.alias("n"),
                      F.try_divide(n, F.col("__n") * width).alias("density"))


def center_marks(df: DataFrame, col: str) -> DataFrame:
    q = quantiles_wide(df, [col], {"median": 0.5}).select(F.col(f"{col}_median").alias("median"))
    return df.agg(F.avg(col).alias("mean")).withColumn("median", q.scalar())


def box_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last value inside 1.5 IQR, outlier count, notch half-width 1.57·IQR/√n."""
    q = quantiles_wide(df, [col], {"q1": 0.25, "q2": 0.5, "q3": 0.75}, by).withColumnsRenamed(
        {f"{col}_{k}": k for k in ("q1", "q2", "q3")})
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col(col) >= F.col("q1") - 1.5 * iqr) & (F.col(col) <= F.col("q3") + 1.5 * iqr)
    d = lookup_join(df.select(*by, col).where(F.col(col).isNotNull()), q, by)
    s = d.groupBy(*by, "q1", "q2", "q3").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(inside, F.col(col))).alias("whisker_low"),
        F.max(F.when(inside, F.col(col))).alias("whisker_high"), F.count_if(~inside).alias("n_outliers"))
    half = 1.57 * (F.col("q3") - F.col("q1")) / F.sqrt("n")
    return s.withColumns({"notch_low": F.col("q2") - half, "notch_high": F.col("q2") + half})


def kde(df: DataFrame, col: str, by: str, grid: Sequence[float]) -> DataFrame:
    """Gaussian density per group at the grid points (Scott's rule). One sum per grid point, no row is copied."""
    st = df.groupBy(by).agg(F.count(col).alias("__n"), F.stddev_samp(col).alias("__s"))
    st = st.withColumn("__h", F.col("__s") * F.pow(F.col("__n"), F.lit(-0.2))).drop("__s")
    vc = df.where(F.col(col).isNotNull()).groupBy(by, col).agg(F.count(F.lit(1)).alias("__c"))
    d = lookup_join(vc, st, [by])
    z = lambda g: (F.lit(float(g)) - F.col(col)) / F.col("__h")
    s = d.groupBy(by, "__n", "__h").agg(*[
        F.sum(F.col("__c") * F.exp(-0.5 * z(g) * z(g))).alias(f"g{i}") for i, g in enumerate(grid)])
    norm = F.col("__n") * F.col("__h") * F.sqrt(2 * F.pi())
    return s.select(by, F.inline(F.array(*[
        F.struct(F.lit(float(g)).alias("x"), F.try_divide(F.col(f"g{i}"), norm).alias("density")) for i, g in enumerate(grid)])))


def regression_line(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))


def group_mean_ci(df: DataFrame, col: str, by: str) -> DataFrame:
    g = df.groupBy(by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("__s"), F.count(col).alias("n"))
    half = 1.96 * F.col("__s") / F.sqrt("n")
    return g.select(by, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def poisson_weights(keys: np.ndarray, rounds: int) -> np.ndarray:
    """Poisson(1) weights, one row per key and one column per round, from mixed 64-bit hashes."""
    # fixed values: cumulative Poisson(1) probabilities
    cum = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582]
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64)[:, None] + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(cum, u, side="right").astype(float)


def group_mean_bootstrap(df: DataFrame, col: str, by: str, key: str, rounds: int = 100) -> DataFrame:
    """95 % percentile interval of the mean by a Poisson bootstrap: each row draws a hashed weight per round,
    so one pass replaces the resampling and reruns give the same interval. Batches leave as weighted sums."""
    d = df.where(F.col(col).isNotNull()).select(
        F.col(by).cast("string").alias("g"), F.xxhash64(key).alias("k"), F.col(col).cast("double").alias("x"))

    def sums(batches):
        for pdf in batches:
            w = poisson_weights(pdf["k"].to_numpy(), rounds)
            x = pdf["x"].to_numpy()
            for g, at in pdf.groupby("g", dropna=False).indices.items():
                yield pd.DataFrame({"g": g, "b": np.arange(rounds), "n": float(len(at)), "s": float(x[at].sum()),
                                    "sw": w[at].sum(axis=0), "sx": w[at].T @ x[at]})

    part = d.mapInPandas(sums, "g string, b int, n double, s double, sw double, sx double")
    m = part.groupBy("g", "b").agg(*[F.sum(c).alias(c) for c in ("n", "s", "sw", "sx")])
    arr = F.array_sort(F.collect_list(F.try_divide("sx", "sw")))
    out = m.groupBy(F.col("g").alias(by)).agg(F.try_divide(F.max("s"), F.max("n")).alias("mean"), arr.alias("ms"))
    return out.select(by, "mean", F.element_at("ms", max(1, round(rounds * 0.025))).alias("low"),
                      F.element_at("ms", max(1, round(rounds * 0.975))).alias("high"))


def pair_correlations(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    pairs = column_pairs(cols)
    one = df.groupBy(by).agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(by, F.inline(F.array(*[
        F.struct(F.lit(a).alias("c1"), F.lit(b).alias("c2"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))


def hashed_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """A reproducible sample of n rows for a scatter chart (a top-k by hash)."""
    return df.orderBy(F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in key])), *key).limit(n)


def missing_matrix(df: DataFrame, cols: Sequence[str], order: Sequence[str], n: int = 100) -> DataFrame:
    """Null flag per cell of the first n rows."""
    top = df.orderBy(*order).limit(n).withColumn("row", F.row_number().over(W.orderBy(*order)))
    flags = top.select("row", *[F.col(c).isNull().cast("int").alias(c) for c in cols])
    return unpivot(flags, cols, ["row"], value="is_missing", cast="int")


def frames(df: DataFrame, month: Column, cat: str, value: str) -> DataFrame:
    """Sums per frame and category with a common axis end (largest sum × 1.1)."""
    g = df.groupBy(month.alias("month"), cat).agg(F.sum(value).alias("total"))
    return g.withColumn("axis_max", g.agg(F.max("total") * 1.1).scalar())


def category_bars(df: DataFrame, cat: str, value: str) -> DataFrame:
    """Category means with the overall mean, largest first."""
    g = df.groupBy(cat).agg(F.avg(value).alias("mean"), F.sum(value).alias("__s"), F.count(value).alias("__n"))
    overall = g.agg(F.sum("__s") / F.sum("__n")).scalar()
    return g.select(cat, "mean").withColumn("overall", overall).orderBy(F.desc("mean"))
