"""Input checks and drift measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.distributions import kolmogorov_pvalue
from tallyframe.operators.ordered import one_row, prefix_sums


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a null condition counts as broken."""
    return F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]), lambda r: r.isNotNull())


def in_range(c: str, low=None, high=None) -> Column:
    ok = F.col(c).isNotNull()
    if low is not None:
        ok = ok & (F.col(c) >= low)
    if high is not None:
        ok = ok & (F.col(c) <= high)
    return ok


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their broken rules)."""
    d = df.withColumn("failed", failed_rules(rules))
    return d.where(F.size("failed") == 0).drop("failed"), d.where(F.size("failed") > 0)


def bin_counts(df: DataFrame, cols: Sequence[str], is_prod: str, bins: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """Reference and production counts per column and equal-width bin over the joint range, empty bins included.

    One pass for the ranges, one for the counts; what is shuffled depends on bins and columns only.
    """
    rng = one_row(df.agg(*[e for c in cols for e in (
        F.min(c).cast("double").alias(f"a_{c}"), F.max(c).cast("double").alias(f"b_{c}"))]))
    d = df.withColumn("__r", rng)
    where = lambda c: F.least(F.floor(F.coalesce(F.try_divide(
        (F.col(c) - F.col(f"__r.a_{c}")) * bins, F.col(f"__r.b_{c}") - F.col(f"__r.a_{c}")), F.lit(0.0))), F.lit(bins - 1))
    long = d.select(*keep, is_prod, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), where(c).cast("int").alias("bin")) for c in cols]))).where("bin IS NOT NULL")
    g = long.groupBy(*keep, "column", "bin").agg(
        F.count_if(~F.col(is_prod)).alias("ref"), F.count_if(F.col(is_prod)).alias("prod"))
    groups = g.select(*keep, "column").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return groups.join(g, [*keep, "column", "bin"], "left").na.fill(0, ["ref", "prod"])


def _shares(bins: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    t = bins.groupBy(*keep, "column").agg(F.sum("ref").alias("nr"), F.sum("prod").alias("np"))
    d = bins.join(t, [*keep, "column"])
    share = lambda c, n: F.coalesce(F.nullif(F.try_divide(F.col(c), F.col(n)), F.lit(0.0)), F.lit(1e-6))
    return d.withColumns({"r": share("ref", "nr"), "p": share("prod", "np")})


def psi(bins: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    d = _shares(bins, keep)
    return d.groupBy(*keep, "column").agg(
        F.sum((F.col("p") - F.col("r")) * F.log(F.col("p") / F.col("r"))).alias("psi"))


def kl_divergence(bins: DataFrame) -> DataFrame:
    return _shares(bins).groupBy("column").agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("r"))).alias("kl"))


def drift_status(value: Column) -> Column:
    return F.when(value < 0.1, "stable").when(value < 0.25, "watch").otherwise("drift")


def ks_status(p: Column) -> Column:
    return F.when(p < 0.05, "drift").otherwise("stable")


def needs_retrain(psi_value: Column, accuracy_drop: Column | None = None) -> Column:
    """PSI above 0.25, or accuracy down by five points or more."""
    out = psi_value > 0.25
    return out if accuracy_drop is None else out | F.coalesce(accuracy_drop >= 0.05, F.lit(False))


def accuracy_drop(df: DataFrame, correct: Column, is_prod: str) -> DataFrame:
    """Accuracy of reference and production and the fall between them, from one pass; rows without an outcome take no part."""
    share = lambda side: F.avg(F.when(side, correct.cast("double")))
    return df.agg(share(~F.col(is_prod)).alias("ref_accuracy"), share(F.col(is_prod)).alias("prod_accuracy")).withColumn(
        "drop", F.col("ref_accuracy") - F.col("prod_accuracy"))


def drift_report(bins: DataFrame, ks: DataFrame, accuracy: DataFrame) -> DataFrame:
    """One row per column: PSI and its status, the two-sample gap and its status, the accuracy fall, and whether to train again."""
    d = psi(bins).join(ks.select("column", "d", "p"), "column").withColumn("accuracy_drop", one_row(accuracy)["drop"])
    return d.withColumns({
        "status": drift_status(F.col("psi")), "ks_status": ks_status(F.col("p")),
        "retrain": needs_retrain(F.col("psi"), F.col("accuracy_drop"))})


def ks_two_sample(df: DataFrame, cols: Sequence[str], is_prod: str) -> DataFrame:
    """Largest gap of the two empirical distributions per column, and its asymptotic p.

    Equal values are counted before ordering, so ties move together.
    """
    long = df.select(is_prod, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]))).where("v IS NOT NULL")
    g = long.groupBy("column", "v").agg(
        F.count_if(~F.col(is_prod)).alias("ref"), F.count_if(F.col(is_prod)).alias("prod"))
    c = prefix_sums(g, {"cr": F.col("ref"), "cp": F.col("prod")}, "v", None, by=["column"])
    t = g.groupBy("column").agg(F.sum("ref").alias("nr"), F.sum("prod").alias("np"))
    d = c.join(t, "column").groupBy("column", "nr", "np").agg(
        F.max(F.abs(F.try_divide("cr", "nr") - F.try_divide("cp", "np"))).alias("d"))
    eff = F.sqrt(F.col("nr").cast("double") * F.col("np") / (F.col("nr") + F.col("np")))
    return d.withColumn("p", kolmogorov_pvalue(eff * F.col("d")))


def log_predictions(scored: DataFrame, path: str, when: Column) -> None:
    """Append time, input and output to the log."""
    scored.withColumn("logged_at", when).write.mode("append").parquet(path)


def weekly_summary(log: DataFrame, time: str, value: str) -> DataFrame:
    w = F.window(F.col(time).cast("timestamp"), "7 days")
    return log.groupBy(w.start.alias("start")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
