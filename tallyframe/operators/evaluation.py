"""Evaluation tables as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.features import cut
from tallyframe.operators.ordered import one_row, prefix_sums


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    n = F.count(e)
    s = df.agg(n.alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
               F.sum(e * e).alias("__rss"), F.var_pop(actual).alias("__v"))
    return s.select("n", "rmse", "mae", (1 - F.try_divide(F.col("__rss"), F.col("__v") * F.col("n"))).alias("r2"))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class precision, recall, F1, support; then accuracy, macro and weighted averages.

    One grouped count of (label, prediction); everything else works on those few rows.
    """
    cells = df.groupBy(F.col(label).cast("string").alias("l"), F.col(predicted).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("c"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("l").alias("k"), F.col("c").alias("support"), F.lit(0).cast("long").alias("said"),
                 F.when(F.col("l") == F.col("p"), F.col("c")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("support"), F.col("c").alias("said"),
                 F.lit(0).cast("long").alias("hit")))))
    g = sides.groupBy("k").agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    g = g.select(F.col("k").alias("row"), zero(F.try_divide("hit", "said")).alias("precision"),
                 zero(F.try_divide("hit", "support")).alias("recall"),
                 zero(F.try_divide(2 * F.col("hit"), F.col("said") + F.col("support"))).alias("f1"), "support", "hit")
    wavg = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
    names = ["precision", "recall", "f1"]
    acc = g.agg(F.try_divide(F.sum("hit"), F.sum("support")).alias("a"), F.sum("support").alias("support")).select(
        F.lit("accuracy").alias("row"), *[F.col("a").alias(c) for c in names], "support")
    macro = g.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support")).select(
        F.lit("macro avg").alias("row"), *names, "support")
    weighted = g.agg(*[wavg(c) for c in names], F.sum("support").alias("support")).select(
        F.lit("weighted avg").alias("row"), *names, "support")
    return g.drop("hit").unionByName(acc).unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, label: str, predicted: str, order: Sequence) -> DataFrame:
    """Rows are true classes, one column per predicted class, in the given order; absent cells are 0."""
    counts = df.groupBy(label).agg(*[F.count_if(F.col(predicted) == v).alias(f"pred_{v}") for v in order])
    frame = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(order)], ["__o", "__l"])
    out = frame.join(counts, F.col("__l") == F.col(label), "left").na.fill(0).orderBy("__o")
    return out.select(F.col("__l").alias("label"), *[f"pred_{v}" for v in order])


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC points, one per distinct score (ties move together), from the origin."""
    g = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    tot = one_row(g.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    c = prefix_sums(g, {"tp": F.col("pos"), "fp": F.col("neg")}, "threshold", None, ascending=False)
    c = c.withColumn("__t", tot)
    return c.select("threshold", "pos", "neg", "tp", "fp", F.try_divide("fp", "__t.n").alias("fpr"),
                    F.try_divide("tp", "__t.p").alias("tpr"))


def auc(points: DataFrame) -> DataFrame:
    """Trapezoid area; each point knows its own step, so no neighbour is looked up."""
    area = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return points.agg(F.try_divide(F.sum(area), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Precision and recall per threshold, all thresholds in one pass."""
    y, s = F.col(label) == 1, F.col(score)
    one = df.agg(F.count_if(y).alias("p"), *[e for i, t in enumerate(thresholds) for e in (
        F.count_if(s >= t).alias(f"s{i}"), F.count_if(y & (s >= t)).alias(f"h{i}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"),
                 F.coalesce(F.try_divide(F.col(f"h{i}"), F.col(f"s{i}")), F.lit(0.0)).alias("precision"),
                 F.coalesce(F.try_divide(F.col(f"h{i}"), F.col("p")), F.lit(0.0)).alias("recall"))
        for i, t in enumerate(thresholds)])))


def risk_bands(df: DataFrame, score: str) -> DataFrame:
    """Counts in (0, .3], (.3, .6], (.6, 1]."""
    band = cut(score, [0, 0.3, 0.6, 1.0], ["low", "medium", "high"])
    return df.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def risk_level(p: Column) -> Column:
    """The scoring rule's levels: below .3, below .6, otherwise high."""
    return F.when(p < 0.3, "low").when(p < 0.6, "medium").otherwise("high")
