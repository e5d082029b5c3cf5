"""Summaries that need more than one built-in aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ordered import null_safe_join, quantiles_wide
from tallyframe.operators.relational import unpivot

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column, long form."""
    long = unpivot(df, cols)
    base = long.groupBy("column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantiles_wide(long.withColumnRenamed("column", "name"), ["value"], QUARTILES, ["name"])
    return base.join(q.withColumnsRenamed({"name": "column", **{f"value_{k}": k for k in QUARTILES}}), "column", "left")


def group_medians(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    return quantiles_wide(df, [col], {"median": 0.5}, by).withColumnRenamed(f"{col}_median", "median")


def mean_median_count(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    base = df.groupBy(*by).agg(F.avg(col).alias("mean"), F.count(col).alias("n"))
    return null_safe_join(base, group_medians(df, col, by), by, "left")


def list_summary(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """mean, population std, min, max, median rounded to 4 places."""
    base = df.groupBy(*by).agg(
        F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    out = null_safe_join(base, group_medians(df, col, by), by, "left")
    return out.select(*by, *[F.round(c, 4).alias(c) for c in ["mean", "std", "min", "max", "median"]])


def moments(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population std, population skewness and excess kurtosis."""
    return df.groupBy(*by).agg(
        F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"),
        F.skewness(col).alias("skew"), F.kurtosis(col).alias("kurt"))


def matrix_row_mean(df: DataFrame, key: str, col: str) -> DataFrame:
    s = F.aggregate(F.col(col), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return df.select(key, (s / F.size(col)).alias("mean"))


def matrix_column_max(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.posexplode(col).alias("pos", "v")).groupBy("pos").agg(F.max("v").alias("max"))
