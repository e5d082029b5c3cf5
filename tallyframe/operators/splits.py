"""Reproducible splits: order by the md5 of a key, so the same rows land in the same part on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ordered import hash_rank, lookup_join


def _sized(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    ranked = hash_rank(df, key, by, "__rn")
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return lookup_join(ranked, n, by) if by else ranked.withColumn("__n", n.scalar())


def random_split(df: DataFrame, key: str, test_size: float = 0.2) -> DataFrame:
    """Exact sizes: the test part has ceil(n * test_size) rows."""
    d = _sized(df, key, [])
    test = F.ceil(F.col("__n") * test_size)
    return d.withColumn("part", F.when(F.col("__rn") <= F.col("__n") - test, "train").otherwise("test")).drop("__rn", "__n")


def stratified_split(df: DataFrame, key: str, label: str, rest: float = 0.2) -> DataFrame:
    """Per class: (1 - rest) train, the rest halved into validation and test."""
    d = _sized(df, key, [label])
    train = F.floor(F.col("__n") * (1 - rest))
    val = train + F.floor((F.col("__n") - train) / 2)
    part = F.when(F.col("__rn") <= train, "train").when(F.col("__rn") <= val, "validation").otherwise("test")
    return d.withColumn("part", part).drop("__rn", "__n")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5) -> DataFrame:
    """Fold number 0..k-1, class shares kept."""
    return hash_rank(df, key, [label], "__rn").withColumn("fold", ((F.col("__rn") - 1) % k).cast("int")).drop("__rn")


def leave_one_out(df: DataFrame, key: str) -> DataFrame:
    """One fold per row (meant for small frames; each fold is a fit)."""
    return hash_rank(df, key, [], "__rn").withColumn("fold", (F.col("__rn") - 1).cast("int")).drop("__rn")
