"""Profiling, imputing, capping, de-duplicating and harmonising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregates import numeric_summary
from tallyframe.operators.features import impute_median  # noqa: F401  (part of this module's surface)
from tallyframe.operators.ordered import one_row, quantiles_wide
from tallyframe.operators.relational import lookup, mode_value, numeric_columns, unpivot


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and percent (2 places) of each column that has nulls, from one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = unpivot(one, df.columns, ["__n"], value="n_missing", cast="long").where("n_missing > 0")
    return long.select("column", "n_missing", F.round(F.col("n_missing") * 100 / F.col("__n"), 2).alias("pct")).orderBy(
        F.desc("n_missing"), "column")


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, columns, duplicate rows, and the numeric summary where there is one."""
    dup = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("c"))
    totals = dup.agg(F.sum("c").alias("n_rows"), F.sum(F.col("c") - 1).alias("n_duplicates"))
    types = df.sparkSession.createDataFrame(
        [(c, t, len(df.columns)) for c, t in df.dtypes], "column string, dtype string, n_columns int")
    d = types.withColumn("__t", one_row(totals)).select(
        "column", "dtype", "n_columns", F.col("__t.n_rows").alias("n_rows"), F.col("__t.n_duplicates").alias("n_duplicates"))
    return d.join(numeric_summary(df, numeric_columns(df)), "column", "left")


def impute_mode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    p = one_row(mode_value(df if fit_on is None else fit_on, cols))
    return df.withColumn("__p", p).withColumns({c: F.coalesce(F.col(c), F.col(f"__p.{c}")) for c in cols}).drop("__p")


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    p = one_row(df.agg(*[F.avg(c).alias(c) for c in cols]))
    return df.withColumn("__p", p).withColumns({c: F.coalesce(F.col(c), F.col(f"__p.{c}")) for c in cols}).drop("__p")


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    q = quantiles_wide(df, [col], {"q1": 0.25, "q3": 0.75})
    a, b = F.col(f"{col}_q1"), F.col(f"{col}_q3")
    return q.select((a - k * (b - a)).alias("lower"), (b + k * (b - a)).alias("upper"))


def zscore_bounds(df: DataFrame, col: str) -> DataFrame:
    """Flag by the population deviation, clip at three sample deviations."""
    m = df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("p"), F.stddev_samp(col).alias("s"))
    return m.select((F.col("m") - 3 * F.col("s")).alias("lower"), (F.col("m") + 3 * F.col("s")).alias("upper"),
                    (F.col("m") - 3 * F.col("p")).alias("flag_lower"), (F.col("m") + 3 * F.col("p")).alias("flag_upper"))


def _bounds(df: DataFrame, col: str, method: str, k: float) -> DataFrame:
    if method == "iqr":
        return iqr_bounds(df, col, k).select("*", F.col("lower").alias("flag_lower"), F.col("upper").alias("flag_upper"))
    if method == "zscore":
        return zscore_bounds(df, col)
    raise ValueError(f"unknown method {method!r}: use 'iqr' or 'zscore'")


def _outside(col: str) -> Column:
    return (F.col(col) < F.col("__p.flag_lower")) | (F.col(col) > F.col("__p.flag_upper"))


def _capped(col: str) -> Column:
    return F.when(F.col(col).isNotNull(), F.greatest(F.least(F.col(col), F.col("__p.upper")), F.col("__p.lower")))


def cap_outliers(df: DataFrame, col: str, method: str = "iqr", k: float = 1.5, flag: str | None = None) -> DataFrame:
    """Clip to the bounds; rows are kept. ``flag`` names a 0/1 column that marks the rows outside, judged before clipping."""
    d = df.withColumn("__p", one_row(_bounds(df, col, method, k)))
    if flag is not None:
        d = d.withColumn(flag, F.coalesce(_outside(col), F.lit(False)).cast("int"))
    return d.withColumn(col, _capped(col)).drop("__p")


def outlier_stats(df: DataFrame, col: str, method: str = "iqr", k: float = 1.5) -> DataFrame:
    """One row: flagged rows, their percent of all rows, the bounds and the sum after clipping, rounded to 2 places."""
    p = one_row(_bounds(df, col, method, k))
    d = df.select(col).withColumn("__p", p)
    n = F.count_if(_outside(col))
    return d.groupBy("__p").agg(n.alias("n_outliers"), F.count(F.lit(1)).alias("n"), F.sum(_capped(col)).alias("s")).select(
        F.lit(col).alias("column"), F.lit(method).alias("method"), "n_outliers",
        F.round(F.col("n_outliers") / F.col("n") * 100, 2).alias("pct"),
        F.round("__p.lower", 2).alias("lower"), F.round("__p.upper", 2).alias("upper"), F.round("s", 2).alias("capped_sum"))


def drop_outliers(df: DataFrame, col: str, method: str = "zscore", k: float = 1.5) -> DataFrame:
    d = df.withColumn("__p", one_row(_bounds(df, col, method, k)))
    return d.where(~F.coalesce(_outside(col), F.lit(False))).drop("__p")


def unit_text_to_number(c: Column, unit: str = " Ft") -> Column:
    return F.trim(F.replace(c, F.lit(unit), F.lit(""))).try_cast("double")


def harmonize(c: Column, fixes: dict[str, str], valid: Sequence[str], other: str = "Other") -> Column:
    """Trim and title-case, apply fixes, unknown becomes ``other``; null stays null."""
    return lookup(F.initcap(F.trim(c)), fixes, valid, other)


def cleaning_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and null cells before and after."""
    def one(d, name):
        nulls = sum((F.col(c).isNull().cast("long") for c in d.columns), F.lit(0).cast("long"))
        return d.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("n_nulls")).select(
            F.lit(name).alias("stage"), "n_rows", "n_nulls")

    return one(before, "before").unionByName(one(after, "after"))


def cap_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """IQR capping of several columns whose bounds all come from one quantile pass."""
    q = one_row(quantiles_wide(df, cols, {"q1": 0.25, "q3": 0.75}))
    d = df.withColumn("__p", q)
    span = lambda c: F.col(f"__p.{c}_q3") - F.col(f"__p.{c}_q1")
    cap = lambda c: F.greatest(F.least(F.col(c), F.col(f"__p.{c}_q3") + k * span(c)), F.col(f"__p.{c}_q1") - k * span(c))
    return d.withColumns({c: F.when(F.col(c).isNotNull(), cap(c)) for c in cols}).drop("__p")


def clean(df: DataFrame, numeric: Sequence[str], text: Sequence[str], cap: Sequence[str]) -> DataFrame:
    """The whole flow in its fixed order: impute, cap, de-duplicate."""
    return cap_iqr(impute_mode(impute_median(df, numeric), text), cap).dropDuplicates()
