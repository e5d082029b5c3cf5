"""Window features.

The series functions take frames with one row per period and series, whose
group size is bounded by the calendar; raw rows go through ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators.ordered import bounded_window, lookup_join, prefix_sums


def series_window(by: Sequence[str], order: str = "day"):
    return W.partitionBy(*by).orderBy(order)


def guarded(agg: Column, col: str, frame, minimum: int) -> Column:
    """Aggregate over a frame, null until it holds ``minimum`` values."""
    return F.when(F.count(col).over(frame) >= minimum, agg.over(frame))


def lag_features(df: DataFrame, col: str, lags: Sequence[int], by: Sequence[str], order: str = "day") -> DataFrame:
    w = series_window(by, order)
    return df.withColumns({f"lag_{n}": F.lag(col, n).over(w) for n in lags})


def rolling_features(df: DataFrame, col: str, widths: Sequence[int], by: Sequence[str], order: str = "day",
                     minimum: int = 3) -> DataFrame:
    """Mean and sample std of the previous rows (the current row excluded)."""
    out = {}
    for n in widths:
        fr = series_window(by, order).rowsBetween(-n, -1)
        out[f"mean_{n}"] = guarded(F.avg(col), col, fr, minimum)
        out[f"std_{n}"] = guarded(F.stddev_samp(col), col, fr, minimum)
    return df.withColumns(out)


def momentum_ratio(df: DataFrame, col: str, by: Sequence[str], order: str = "day", n: int = 7) -> DataFrame:
    return df.withColumn("momentum", F.col(col) / (F.lag(col, n).over(series_window(by, order)) + 1e-8))


def trailing_mean(col: str, n: int, by: Sequence[str], order: str = "day") -> Column:
    return guarded(F.avg(col), col, series_window(by, order).rowsBetween(-(n - 1), 0), n)


def centered_mean(col: str, n: int, by: Sequence[str], order: str = "day") -> Column:
    """An even width reaches one row further back than ahead."""
    return guarded(F.avg(col), col, series_window(by, order).rowsBetween(-(n // 2), (n - 1) // 2), n)


def diff_pct(df: DataFrame, col: str, by: Sequence[str], order: str = "day") -> DataFrame:
    prev = F.lag(col).over(series_window(by, order))
    return df.withColumns({"diff": F.col(col) - prev, "pct_change": F.try_divide(F.col(col), prev) - 1})


def drawdown(df: DataFrame, col: str, by: Sequence[str], order: str = "day") -> DataFrame:
    fr = series_window(by, order).rowsBetween(W.unboundedPreceding, 0)
    peak = F.max(col).over(fr)
    return df.withColumns({"peak": peak, "drawdown": F.try_divide(F.col(col) - peak, peak)})


def relative_to_first(df: DataFrame, col: str, by: Sequence[str], order: str = "day") -> DataFrame:
    first = F.first(col).over(series_window(by, order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("change_pct", (F.try_divide(F.col(col), first) - 1) * 100)


def competition_rank(df: DataFrame, col: str, name: str = "rank", ascending: bool = False) -> DataFrame:
    """RANK() over the whole frame: equal values are counted once, ranked, and joined back."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    rk = prefix_sums(vc, {"__before": F.col("__n")}, col, None, ascending=ascending, inclusive=False)
    return lookup_join(df, rk.select(col, (F.col("__before") + 1).alias(name)), [col])


def row_features(df: DataFrame, col: str, order: str, tie: str, by: Sequence[str]) -> DataFrame:
    """ROW_NUMBER, LAG and LEAD over raw rows of groups of any size."""
    return bounded_window(
        df,
        lambda w: {"rn": F.col("__i"), "lag": F.lag(col).over(w), "lead": F.lead(col).over(w)},
        order, tie, by, back=1, ahead=1,
    )


def dense_rank_by(df: DataFrame, col: str, by: Sequence[str], name: str = "dense_rank") -> DataFrame:
    """DENSE_RANK within a group whose ``col`` has boundedly many distinct values (days, grades)."""
    d = df.select(*by, col).distinct().withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(col)).cast("long"))
    return lookup_join(df, d, [*by, col])
