"""Indicators, crossover signals and a closed-form backtest over daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators.windows import guarded, series_window, trailing_mean


def rsi(df: DataFrame, by: Sequence[str], n: int = 14, order: str = "day", name: str = "rsi") -> DataFrame:
    """Simple means of gains and losses; the first change counts as 0."""
    w = series_window(by, order)
    change = F.col("y") - F.lag("y").over(w)
    d = df.withColumn("__g", F.when(change > 0, change).otherwise(0.0)).withColumn(
        "__l", F.when(change < 0, -change).otherwise(0.0))
    fr = w.rowsBetween(-(n - 1), 0)
    rs = guarded(F.avg("__g"), "__g", fr, n) / (guarded(F.avg("__l"), "__l", fr, n) + 1e-8)
    return d.withColumn(name, 100 - 100 / (1 + rs)).drop("__g", "__l")


def bollinger(df: DataFrame, by: Sequence[str], n: int = 20, k: float = 2.0, order: str = "day") -> DataFrame:
    fr = series_window(by, order).rowsBetween(-(n - 1), 0)
    mid, sd = guarded(F.avg("y"), "y", fr, n), guarded(F.stddev_samp("y"), "y", fr, n)
    return df.withColumns({"mid": mid, "upper": mid + k * sd, "lower": mid - k * sd})


def crossover_signals(df: DataFrame, by: Sequence[str], fast: int = 20, slow: int = 50, order: str = "day") -> DataFrame:
    """Fast mean above slow mean is 1, else -1; changes buy or sell. Warm-up rows are dropped first,
    so the first row left has no change and cannot trade."""
    d = df.withColumns({"ma_fast": trailing_mean("y", fast, by, order), "ma_slow": trailing_mean("y", slow, by, order)})
    d = d.where(F.col("ma_fast").isNotNull() & F.col("ma_slow").isNotNull())
    d = d.withColumn("signal", F.when(F.col("ma_fast") > F.col("ma_slow"), 1).otherwise(-1))
    change = F.col("signal") - F.lag("signal").over(series_window(by, order))
    d = d.withColumn("change", change)
    return d.withColumns({"buy": F.coalesce(F.col("change") > 0, F.lit(False)), "sell": F.coalesce(F.col("change") < 0, F.lit(False))})


def backtest(signals: DataFrame, by: Sequence[str], capital: float = 100_000.0, order: str = "day") -> DataFrame:
    """All in on buy, all out on sell. The position held after a row is the last trade so far;
    the value is the capital grown by the price ratios of the rows entered while holding."""
    w = series_window(by, order)
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    trade = F.when(F.col("buy"), 1).when(F.col("sell"), 0)
    d = signals.withColumn("__t", trade).withColumn("held", F.coalesce(F.last("__t", ignorenulls=True).over(so_far), F.lit(0)))
    step = F.log(F.try_divide(F.col("y"), F.lag("y").over(w))) * F.coalesce(F.lag("held").over(w), F.lit(0))
    d = d.withColumn("__s", F.coalesce(step, F.lit(0.0)))
    return d.withColumn("value", capital * F.exp(F.sum("__s").over(so_far))).drop("__t", "__s")


def performance(df: DataFrame, tested: DataFrame, by: Sequence[str], capital: float = 100_000.0, order: str = "day") -> DataFrame:
    """Strategy return, buy-and-hold over the whole series, Sharpe (252 days), largest drawdown."""
    w = series_window(by, order)
    d = tested.withColumn("__r", F.col("value") / F.lag("value").over(w) - 1)
    peak = F.max("value").over(w.rowsBetween(W.unboundedPreceding, 0))
    d = d.withColumn("__dd", (F.col("value") - peak) / peak)
    s = d.groupBy(*by).agg(
        (F.max_by("value", order) / capital - 1).alias("strategy_return"),
        (F.try_divide(F.avg("__r"), F.stddev_samp("__r")) * F.sqrt(F.lit(252.0))).alias("sharpe"),
        F.min("__dd").alias("max_drawdown"))
    h = df.groupBy(*by).agg((F.try_divide(F.max_by("y", order), F.min_by("y", order)) - 1).alias("hold_return"))
    return s.join(h, list(by))
