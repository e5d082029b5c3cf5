"""Time series with one row per period and series.

Series rows are already aggregated per day or week, so the size of one series
is bounded by the calendar and windows or grouped fits per series stay small.
Many series run in parallel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.distributions import normal_cdf
from tallyframe.operators.windows import centered_mean, guarded, series_window


def numbered(df: DataFrame, by: Sequence[str] = (), order: str = "day", name: str = "i") -> DataFrame:
    return df.withColumn(name, F.row_number().over(series_window(by, order)))


def interpolate_zeros(df: DataFrame, col: str = "y", by: Sequence[str] = (), order: str = "day") -> DataFrame:
    """0 counts as missing; linear by position; leading gaps stay, trailing gaps repeat the last value."""
    d = numbered(df, by, order, "__i").withColumn("__y", F.nullif(F.col(col), F.lit(0.0)))
    w = series_window(by, order)
    pos = F.when(F.col("__y").isNotNull(), F.col("__i"))
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    d = d.withColumns({
        "__v0": F.last("__y", ignorenulls=True).over(back), "__i0": F.last(pos, ignorenulls=True).over(back),
        "__v1": F.first("__y", ignorenulls=True).over(ahead), "__i1": F.first(pos, ignorenulls=True).over(ahead),
    })
    step = F.try_divide((F.col("__v1") - F.col("__v0")) * (F.col("__i") - F.col("__i0")), F.col("__i1") - F.col("__i0"))
    fill = F.when(F.col("__v1").isNull(), F.col("__v0")).otherwise(F.col("__v0") + step)
    return d.withColumn(col, F.coalesce("__y", fill)).drop("__i", "__y", "__v0", "__i0", "__v1", "__i1")


def weekly_sums(df: DataFrame, col: str = "y", by: Sequence[str] = (), order: str = "day") -> DataFrame:
    """Weeks ending on Sunday, labelled by that Sunday; weeks without rows read 0."""
    end = F.date_add(order, 6 - F.weekday(order))
    s = df.groupBy(*by, end.alias("week")).agg(F.sum(col).alias(col))
    cal = s.groupBy(*by).agg(F.min("week").alias("a"), F.max("week").alias("b")).select(
        *by, F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("week"))
    return cal.join(s, [*by, "week"], "left").withColumn(col, F.coalesce(col, F.lit(0.0)))


def seasonal_decompose(df: DataFrame, period: int = 7, by: Sequence[str] = (), order: str = "day",
                       model: str = "additive") -> DataFrame:
    """Centred-mean trend (odd period), phase means of the detrended series centred to 0 (or 1), residual."""
    additive = model == "additive"
    d = numbered(df, by, order, "__i").withColumn("trend", centered_mean("y", period, by, order))
    d = d.withColumn("__d", F.col("y") - F.col("trend") if additive else F.try_divide(F.col("y"), F.col("trend")))
    d = d.withColumn("__phase", (F.col("__i") - 1) % period)
    phase = W.partitionBy(*by, "__phase")
    d = d.withColumn("__m", F.avg("__d").over(phase))
    # the mean of the phase means, each phase counted once
    first = d.where(F.col("__i") <= period).groupBy(*by).agg(F.avg("__m").alias("__mm"))
    d = d.join(first, list(by)) if by else d.withColumn("__mm", first.scalar())
    season = F.col("__m") - F.col("__mm") if additive else F.col("__m") / F.col("__mm")
    d = d.withColumn("seasonal", season)
    left = F.col("y") - F.col("trend") - F.col("seasonal") if additive else F.col("y") / (F.col("trend") * F.col("seasonal"))
    return d.withColumn("resid", left).drop("__i", "__d", "__phase", "__m", "__mm")


def temporal_holdout(df: DataFrame, h: int, by: Sequence[str] = (), order: str = "day") -> DataFrame:
    w = W.partitionBy(*by).orderBy(F.desc(order))
    return df.withColumn("part", F.when(F.row_number().over(w) <= h, "test").otherwise("train"))


def baselines(df: DataFrame, by: Sequence[str] = (), order: str = "day", width: int = 7) -> DataFrame:
    w = series_window(by, order)
    return df.withColumns({
        "naive": F.lag("y").over(w), "mean_7": guarded(F.avg("y"), "y", w.rowsBetween(-width, -1), width)})


def forecast_metrics(df: DataFrame, actual: str, models: Sequence[str]) -> DataFrame:
    """MAE, RMSE, MAPE (denominator at least 1, percent) per model over the rows that have its forecast."""
    long = df.select(F.col(actual).alias("y"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("f")) for m in models]))).where("f IS NOT NULL AND y IS NOT NULL")
    e = F.col("y") - F.col("f")
    return long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / F.greatest(F.col("y"), F.lit(1.0))) * 100).alias("mape"))


def timeseries_folds(df: DataFrame, k: int = 5, order: str = "day") -> DataFrame:
    """Expanding-window folds: test size n // (k + 1); returns each fold's ranges."""
    d = numbered(df, [], order, "i")
    n = df.agg(F.count(F.lit(1))).scalar()
    size = F.floor(F.col("n") / (k + 1)).cast("long")
    folds = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("fold")
    d = d.withColumn("n", n).select("*", folds).withColumn("start", F.col("n") - (k + 1 - F.col("fold")) * size)
    role = F.when(F.col("i") <= F.col("start"), "train").when(F.col("i") <= F.col("start") + size, "test")
    return d.withColumn("role", role).where("role IS NOT NULL").groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def acf(df: DataFrame, lags: int, order: str = "day") -> DataFrame:
    m = df.agg(F.avg("y")).scalar()
    d = df.withColumn("c", F.col("y") - m)
    w = W.orderBy(order)
    d = d.withColumns({f"l{k}": F.lag("c", k).over(w) for k in range(1, lags + 1)})
    one = d.agg(F.sum(F.col("c") * F.col("c")).alias("c0"), *[
        F.sum(F.col("c") * F.col(f"l{k}")).alias(f"s{k}") for k in range(1, lags + 1)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s{k}"), F.col("c0")).alias("acf")) for k in range(1, lags + 1)])))


def pacf_values(r: Sequence[float]) -> list[float]:
    """Durbin-Levinson recursion on autocorrelations of lags 1.."""
    out, phi = [], np.array([])
    for k, rk in enumerate(r, 1):
        num = rk - (phi @ np.asarray(r[: k - 1])[::-1] if k > 1 else 0.0)
        den = 1 - (phi @ np.asarray(r[: k - 1]) if k > 1 else 0.0)
        a = num / den
        phi = np.append(phi - a * phi[::-1], a)
        out.append(float(a))
    return out


def acf_pacf(df: DataFrame, lags: int, order: str = "day") -> DataFrame:
    packed = acf(df, lags, order).agg(F.array_sort(F.collect_list(F.struct("lag", "acf"))).alias("a"))

    @F.pandas_udf("array<double>")
    def pacf(s: pd.Series) -> pd.Series:
        return s.map(lambda r: pacf_values(list(r)))

    d = packed.withColumn("p", pacf(F.col("a.acf")))
    return d.select(F.inline(F.arrays_zip(F.col("a.lag").alias("lag"), F.col("a.acf").alias("acf"), F.col("p").alias("pacf"))))


def mackinnon_p(tau: float) -> float:
    """Approximate p-value of the Dickey-Fuller statistic with a constant (MacKinnon 1994)."""
    # fixed values: limits and polynomial coefficients for one variable, constant only
    tau_max, tau_min, tau_star = 2.74, -18.83, -1.61
    small = [2.1659, 1.4412, 0.038269]
    large = [1.7339, 0.93202, -0.12745, -0.010368]
    if tau > tau_max:
        return 1.0
    if tau < tau_min:
        return 0.0
    coef = small if tau <= tau_star else large
    return float(normal_cdf(sum(c * tau ** i for i, c in enumerate(coef))))


def adf_test(df: DataFrame, order: str = "day", max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller with a constant; the lag order with the smallest AIC.

    The lagged columns are reduced to cross products once; every lag order is a
    sub-system of those, solved on the driver (as many unknowns as lags).
    """
    from tallyframe.operators.stats import normal_sums

    n = df.count()
    k = max_lag if max_lag is not None else min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    w = W.orderBy(order)
    d = df.withColumn("dy", F.col("y") - F.lag("y").over(w)).withColumn("level", F.lag("y").over(w))
    d = d.withColumns({f"d{j}": F.lag("dy", j).over(w) for j in range(1, k + 1)})

    def fit(lags: int, rows: DataFrame, orders: Sequence[int]):
        design = {"c": F.lit(1.0), "level": F.col("level"), **{f"d{j}": F.col(f"d{j}") for j in range(1, lags + 1)}}
        row = normal_sums(rows, design, "dy").first()
        m = len(design)
        a = np.array([[row[f"a{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)])
        b = np.array([row[f"b{i}"] for i in range(m)])
        out = {}
        for o in orders:
            s = o + 2
            sc = np.sqrt(np.diag(a)[:s])
            inv = np.linalg.inv(a[:s, :s] / np.outer(sc, sc)) / np.outer(sc, sc)
            beta = inv @ b[:s]
            rss = row["yy"] - beta @ b[:s]
            nn = row["n"]
            aic = nn * math.log(rss / nn) + 2 * s
            out[o] = (aic, float(beta[1] / math.sqrt(inv[1, 1] * rss / (nn - s))), nn)
        return out

    full = fit(k, d.na.drop(), range(k + 1))
    best = min(full, key=lambda o: full[o][0])
    _, tau, nn = fit(best, d, [best])[best]
    return df.sparkSession.createDataFrame(
        [(float(tau), mackinnon_p(tau), int(best), int(nn))], "statistic double, p double, lags int, n long")


def css_residuals(x: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Conditional sum of squares of ARMA(1,1) for arrays of parameters at once."""
    e = np.zeros_like(phi)
    total = np.zeros_like(phi)
    for t in range(1, len(x)):
        e = x[t] - phi * x[t - 1] - theta * e
        total += e * e
    return total


def fit_arma11(x: np.ndarray) -> tuple[float, float, float]:
    """(phi, theta, sigma²) by a shrinking parameter grid."""
    p0 = t0 = 0.0
    span = 0.98
    for _ in range(6):
        g = np.linspace(-span, span, 21)
        p, t = np.meshgrid(np.clip(p0 + g, -0.99, 0.99), np.clip(t0 + g, -0.99, 0.99))
        sse = css_residuals(x, p.ravel(), t.ravel())
        i = int(np.argmin(sse))
        p0, t0 = float(p.ravel()[i]), float(t.ravel()[i])
        span /= 6
    return p0, t0, float(sse[i] / max(len(x) - 1, 1))


def forecast_arima111(y: np.ndarray, steps: int, z: float = 1.959964):
    x = np.diff(y)
    phi, theta, s2 = fit_arma11(x)
    e = 0.0
    for t in range(1, len(x)):
        e = x[t] - phi * x[t - 1] - theta * e
    f, last = [], x[-1]
    for h in range(steps):
        last = phi * last + (theta * e if h == 0 else 0.0)
        f.append(last)
    mean = y[-1] + np.cumsum(f)
    psi = np.array([1.0] + [(phi + theta) * phi ** j for j in range(steps - 1)])
    sd = np.sqrt(s2 * np.cumsum(np.cumsum(psi) ** 2))
    return mean, mean - z * sd, mean + z * sd, phi, theta


def arima_forecast(df: DataFrame, series: str, order: str = "week", steps: int = 8) -> DataFrame:
    """ARIMA(1,1,1) per series; the last ``steps`` periods are held out and forecast."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        y = pdf["y"].to_numpy(float)
        if len(y) <= steps + 5:
            # too short to fit: the periods stay, without a forecast
            none = np.full(len(y), np.nan)
            return pd.DataFrame({"series": str(pdf[series].iloc[0]), "step": range(1, len(y) + 1), "period": pdf[order].astype(str), "actual": y,
                                 "yhat": none, "lower": none, "upper": none, "phi": none, "theta": none})
        m, lo, hi, phi, theta = forecast_arima111(y[:-steps], steps)
        return pd.DataFrame({
            "series": str(pdf[series].iloc[0]), "step": range(1, steps + 1), "period": pdf[order].iloc[-steps:].astype(str),
            "actual": y[-steps:], "yhat": m, "lower": lo, "upper": hi, "phi": phi, "theta": theta})

    return df.groupBy(series).applyInPandas(
        run, "series string, step int, period string, actual double, yhat double, lower double, upper double, phi double, theta double")


def additive_design(days: pd.Series, t0, t1, holidays: set, changepoints: int = 25) -> dict[str, np.ndarray]:
    """Trend with hinges over the first 80 %, weekly (3) and yearly (10) Fourier terms, holiday flags for -1..+1 days."""
    d = pd.to_datetime(days)
    num = (d - pd.Timestamp(t0)).dt.days.to_numpy(float)
    t = num / max((pd.Timestamp(t1) - pd.Timestamp(t0)).days, 1)
    cps = np.linspace(0, 0.8, changepoints + 1)[1:]
    epoch = (d - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
    wave = lambda period, n: np.column_stack([f(2 * np.pi * k * epoch / period) for k in range(1, n + 1) for f in (np.sin, np.cos)])
    md = lambda s: (d + pd.Timedelta(days=s)).dt.strftime("%Y-%m-%d").isin(holidays).to_numpy(float)
    return {
        "base": np.column_stack([np.ones_like(t), t]),
        "hinge": np.maximum(t[:, None] - cps[None, :], 0),
        "weekly": wave(7, 3), "yearly": wave(365.25, 10),
        "holiday": np.column_stack([md(1), md(0), md(-1)]),
    }


def fit_additive(days: pd.Series, y: np.ndarray, n: int, holidays: set, changepoint_scale: float = 0.05, season_scale: float = 10.0) -> dict[str, np.ndarray]:
    """Parts of the penalised least-squares fit to the first ``n`` values, for all days."""
    parts = additive_design(days, days.iloc[0], days.iloc[n - 1], holidays)
    x = np.column_stack(list(parts.values()))
    scale = np.abs(y[:n]).max() or 1.0
    pen = {"base": 1e-6, "hinge": 1 / changepoint_scale ** 2, "weekly": 1 / season_scale ** 2,
           "yearly": 1 / season_scale ** 2, "holiday": 1 / season_scale ** 2}
    lam = np.concatenate([np.full(p.shape[1], pen[k]) for k, p in parts.items()])
    xt, yt = x[:n], y[:n] / scale
    s2 = max(float(np.var(np.diff(yt)) / 2), 1e-12)
    beta = np.linalg.solve(xt.T @ xt + np.diag(lam * s2), xt.T @ yt) * scale
    out, at = {}, 0
    for k, p in parts.items():
        out[k] = p @ beta[at:at + p.shape[1]]
        at += p.shape[1]
    return out


def additive_forecast(df: DataFrame, series: str, holidays: Sequence[str], order: str = "day", horizon: int = 60,
                      changepoint_scale: float = 0.05, season_scale: float = 10.0) -> DataFrame:
    """Per series: penalised least squares on the additive design, forecast of the held-out last days."""
    hol = set(holidays)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        n = len(pdf) - horizon
        cols = ["series", "period", "is_test", "actual", "yhat", "lower", "upper", "trend", "weekly", "yearly", "holiday"]
        if n < 30:
            none = np.full(len(pdf), np.nan)  # too short to fit: the days stay, without a forecast
            return pd.DataFrame({"series": str(pdf[series].iloc[0]), "period": pdf[order].astype(str), "is_test": False,
                                 "actual": pdf["y"].to_numpy(float), **{c: none for c in cols[4:]}})[cols]
        y = pdf["y"].to_numpy(float)
        out = fit_additive(pdf[order], y, n, hol, changepoint_scale, season_scale)
        yhat = sum(out.values())
        sd = float(np.std(y[:n] - yhat[:n]))
        return pd.DataFrame({
            "series": str(pdf[series].iloc[0]), "period": pdf[order].astype(str), "is_test": np.arange(len(y)) >= n,
            "actual": y, "yhat": yhat, "lower": yhat - 1.281552 * sd, "upper": yhat + 1.281552 * sd,
            "trend": out["base"] + out["hinge"], "weekly": out["weekly"], "yearly": out["yearly"], "holiday": out["holiday"]})[cols]

    return df.groupBy(series).applyInPandas(
        run, "series string, period string, is_test boolean, actual double, yhat double, lower double, upper double, "
             "trend double, weekly double, yearly double, holiday double")


FORECASTERS = ["naive", "mean_7", "arima", "additive"]


def backtest_forecasts(df: DataFrame, series: str, holidays: Sequence[str], order: str = "day", horizon: int = 60) -> DataFrame:
    """Every forecaster on the same held-out last periods of each series: one row per period, one column per forecaster.

    All see the periods before only: ``naive`` repeats the last value, ``mean_7`` the mean of the last seven, ``arima`` is
    ARIMA(1,1,1), ``additive`` the trend and season fit. A series of fewer than ``horizon`` + 30 periods keeps its last
    periods with null forecasts. One series is one group, bounded by the calendar.
    """
    hol = set(holidays)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        y, n = pdf["y"].to_numpy(float), len(pdf) - horizon
        if n < 30:
            forecasts = {m: np.full(len(pdf), np.nan) for m in FORECASTERS}
        else:
            flat = lambda v: np.full(len(pdf), v)
            arima = np.concatenate([np.full(n, np.nan), forecast_arima111(y[:n], horizon)[0]])
            forecasts = dict(zip(FORECASTERS, [flat(y[n - 1]), flat(y[n - 7:n].mean()), arima, sum(fit_additive(pdf[order], y, n, hol).values())]))
        out = pd.DataFrame({"series": str(pdf[series].iloc[0]), "period": pdf[order].astype(str), "actual": y, **forecasts})
        return out.iloc[max(n, 0):]

    return df.groupBy(series).applyInPandas(run, "series string, period string, actual double, " + ", ".join(f"{m} double" for m in FORECASTERS))


def ranked_forecasts(backtest: DataFrame, actual: str = "actual", models: Sequence[str] = FORECASTERS) -> DataFrame:
    """Error measures of all forecasters, best mean absolute error first; the gain is against the first of ``models``."""
    d = backtest.select(actual, *[F.nanvl(F.col(m), F.lit(None).cast("double")).alias(m) for m in models])
    m = forecast_metrics(d, actual, models)
    base = F.max(F.when(F.col("model") == models[0], F.col("mae"))).over(W.partitionBy())
    return m.withColumn("rank", F.row_number().over(W.orderBy("mae", "model"))).withColumn("gain_pct", (1 - F.try_divide("mae", base)) * 100)


# Fixed-date public holidays used as the holiday table, month and day.
FIXED_HOLIDAYS = ["01-01", "03-15", "05-01", "08-20", "10-23", "11-01", "12-25", "12-26"]


# Movable holidays as days after Easter Sunday (Good Friday, Easter Monday, Whit Monday).
MOVABLE_HOLIDAYS = [-2, 1, 50]


def easter(year: int) -> date:
    """Easter Sunday of the Gregorian calendar: the Sunday after the first full moon of the computus on or after 21 March."""
    golden, century = year % 19, year // 100
    skipped = century - century // 4 - (8 * century + 13) // 25  # leap days left out, less the moon's own correction
    moon = (19 * golden + skipped + 15) % 30
    moon -= moon // 28 * (1 - moon // 28 * (29 // (moon + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + moon + 2 - century + century // 4) % 7
    return date(year, 3, 28) + timedelta(days=moon - weekday)


def holiday_dates(first_year: int, last_year: int) -> list[str]:
    """ISO days of the fixed and movable holidays of the years."""
    years = range(first_year, last_year + 1)
    fixed = [f"{y}-{md}" for y in years for md in FIXED_HOLIDAYS]
    return fixed + [(easter(y) + timedelta(days=k)).isoformat() for y in years for k in MOVABLE_HOLIDAYS]


def holidays_around(df: DataFrame, day: str) -> list[str]:
    """The holidays of the years of a day column, and of the years beside them; none where it has no days."""
    lo, hi = df.agg(F.min(F.year(day)), F.max(F.year(day))).first()
    return holiday_dates(lo - 1, hi + 1) if lo is not None else []
