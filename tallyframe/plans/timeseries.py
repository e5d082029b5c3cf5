"""Time-series queries over daily and weekly views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import features as FE, timeseries as TS
from tallyframe.plans import views
from tallyframe.plans.registry import query


def text(c, fmt="yyyy-MM-dd"):
    return F.date_format(c, fmt).alias(c)


CLEAN = views.GAP + """,
gi AS (SELECT day, y, row_number() OVER (ORDER BY day) AS i, nullif(y, 0) AS v FROM gap),
gj AS (SELECT *, last_value(v IGNORE NULLS) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS v0,
  last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS i0,
  first_value(v IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1,
  first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS i1 FROM gi),
clean AS (SELECT day, i, coalesce(v, CASE WHEN v1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (i - i0) / (i1 - i0) END) AS y FROM gj)
"""


def clean_series(t):
    return TS.interpolate_zeros(views.gap_series(t))


@query("zero_gap_interpolate", f"WITH {CLEAN} SELECT strftime(day, '%Y-%m-%d') AS day, round(y, 4) AS y FROM clean")
def zero_gap_interpolate(t):
    return clean_series(t).select(text("day"), F.round("y", 4).alias("y"))


WEEKLY = CLEAN + """,
weekly AS (SELECT CAST(day + INTERVAL 1 DAY * (7 - isodow(day)) AS DATE) AS week, sum(coalesce(y, 0)) AS y FROM clean GROUP BY 1)
"""


@query("weekly_resample", f"WITH {WEEKLY} SELECT strftime(week, '%Y-%m-%d') AS week, round(y, 5) AS y FROM weekly")
def weekly_resample(t):
    return TS.weekly_sums(clean_series(t)).select(text("week"), F.round("y", 5).alias("y"))


@query("seasonal_decompose", f"""
WITH {CLEAN},
tr AS (SELECT day, i, y, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend FROM clean
       WINDOW w AS (ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT (i - 1) % 7 AS p, avg(y - trend) AS m FROM tr GROUP BY 1),
se AS (SELECT p, m - (SELECT avg(m) FROM ph) AS s FROM ph)
SELECT strftime(day, '%Y-%m-%d') AS day, round(trend, 3) AS trend, round(s, 3) AS seasonal, round(y - trend - s, 3) AS resid
FROM tr JOIN se ON (i - 1) % 7 = p""")
def seasonal_decompose(t):
    d = TS.seasonal_decompose(clean_series(t))
    return d.select(text("day"), *[F.round(c, 3).alias(c) for c in ["trend", "seasonal", "resid"]])


@query("adf_test")
def adf_test(t):
    return TS.adf_test(TS.weekly_sums(clean_series(t)), "week")


@query("acf_pacf", f"""
WITH RECURSIVE {views.DAILY}, c AS (SELECT row_number() OVER (ORDER BY day) AS i, y - (SELECT avg(y) FROM daily) AS c FROM daily),
a AS (SELECT CAST(k AS INT) AS k, (SELECT sum(a.c * b.c) FROM c a JOIN c b ON a.i = b.i + k) / (SELECT sum(c * c) FROM c) AS r
      FROM (SELECT unnest(range(1, 11)) AS k)),
rs AS (SELECT list(r ORDER BY k) AS r FROM a),
dl AS (SELECT 1 AS k, [r[1]] AS phi FROM rs UNION ALL
  SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - p * phi[k + 1 - j]), p) FROM (
    SELECT k, phi, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j])))
      / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS p FROM dl, rs WHERE k < 10))
SELECT a.k AS lag, round(r, 6) AS acf, round(phi[a.k], 6) AS pacf FROM a JOIN dl ON a.k = dl.k""")
def acf_pacf(t):
    return TS.acf_pacf(views.daily_series(t), 10).select("lag", F.round("acf", 6).alias("acf"), F.round("pacf", 6).alias("pacf"))


@query("temporal_holdout", f"""
WITH {WEEKLY} SELECT strftime(week, '%Y-%m-%d') AS week, CASE WHEN row_number() OVER (ORDER BY week DESC) <= 8 THEN 'test' ELSE 'train' END AS part FROM weekly""")
def temporal_holdout(t):
    return TS.temporal_holdout(TS.weekly_sums(clean_series(t)), 8, [], "week").select(text("week"), "part")


def nation_days(t):
    """Orders summed per customer and day before the join to nations."""
    per = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("y"))
    d = per.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return d.groupBy("c_nationkey", "day").agg(F.sum("y").alias("y"))


@query("arima_forecast")
def arima_forecast(t):
    return TS.arima_forecast(TS.weekly_sums(nation_days(t), by=["c_nationkey"]), "c_nationkey")


@query("additive_forecast")
def additive_forecast(t):
    d = views.daily_by_priority(t)
    return TS.additive_forecast(d, "series", TS.holidays_around(d, "day"))


FIXED = ", ".join(f"'{md}'" for md in TS.FIXED_HOLIDAYS)


@query("holiday_features", f"""
WITH yr AS (SELECT unnest(range(min(year(o_orderdate)) - 1, max(year(o_orderdate)) + 2)) AS y FROM orders),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yr),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS k FROM e3),
easter AS (SELECT make_date(y, k // 31, k % 31 + 1) AS d FROM e4),
h AS (SELECT CAST(y || '-' || md AS DATE) AS h FROM yr, (SELECT unnest([{FIXED}]) AS md)
      UNION SELECT CAST(d + INTERVAL 1 DAY * s AS DATE) FROM easter, (SELECT unnest({TS.MOVABLE_HOLIDAYS}) AS s)),
x AS (SELECT CAST(h + INTERVAL 1 DAY * s AS DATE) AS day, s FROM h, (SELECT unnest([-1, 0, 1]) AS s)),
f AS (SELECT day, max(CAST(s = -1 AS INT)) AS before, max(CAST(s = 0 AS INT)) AS on_day, max(CAST(s = 1 AS INT)) AS after FROM x GROUP BY 1)
SELECT o_orderkey, coalesce(before, 0) AS before, coalesce(on_day, 0) AS on_day, coalesce(after, 0) AS after
FROM orders LEFT JOIN f ON CAST(o_orderdate AS DATE) = day""")
def holiday_features(t):
    d = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    h = FE.holiday_days(t.spark, {d: d for d in TS.holidays_around(d, "day")})
    flag = lambda s: F.max((F.col("shift") == s).cast("int"))
    # some thirty rows a year
    h = F.broadcast(h.groupBy("day").agg(flag(-1).alias("before"), flag(0).alias("on_day"), flag(1).alias("after")))
    return d.join(h, "day", "left").select("o_orderkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["before", "on_day", "after"]])


BASE = """
bl AS (SELECT day, y, lag(y) OVER (ORDER BY day) AS naive,
  CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS mean_7 FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
"""


@query("baseline_forecasts", f"WITH {views.DAILY}, {BASE} SELECT strftime(day, '%Y-%m-%d') AS day, naive, round(mean_7, 3) AS mean_7 FROM bl")
def baseline_forecasts(t):
    return TS.baselines(views.daily_series(t)).select(text("day"), "naive", F.round("mean_7", 3).alias("mean_7"))


def _metric(m):
    return f"""SELECT '{m}' AS model, count(*) AS n, round(avg(abs(y - {m})), 3) AS mae, round(sqrt(avg(pow(y - {m}, 2))), 3) AS rmse,
      round(avg(abs(y - {m}) / greatest(y, 1)) * 100, 5) AS mape FROM bl WHERE {m} IS NOT NULL"""


@query("forecast_metrics", f"WITH {views.DAILY}, {BASE} {_metric('naive')} UNION ALL {_metric('mean_7')}")
def forecast_metrics(t):
    m = TS.forecast_metrics(TS.baselines(views.daily_series(t)), "y", ["naive", "mean_7"])
    return m.select("model", "n", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"), F.round("mape", 5).alias("mape"))


@query("forecast_comparison")
def forecast_comparison(t):
    """All forecasters on the same held-out days of every series, ranked."""
    d = views.daily_by_priority(t)
    return TS.ranked_forecasts(TS.backtest_forecasts(d, "series", TS.holidays_around(d, "day")))


@query("timeseries_split", f"""
WITH {views.DAILY}, d AS (SELECT day, row_number() OVER (ORDER BY day) AS i, count(*) OVER () AS n FROM daily),
f AS (SELECT day, i, n, k, n // 6 AS s, n - (6 - k) * (n // 6) AS start FROM d, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
r AS (SELECT *, CASE WHEN i <= start THEN 'train' WHEN i <= start + s THEN 'test' END AS role FROM f)
SELECT k AS fold, role, count(*) AS n, strftime(min(day), '%Y-%m-%d') AS first, strftime(max(day), '%Y-%m-%d') AS last
FROM r WHERE role IS NOT NULL GROUP BY 1, 2""")
def timeseries_split(t):
    return TS.timeseries_folds(views.daily_series(t)).select("fold", "role", "n", text("first"), text("last"))
