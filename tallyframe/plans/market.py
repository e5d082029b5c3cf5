"""Market-series queries on daily totals per priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import market as M
from tallyframe.plans import views
from tallyframe.plans.registry import query

BY = ["series"]
P = "PARTITION BY series ORDER BY day"


def day():
    return F.date_format("day", "yyyy-MM-dd").alias("day")


@query("rsi", f"""
WITH {views.DAILY_BY_PRIORITY}, c AS (SELECT *, y - lag(y) OVER ({P}) AS ch FROM dp),
g AS (SELECT day, series, CASE WHEN ch > 0 THEN ch ELSE 0 END AS g, CASE WHEN ch < 0 THEN -ch ELSE 0 END AS l FROM c)
SELECT strftime(day, '%Y-%m-%d') AS day, series,
  CASE WHEN count(*) OVER w = 14 THEN round(100 - 100 / (1 + avg(g) OVER w / (avg(l) OVER w + 1e-8)), 6) END AS rsi
FROM g WINDOW w AS ({P} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
def rsi(t):
    return M.rsi(views.daily_by_priority(t), BY).select(day(), "series", F.round("rsi", 6).alias("rsi"))


@query("bollinger", f"""
WITH {views.DAILY_BY_PRIORITY}, m AS (SELECT *, count(*) OVER w AS c, avg(y) OVER w AS a, stddev(y) OVER w AS s FROM dp
  WINDOW w AS ({P} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT strftime(day, '%Y-%m-%d') AS day, series, CASE WHEN c = 20 THEN round(a, 4) END AS mid,
  CASE WHEN c = 20 THEN round(a + 2 * s, 2) END AS upper, CASE WHEN c = 20 THEN round(a - 2 * s, 2) END AS lower FROM m""")
def bollinger(t):
    return M.bollinger(views.daily_by_priority(t), BY).select(
        day(), "series", F.round("mid", 4).alias("mid"), F.round("upper", 2).alias("upper"), F.round("lower", 2).alias("lower"))


SIG = views.DAILY_BY_PRIORITY + f""",
ma AS (SELECT *, CASE WHEN count(*) OVER a = 20 THEN avg(y) OVER a END AS f, CASE WHEN count(*) OVER b = 50 THEN avg(y) OVER b END AS s FROM dp
  WINDOW a AS ({P} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), b AS ({P} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
sg AS (SELECT *, CASE WHEN f > s THEN 1 ELSE -1 END AS signal FROM ma WHERE f IS NOT NULL AND s IS NOT NULL),
ch AS (SELECT *, signal - lag(signal) OVER ({P}) AS change FROM sg)
"""


@query("crossover_signals", f"""
WITH {SIG} SELECT strftime(day, '%Y-%m-%d') AS day, series, signal, change, coalesce(change > 0, false) AS buy, coalesce(change < 0, false) AS sell FROM ch""")
def crossover_signals(t):
    return M.crossover_signals(views.daily_by_priority(t), BY).select(day(), "series", "signal", "change", "buy", "sell")


BT = SIG + f""",
hd AS (SELECT *, coalesce(last_value(CASE WHEN change > 0 THEN 1 WHEN change < 0 THEN 0 END IGNORE NULLS)
  OVER ({P} ROWS UNBOUNDED PRECEDING), 0) AS held FROM ch),
st AS (SELECT *, coalesce(ln(y / lag(y) OVER ({P})) * lag(held) OVER ({P}), 0) AS step FROM hd),
bt AS (SELECT *, 100000 * exp(sum(step) OVER ({P} ROWS UNBOUNDED PRECEDING)) AS value FROM st)
"""


@query("backtest", f"WITH {BT} SELECT strftime(day, '%Y-%m-%d') AS day, series, held, round(value, 2) AS value FROM bt")
def backtest(t):
    b = M.backtest(M.crossover_signals(views.daily_by_priority(t), BY), BY)
    return b.select(day(), "series", "held", F.round("value", 2).alias("value"))


@query("performance_metrics", f"""
WITH {BT}, r AS (SELECT *, value / lag(value) OVER ({P}) - 1 AS r, max(value) OVER ({P} ROWS UNBOUNDED PRECEDING) AS peak FROM bt),
h AS (SELECT series, arg_max(y, day) / arg_min(y, day) - 1 AS hold FROM dp GROUP BY 1)
SELECT r.series, round(arg_max(value, day) / 100000 - 1, 6) AS strategy_return, round(avg(r) / stddev(r) * sqrt(252), 6) AS sharpe,
  round(min((value - peak) / peak), 6) AS max_drawdown, round(min(hold), 6) AS hold_return FROM r JOIN h ON r.series = h.series GROUP BY 1""")
def performance_metrics(t):
    d = views.daily_by_priority(t)
    p = M.performance(d, M.backtest(M.crossover_signals(d, BY), BY), BY)
    return p.select("series", *[F.round(c, 6).alias(c) for c in ["strategy_return", "sharpe", "max_drawdown", "hold_return"]])
