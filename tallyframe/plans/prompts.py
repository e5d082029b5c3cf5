"""Prompt, reply and KPI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import prompts as P
from tallyframe.plans import views
from tallyframe.plans.registry import query

TEMPLATE = "Orders {priority}: average {mean}, large share {share}. Record: {record}"


@query("prompt_render", """
WITH k AS (SELECT o_orderpriority AS p, count(*) AS n, CAST(round(avg(o_totalprice)) AS BIGINT) AS m,
  CAST(round(avg(CASE WHEN o_totalprice > 250000 THEN 1.0 ELSE 0.0 END) * 100) AS BIGINT) AS s FROM orders GROUP BY 1)
SELECT p AS priority, 'Orders ' || p || ': average ' || format('{:,}', m) || ', large share ' || s || '%. Record: {"priority":"' || p || '","n":' || n || '}' AS prompt FROM k""")
def prompt_render(t):
    k = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("m"), F.avg((F.col("o_totalprice") > 250000).cast("double")).alias("s"))
    return k.select("priority", P.render(
        TEMPLATE, priority=F.col("priority"), mean=F.format_number(F.round("m"), 0),
        share=F.concat(F.round(F.col("s") * 100).cast("long").cast("string"), F.lit("%")),
        record=F.to_json(F.struct("priority", "n"))).alias("prompt"))


@query("reply_parse", f"""
WITH {views.REPLIES} SELECT event_id, CASE WHEN event_id % 3 < 2 THEN event_type ELSE 'unknown' END AS sentiment,
  CASE WHEN event_id % 3 < 2 THEN value ELSE 0.5 END AS score, '?' AS priority FROM rp""")
def reply_parse(t):
    return P.parse_reply(views.replies(t), "reply").drop("reply")


def _has(words):
    return " OR ".join(f"contains(p, '{w}')" for w in words)


@query("model_map", f"""
WITH c AS (SELECT conv_id, turn, lower(CASE role WHEN 'user' THEN 'Sentiment of: ' WHEN 'assistant' THEN 'Write a summary of: ' ELSE '' END || text) AS p FROM conversations)
SELECT conv_id, turn, CASE WHEN {_has(P.SENTIMENT_WORDS)} THEN '{P.OFFLINE_SENTIMENT}' WHEN {_has(P.SUMMARY_WORDS)} THEN '{P.OFFLINE_SUMMARY}'
  ELSE '{P.OFFLINE_OTHER}' END AS reply, NULL::VARCHAR AS error FROM c""")
def model_map(t):
    ask = F.when(F.col("role") == "user", "Sentiment of: ").when(F.col("role") == "assistant", "Write a summary of: ").otherwise("")
    d = t.conversations.select("conv_id", "turn", F.concat(ask, "text").alias("prompt"))
    return d.select("conv_id", "turn", P.rule_reply(F.col("prompt")).alias("reply"), F.lit(None).cast("string").alias("error"))


@query("kpi_summary", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS s FROM orders GROUP BY 1),
c AS (SELECT month, (s / lag(s) OVER (ORDER BY month) - 1) * 100 AS ch FROM m),
k AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
n AS (SELECT n_name, sum(o_totalprice) AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT (SELECT round(avg(o_totalprice), 4) FROM orders) AS mean_value, (SELECT round(arg_max(ch, month), 4) FROM c) AS month_change_pct,
  (SELECT n_name FROM n ORDER BY s DESC LIMIT 1) AS best_place, (SELECT round(avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END), 6) FROM k) AS returning_share""")
def kpi_summary(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    place = per.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("s").alias("s")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    best = place.agg(F.max_by("n_name", "s")).scalar()
    change = P.month_change(t.orders, "o_orderdate", "o_totalprice").agg(F.max_by("change_pct", "month")).scalar()
    k = per.agg((F.sum("s") / F.sum("n")).alias("m"), F.avg((F.col("n") > 1).cast("double")).alias("r"))
    return k.select(F.round("m", 4).alias("mean_value"), F.round(change, 4).alias("month_change_pct"), best.alias("best_place"),
                    F.round("r", 6).alias("returning_share"))


@query("anomaly_rows", f"""
WITH {views.DAILY}, m AS (SELECT day, y, lag(y, 7) OVER (ORDER BY day) AS p, count(*) OVER w AS c, avg(y) OVER w AS a, stddev(y) OVER w AS s
  FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT strftime(day, '%Y-%m-%d') AS day, CASE WHEN c = 28 THEN round((y / a - 1) * 100, 6) END AS drop_pct, round((y / p - 1) * 100, 6) AS week_pct,
  CASE WHEN c = 28 THEN round((y - a) / s, 6) END AS z, coalesce(c = 28 AND abs((y - a) / s) > 2, false) AS is_anomaly FROM m""")
def anomaly_rows(t):
    d = P.anomaly_rows(views.daily_series(t))
    return d.select(F.date_format("day", "yyyy-MM-dd").alias("day"), *[F.round(c, 6).alias(c) for c in ["drop_pct", "week_pct", "z"]], "is_anomaly")
