"""Streaming queries: the same events read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.plans.registry import query
from tallyframe.streaming import jobs as J


@query("stream_window_agg", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total, round(avg(value), 9) AS mean FROM events GROUP BY 1, 2""")
def stream_window_agg(t):
    s = J.window_report(J.file_stream(t.spark, t.folder, "events"), "ts", "value", "event_type")
    d = J.run_to_end(s, "window-report", "complete")
    return d.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"),
                    F.round("mean", 9).alias("mean"))


REF_END = "2024-01-11"


@query("stream_drift", f"""
WITH ref AS (SELECT value FROM events WHERE ts < TIMESTAMP '{REF_END}'), r AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM ref),
bi AS (SELECT unnest(range(10)) AS b),
rb AS (SELECT b, coalesce(nullif(count(value) / (SELECT n FROM r), 0), 1e-6) AS r FROM bi LEFT JOIN
  (SELECT value, greatest(least(floor((value - lo) * 10 / (hi - lo)), 9), 0) AS k FROM ref, r) ON k = b GROUP BY 1),
w AS (SELECT strftime(ts, '%Y-%m-%d') AS day, greatest(least(floor((value - lo) * 10 / (hi - lo)), 9), 0) AS k FROM events, r),
t AS (SELECT day, count(*) AS n FROM w GROUP BY 1),
wb AS (SELECT day, k, count(*) AS c FROM w GROUP BY 1, 2),
p AS (SELECT t.day, t.n, rb.r, coalesce(c / t.n, 1e-6) AS p FROM t CROSS JOIN rb LEFT JOIN wb ON wb.day = t.day AND wb.k = rb.b),
s AS (SELECT day, n, sum((p - r) * ln(p / r)) AS psi FROM p GROUP BY 1, 2)
SELECT day, n, round(psi, 8) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'watch' ELSE 'drift' END AS status FROM s""")
def stream_drift(t):
    ref = t.events.where(F.col("ts") < F.lit(REF_END).cast("timestamp_ntz"))
    lo, hi, shares = J.reference_bins(ref, "value")
    c = J.drift_counts(J.file_stream(t.spark, t.folder, "events"), "ts", "value", lo, hi, len(shares))
    d = J.run_to_end(c, "drift", "complete", lambda b: J.drift_report(b, shares))
    return d.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n", F.round("psi", 8).alias("psi"), "status")


@query("stream_score")
def stream_score(t):
    """A fitted model scores events as they arrive; the log keeps input, probability and decision."""
    from tallyframe.operators import models as MD

    k = F.get_json_object("props", "$.k").cast("double").alias("k")
    rows = lambda d: d.select("event_id", "ts", "value", k)
    train = t.events.select("value", k, (F.col("event_type") == "error").cast("int").alias("label"))
    model = MD.logistic(["value", "k"], "label").fit(train)
    s = J.file_stream(t.spark, t.folder, "events")
    scored = MD.score(model, rows(s)).select("event_id", "ts", "value", "k", "probability_1", "decision", "risk")
    return J.run_to_end(scored, "scores", "append")
