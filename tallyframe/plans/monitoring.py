"""Input validation and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import monitoring as M
from tallyframe.operators.ordered import one_row
from tallyframe.plans import views
from tallyframe.plans.registry import query
from tallyframe.session import shared_path

COLS = ["l_extendedprice", "l_quantity", "l_discount"]


@query("input_validation", f"""
WITH {views.DIRTY_LINEITEM}, f AS (SELECT l_orderkey, l_linenumber, list_filter([
  CASE WHEN l_quantity IS NULL OR l_quantity < 1 OR l_quantity > 45 THEN 'quantity' END,
  CASE WHEN l_discount IS NULL OR l_discount < 0 THEN 'discount' END,
  CASE WHEN l_extendedprice > 500000 THEN 'price' END], lambda x: x IS NOT NULL) AS failed FROM dl)
SELECT l_orderkey, l_linenumber, array_to_string(failed, ',') AS failed, len(failed) = 0 AS valid FROM f""")
def input_validation(t):
    rules = {"quantity": M.in_range("l_quantity", 1, 45), "discount": M.in_range("l_discount", 0), "price": M.in_range("l_extendedprice", high=500000)}
    ok, bad = M.validate(views.dirty_lineitem(t), rules)
    out = lambda d, failed, valid: d.select("l_orderkey", "l_linenumber", failed.alias("failed"), F.lit(valid).alias("valid"))
    return out(ok, F.lit(""), True).unionByName(out(bad, F.array_join("failed", ","), False))


def _bins(c):
    return f"""SELECT '{c}' AS "column", b AS bin, count(*) FILTER (NOT is_prod) AS ref, count(*) FILTER (is_prod) AS prod FROM
      (SELECT is_prod, CAST(least(floor(({c} - lo) * 10 / (hi - lo)), 9) AS INT) AS b FROM drift, (SELECT min({c}) AS lo, max({c}) AS hi FROM drift)) GROUP BY 2"""


BINS = views.DRIFT + f""",
bn AS ({" UNION ALL ".join(_bins(c) for c in COLS)}),
sh AS (SELECT "column", bin, coalesce(nullif(ref / (sum(ref) OVER w), 0), 1e-6) AS r, coalesce(nullif(prod / (sum(prod) OVER w), 0), 1e-6) AS p FROM bn
       WINDOW w AS (PARTITION BY "column"))
"""
PSI = f"""WITH {BINS} SELECT "column", sum((p - r) * ln(p / r)) AS psi, sum(p * ln(p / r)) AS kl FROM sh GROUP BY 1"""


def bins(t):
    return M.bin_counts(views.drift_pair(t), COLS, "is_prod")


@query("psi", f"""SELECT "column", round(psi, 8) AS psi FROM ({PSI})""")
def psi(t):
    return M.psi(bins(t)).select("column", F.round("psi", 8).alias("psi"))


def _ks(c):
    return f"""SELECT '{c}' AS "column", max(abs(cr / nr - cp / np)) AS d, max(nr) AS nr, max(np) AS np FROM (
      SELECT sum(r) OVER (ORDER BY v) AS cr, sum(p) OVER (ORDER BY v) AS cp, sum(r) OVER () AS nr, sum(p) OVER () AS np FROM (
        SELECT {c} AS v, count(*) FILTER (NOT is_prod) AS r, count(*) FILTER (is_prod) AS p FROM drift GROUP BY 1))"""


KS = " UNION ALL ".join(_ks(c) for c in COLS)


@query("drift_status", f"""
WITH ps AS ({PSI}),
ks AS (WITH {views.DRIFT} SELECT "column", d, d * sqrt(nr * np / (nr + np)) AS x FROM ({KS})),
kp AS (SELECT "column", d, CASE WHEN x < 0.2 THEN 1 ELSE 2 * list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))) END AS p FROM ks),
m AS (WITH {views.DRIFT} SELECT avg(l_extendedprice) AS mean FROM drift WHERE NOT is_prod),
ac AS (WITH {views.DRIFT}, h AS (SELECT is_prod, CAST((l_extendedprice > mean) = (l_quantity > 25) AS INT) AS hit FROM drift, m)
  SELECT avg(hit) FILTER (NOT is_prod) - avg(hit) FILTER (is_prod) AS fall FROM h)
SELECT "column", round(psi, 8) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'watch' ELSE 'drift' END AS status,
  CASE WHEN p < 0.05 THEN 'drift' ELSE 'stable' END AS ks_status, round(fall, 6) AS accuracy_drop, psi > 0.25 OR fall >= 0.05 AS retrain
FROM ps JOIN kp USING ("column"), ac""")
def drift_status(t):
    """The prediction that is judged: a price above the reference mean means more than 25 pieces."""
    d = views.drift_pair(t)
    mean = one_row(d.where("NOT is_prod").agg(F.avg("l_extendedprice").alias("mean")))["mean"]
    fall = M.accuracy_drop(d, (F.col("l_extendedprice") > mean) == (F.col("l_quantity") > 25), "is_prod")
    r = M.drift_report(bins(t), M.ks_two_sample(d, COLS, "is_prod"), fall)
    return r.select("column", F.round("psi", 8).alias("psi"), "status", "ks_status", F.round("accuracy_drop", 6).alias("accuracy_drop"), "retrain")


@query("ks_two_sample", f"""WITH {views.DRIFT} SELECT "column", round(d, 8) AS d FROM ({KS})""")
def ks_two_sample(t):
    return M.ks_two_sample(views.drift_pair(t), COLS, "is_prod").select("column", F.round("d", 8).alias("d"))


@query("kl_divergence", f"""SELECT "column", round(kl, 8) AS kl FROM ({PSI})""")
def kl_divergence(t):
    return M.kl_divergence(bins(t)).select("column", F.round("kl", 8).alias("kl"))


@query("prediction_log", """
SELECT strftime(to_timestamp(floor(epoch(ts) / 604800) * 604800) AT TIME ZONE 'UTC', '%Y-%m-%d') AS week, count(*) AS n, round(avg(value), 6) AS mean, round(stddev(value), 6) AS std
FROM events GROUP BY 1""")
def prediction_log(t):
    path = shared_path(t.spark, "predictions")
    scored = t.events.select("event_id", "ts", F.col("value").alias("score"))
    for kind in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):  # two appends, together all rows
        M.log_predictions(scored.where(kind), path, F.col("ts"))
    w = M.weekly_summary(t.spark.read.parquet(path), "logged_at", "score")
    return w.select(F.date_format("start", "yyyy-MM-dd").alias("week"), "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))
