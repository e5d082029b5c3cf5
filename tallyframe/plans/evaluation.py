"""Splits and evaluation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import evaluation as E, splits as SP
from tallyframe.operators.ordered import lookup_join
from tallyframe.plans.registry import query


@query("random_split", """
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS rn, count(*) OVER () AS n FROM customer)
SELECT c_custkey, CASE WHEN rn <= n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS part FROM r""")
def random_split(t):
    return SP.random_split(t.customer.select("c_custkey"), "c_custkey")


@query("stratified_split", """
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS rn,
  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rn <= floor(n * 0.8) THEN 'train'
  WHEN rn <= floor(n * 0.8) + floor((n - floor(n * 0.8)) / 2) THEN 'validation' ELSE 'test' END AS part FROM r""")
def stratified_split(t):
    return SP.stratified_split(t.labels.select("doc_id", "quality"), "doc_id", "quality")


@query("stratified_kfold", """
WITH r AS (SELECT quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS INT) AS fold FROM labels)
SELECT fold, quality, count(*) AS n FROM r GROUP BY 1, 2""")
def stratified_kfold(t):
    d = SP.stratified_folds(t.labels.select("doc_id", "quality"), "doc_id", "quality")
    return d.groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n"))


def scored(t):
    """Labels with a rule prediction and a score in 0..1 made from the text length."""
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    top = d.agg(F.max("n_chars")).scalar()
    return d.select("doc_id", "quality", "n_chars", (F.col("n_chars") > 800).cast("int").alias("pred"),
                    F.round(F.pow(F.col("n_chars") / top, 0.25), 6).alias("score"))


SC = """
sc0 AS (SELECT doc_id, quality, n_chars FROM labels JOIN documents USING (doc_id)),
sc AS (SELECT doc_id, quality, n_chars, CAST(n_chars > 800 AS INT) AS pred, round(pow(n_chars / (SELECT max(n_chars) FROM sc0), 0.25), 6) AS score FROM sc0)
"""


@query("regression_metrics", """
WITH p AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS f FROM orders)
SELECT count(*) AS n, round(sqrt(avg(pow(y - f, 2))), 4) AS rmse, round(avg(abs(y - f)), 4) AS mae,
  round(1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*)), 8) AS r2 FROM p""")
def regression_metrics(t):
    m = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("f"))
    r = E.regression_metrics(lookup_join(t.orders, m, ["o_orderpriority"]), "o_totalprice", "f")
    return r.select("n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2"))


CLS = """
c AS (SELECT k, count(*) FILTER (quality = k) AS sup, count(*) FILTER (pred = k) AS said, count(*) FILTER (quality = k AND pred = k) AS hit
      FROM sc, (SELECT unnest([0, 1]) AS k) GROUP BY 1),
m AS (SELECT CAST(k AS VARCHAR) AS "row", coalesce(hit / nullif(said, 0), 0) AS precision, coalesce(hit / nullif(sup, 0), 0) AS recall,
      coalesce(2 * hit / nullif(said + sup, 0), 0) AS f1, sup AS support, hit FROM c)
"""


@query("classification_report", f"""
WITH {SC}, {CLS}, u AS (
SELECT "row", precision, recall, f1, support FROM m
UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM m
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM m)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM u""")
def classification_report(t):
    r = E.classification_report(scored(t), "quality", "pred")
    return r.select("row", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


@query("confusion_matrix", f"""
WITH {SC} SELECT CAST(quality AS BIGINT) AS label, count(*) FILTER (pred = 1) AS pred_1, count(*) FILTER (pred = 0) AS pred_0 FROM sc GROUP BY 1""")
def confusion_matrix(t):
    return E.confusion_matrix(scored(t), "quality", "pred", [1, 0])


@query("roc_auc", f"""
WITH {SC}, g AS (SELECT CAST(n_chars AS DOUBLE) AS threshold, sum(quality)::BIGINT AS pos, sum(1 - quality)::BIGINT AS neg FROM sc GROUP BY 1),
p AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM g),
a AS (SELECT sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS auc FROM p)
SELECT threshold, round(fp / (SELECT sum(neg) FROM g), 6) AS fpr, round(tp / (SELECT sum(pos) FROM g), 6) AS tpr, round(auc, 6) AS auc FROM p, a""")
def roc_auc(t):
    p = E.roc_points(scored(t), "quality", "n_chars")
    area = E.auc(p).scalar()
    return p.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"), F.round(area, 6).alias("auc"))


TH = [0.3, 0.4, 0.5, 0.6, 0.7]


@query("threshold_sweep", f"""
WITH {SC} SELECT CAST(h AS DOUBLE) AS threshold, round(coalesce(count(*) FILTER (score >= h AND quality = 1) / nullif(count(*) FILTER (score >= h), 0), 0), 6) AS precision,
  round(coalesce(count(*) FILTER (score >= h AND quality = 1) / nullif(count(*) FILTER (quality = 1), 0), 0), 6) AS recall
FROM sc, (SELECT unnest({TH}) AS h) GROUP BY h""")
def threshold_sweep(t):
    s = E.threshold_sweep(scored(t), "quality", "score", TH)
    return s.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("risk_segments", f"""
WITH {SC} SELECT CASE WHEN score <= 0 THEN NULL WHEN score <= 0.3 THEN 'low' WHEN score <= 0.6 THEN 'medium' WHEN score <= 1 THEN 'high' END AS band,
  count(*) AS n FROM sc GROUP BY 1""")
def risk_segments(t):
    return E.risk_bands(scored(t), "score")
