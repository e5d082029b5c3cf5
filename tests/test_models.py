"""Known answers for fitted models."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import clustering as CL, models as M, splits as SP, timeseries as TS
from tallyframe.operators.plotdata import poisson_weights
from tallyframe.session import shared_path


@pytest.fixture(scope="module")
def two_classes(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal(3 * (i % 2), 0.3)), float(rng.normal()), i % 2) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, a double, b double, y int").cache()


def test_separable_classes(two_classes):
    m = M.logistic(["a", "b"], "y").fit(two_classes)
    assert M.classifier_metrics(m.transform(two_classes), "y")["auc"] == pytest.approx(1.0)
    imp = M.importances(M.forest(["a", "b"], "y", 5, 3).fit(two_classes), ["a", "b"], two_classes.sparkSession).first()
    assert imp["feature"] == "a"
    r = M.recursive_elimination(two_classes, ["a", "b"], "y", 1, 3)
    assert r.where("kept").first()["feature"] == "a"


def test_folds_and_learning_curve(two_classes):
    d = SP.stratified_folds(two_classes, "doc_id", "y", 3)
    s = M.cross_validate(d, lambda: M.logistic(["a"], "y"), "y")
    assert [x["fold"] for x in s] == [0, 1, 2] and min(x["accuracy"] for x in s) > 0.97
    c = M.learning_curve(two_classes, lambda: M.logistic(["a"], "y"), "y", "doc_id", [0.5, 1.0], 2)
    assert c.count() == 2 and c.first()["verdict"] == "healthy"


def test_search_log_keeps_best(two_classes):
    log = M.model_search(two_classes, ["a"], "y", trials=3, objective=lambda f, p, d: {"logistic": 0.7, "forest": 0.9, "boosted": 0.8}[f])
    rows = log.orderBy("trial").collect()
    assert [r["best_so_far"] for r in rows] == list(np.maximum.accumulate([r["value"] for r in rows]))


def test_shapley_adds_up(two_classes):
    m = M.logistic(["a", "b"], "y").fit(two_classes)
    bg = two_classes.agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    base = M.score(m, bg).first()["probability_1"]
    rows = two_classes.orderBy("doc_id").limit(5)
    got = M.shapley_values(m, rows, "doc_id", ["a", "b"], bg.first().asDict(), 4)
    assert got.count() == 10
    s = {r[0]: r[1] for r in got.groupBy("doc_id").agg(F.sum("contribution")).collect()}
    for r in M.score(m, rows).collect():
        assert s[r["doc_id"]] == pytest.approx(r["probability_1"] - base, abs=2e-4)


def test_saved_model_predicts_the_same(spark, two_classes):
    m = M.logistic(["a", "b"], "y").fit(two_classes)
    back = M.save_and_reload(m, shared_path(spark, "m"))
    p = lambda x: [tuple(r) for r in M.score(x, two_classes).orderBy("doc_id").select("probability_1", "decision").collect()]
    assert p(m) == p(back)


def test_balanced_weights(spark):
    d = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    w = {r["y"]: r["weight"] for r in M.balanced_weights(d, "y").collect()}
    assert w == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}


def test_ridge_cv_equals_direct_fits(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 2)) * [1, 5]
    y = x @ [2, -1] + rng.normal(size=60)
    d = spark.createDataFrame([(*map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))], "a double, b double, y double, fold int")
    got = {r["alpha"]: r["mse"] for r in M.ridge_cv(d, ["a", "b"], "y", [1.0, 100.0]).collect()}
    f = np.arange(60) % 3
    for alpha in (1.0, 100.0):
        errs = []
        for k in range(3):
            xt, yt, xv, yv = x[f != k], y[f != k], x[f == k], y[f == k]
            m, s = xt.mean(0), xt.std(0)
            z = (xt - m) / s
            w = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (yt - yt.mean()))
            errs.append(np.mean((yv - yt.mean() - (xv - m) / s @ w) ** 2))
        assert got[alpha] == pytest.approx(np.mean(errs))


def test_linear_models_rank(spark):
    d = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), ((F.col("id") * 7) % 11).cast("double").alias("b"))
    d = d.withColumn("y", 5 + 3 * F.col("a") - 2 * F.col("b"))
    r = {x["model"]: x["rmse"] for x in M.linear_models(d, d, ["a", "b"], "y", ridge=400.0, lasso=1.0, elastic=(1.0, 0.5)).collect()}
    assert r["OLS"] == pytest.approx(0, abs=1e-6) and r["Ridge"] > 1 and r["Lasso"] > 0.5


def test_kmeans_finds_blobs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal((i % 4) * 10, 0.5, 2))) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, x double, y double")
    c = CL.kmeans(d, ["x", "y"], 4)
    assert sorted(r[0] for r in c.groupBy("cluster").count().select("count").collect()) == [50, 50, 50, 50]
    curve = {r["k"]: r for r in CL.kmeans_curve(d, ["x", "y"], [2, 4]).collect()}
    assert curve[4]["inertia"] < curve[2]["inertia"] and curve[4]["silhouette"] > 0.95


def test_forecasts_follow_trend_and_season(spark):
    week = lambda i: date.fromordinal(729999 + 7 * i)
    w = spark.createDataFrame([("s", week(i), 100.0 + 5 * i + (i % 3)) for i in range(80)], "series string, week date, y double")
    f = TS.arima_forecast(w, "series").orderBy("step").collect()
    assert len(f) == 8 and all(r["lower"] < r["actual"] < r["upper"] for r in f)
    d = spark.createDataFrame([("s", date.fromordinal(730000 + i), 50 + 0.1 * i + (20.0 if i % 7 == 0 else 0.0)) for i in range(500)],
                              "series string, day date, y double")
    t = TS.additive_forecast(d, "series", []).where("is_test")
    assert t.count() == 60
    assert t.agg(F.avg(F.abs(F.col("actual") - F.col("yhat")))).first()[0] < 4


def test_poisson_weights_have_mean_and_variance_one():
    w = poisson_weights(np.arange(20000), 5)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.03)
