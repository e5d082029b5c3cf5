"""Normal law as columns, movable holidays, forecast comparison, text classifiers, word vectors, Ward clustering."""

import math
from datetime import date, timedelta
from statistics import NormalDist

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import distributions as D
from tallyframe.operators import clustering as CL, models as M, stats as S, text as TX, timeseries as TS


def test_normal_columns(spark):
    z = [-40.0, -38.0, -9.0, -7.08, -7.05, -3.3, -1.0, -1e-9, 0.0, 1e-9, 0.5, 2.0, 7.05, 7.08, 9.0, None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").select(D.normal_cdf_column(F.col("z"))).collect()]
    assert got[-1] is None and got[:-1] == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in z[:-1]], rel=1e-9, abs=1e-15)
    p = [1e-300, 1e-12, 1e-4, 0.02, 0.074, 0.0751, 0.3, 0.5, 0.9, 0.9249, 0.9251, 1 - 1e-12]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(D.normal_ppf_column(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(x) for x in p], rel=1e-13, abs=1e-15)
    odd = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "p double").select(D.normal_ppf_column(F.col("p"))).collect()
    assert [r[0] for r in odd] == [None] * 4
    plan = spark.range(5).select(D.normal_ppf_column(F.col("id") / 9), D.normal_cdf_column(F.col("id")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_histogram_column(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.5, 9.99, 10.0, None)], "x double")
    got = {r.x: (r.bin, r.bin_rows) for r in S.with_histogram(rows, "x", 4).collect()}
    assert got == {0.0: (0, 2), 1.0: (0, 2), 2.5: (1, 1), 9.99: (3, 2), 10.0: (3, 2), None: (None, None)}
    flat = S.with_histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert [(r.bin, r.bin_rows) for r in flat] == [(0, 2)] * 2


def test_easter_and_holidays():
    # fixed values: Easter Sundays
    known = {1818: "03-22", 1943: "04-25", 1954: "04-18", 1981: "04-19", 1997: "03-30", 2000: "04-23", 2022: "04-17", 2023: "04-09", 2024: "03-31", 2038: "04-25",
             2049: "04-18", 2076: "04-19"}
    assert {y: TS.easter(y).isoformat()[5:] for y in known} == known
    days = TS.holiday_dates(2022, 2023)
    assert {"2022-04-15", "2022-04-18", "2022-06-06", "2023-04-07", "2023-04-10", "2023-05-29", "2022-12-26"} <= set(days) and len(days) == 22


def test_forecasts_are_measured_on_the_same_periods(spark):
    days = [date(1996, 1, 1) + timedelta(days=k) for k in range(200)]
    rng = np.random.default_rng(3)
    rows = [(s, d, float(100 + 10 * (k % 7) + k * slope + rng.normal())) for s, slope in (("a", 0.5), ("b", -0.2)) for k, d in enumerate(days)]
    rows += [("short", d, 5.0) for d in days[:40]]
    df = spark.createDataFrame(rows, "series string, day date, y double")
    test = TS.backtest_forecasts(df, "series", TS.holidays_around(df, "day"), horizon=30).cache()
    got = test.toPandas()
    assert got.groupby("series").size().to_dict() == {"a": 30, "b": 30, "short": 30}
    assert got[got.series == "short"][TS.FORECASTERS].isna().all().all()
    for s in ("a", "b"):
        known = np.array([y for x, d, y in rows if x == s])
        part = got[got.series == s].sort_values("period")
        assert part.period.tolist() == [str(d) for d in days[-30:]] and part.actual.tolist() == known[-30:].tolist()
        assert set(part.naive) == {known[-31]} and part.mean_7.iloc[0] == pytest.approx(known[-37:-30].mean())
    ranked = {r.model: r for r in TS.ranked_forecasts(test).collect()}
    con = duckdb.connect()
    con.register("t", got.dropna())
    for m in TS.FORECASTERS:
        n, mae, rmse, mape = con.execute(f"select count(*), avg(abs(actual - {m})), sqrt(avg((actual - {m}) ** 2)), avg(abs(actual - {m}) / greatest(actual, 1)) * 100 from t").fetchone()
        r = ranked[m]
        assert (r.n, r.mae, r.rmse, r.mape) == (n, pytest.approx(mae), pytest.approx(rmse), pytest.approx(mape))
    assert sorted(ranked, key=lambda m: ranked[m]["rank"]) == sorted(ranked, key=lambda m: ranked[m].mae)
    assert ranked["additive"]["rank"] == 1  # weekly season and trend are what it models
    assert ranked["naive"].gain_pct == 0


TOPICS = {"de": "und der die nicht haus strasse", "en": "and the house street with garden", "fr": "maison rue avec jardin pour dans", "es": "casa calle jardín entre desde para",
          "xx": "zorba plink wuggle frotz nitfol gnusto"}


@pytest.fixture(scope="module")
def topic_docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(250):
        lang = list(TOPICS)[i % 5]
        rows.append((i, lang, " ".join(rng.choice(TOPICS[lang].split() + ["common", "words"], 12))))
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def with_terms(docs):
    from tallyframe.functions.text import tokens

    return docs.withColumn("terms", TX.ngrams(tokens(F.col("text")))).cache()


def test_classifier_weights_are_those_of_tfidf(spark, topic_docs):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    d = with_terms(topic_docs)
    want = {(r.doc_id, r.term): r.weight for r in TX.tfidf(topic_docs, "doc_id", "text", size=10_000).collect()}
    model = Pipeline(stages=M.text_stages(10_000)).fit(d)
    vocab = model.stages[0].vocabulary
    got = {(r.doc_id, vocab[j]): x for r in model.transform(d).select("doc_id", vector_to_array("features").alias("v")).collect() for j, x in enumerate(r.v) if x}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("kind", ["logistic", "naive_bayes", "linear_svc"])
def test_classifier_learns_the_labels_it_is_given(spark, topic_docs, tmp_path, kind):
    d = with_terms(topic_docs)
    model = M.text_classifier(kind, d, "lang").fit(d)
    assert model.transform(d).where("lang = predicted").count() == 250
    model.write().overwrite().save(f"{tmp_path}/m")
    back = M.without_labels(type(model).load(f"{tmp_path}/m"))
    new = with_terms(spark.createDataFrame([(1, "wuggle frotz gnusto"), (2, "maison jardin rue")], "doc_id long, text string"))
    assert {r.doc_id: r.predicted for r in back.transform(new).collect()} == {1: "xx", 2: "fr"}
    if kind == "logistic":
        top = M.top_coefficients(model, spark, 3).collect()
        assert {r.label for r in top} == set(TOPICS) and all(set(r.term.split()) & set(TOPICS[r.label].split()) for r in top)
        two = d.where("lang in ('de', 'fr')")
        top = M.top_coefficients(M.text_classifier(kind, two, "lang").fit(two), spark, 3).collect()
        assert all(set(r.term.split()) & set(TOPICS[r.label].split()) for r in top) and len(top) == 6


def test_ppmi_by_hand(spark):
    docs = [["a", "b", "c", "a"], ["b"], [], None, ["a", "a"]]
    df = spark.createDataFrame([(x,) for x in docs], "ws array<string>")
    count = {}
    for ws in docs:
        for i, x in enumerate(ws or []):
            for j, y in enumerate(ws):
                if i != j and abs(i - j) <= 2:
                    count[x, y] = count.get((x, y), 0) + 1
    total = sum(count.values())
    side = {w: sum(n for (x, _), n in count.items() if x == w) for w in "abc"}
    want = {k: (n, max(0, math.log(n * total / (side[k[0]] * side[k[1]])))) for k, n in count.items()}
    got = {(r.word, r.context): (r.n, r.ppmi) for r in TX.ppmi(df, "ws", window=2).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in want)


def test_vectors_find_planted_neighbours(spark):
    """Words of one group share contexts, never each other; the nearest words of each are of its group."""
    rng = np.random.default_rng(5)
    docs = []
    for _ in range(1500):
        g = rng.integers(4)
        docs.append(([f"c{g}_{rng.integers(6)}", f"w{g}_{rng.integers(5)}", f"c{g}_{rng.integers(6)}"],))
    pairs = TX.ppmi(spark.createDataFrame(docs, "ws array<string>"), "ws", window=1)
    v = TX.word_vectors(pairs, dims=8).cache()
    assert v.count() == 44
    for w in ("w0_0", "w3_4"):
        near = [r.neighbour for r in TX.nearest_words(v, w, 4).collect()]
        assert all(n.startswith(w[:3]) for n in near)
    assert TX.nearest_words(v, "missing", 4).count() == 0
    m = np.zeros((44, 44))
    names = sorted(r.word for r in v.collect())
    for r in pairs.collect():
        m[names.index(r.word), names.index(r.context)] = r.ppmi
    top = np.sort(np.abs(np.linalg.eigvalsh(m)))[::-1][:4]
    x = np.array([r.vector for r in v.orderBy("word").collect()])
    assert (x ** 2).sum(0)[:4] == pytest.approx(top, rel=0.02)
    empty = spark.createDataFrame([], "ws array<string>")
    assert TX.word_vectors(TX.ppmi(empty, "ws")).count() == 0


def plain_ward(points):
    """Ward's linkage by looking at all pairs in every step."""
    live = {i: (np.array(p, float), 1) for i, p in enumerate(points)}
    heights, sets = [], {i: {i} for i in live}
    while len(live) > 1:
        h, a, b = min((2 * n * m / (n + m) * ((x - y) ** 2).sum(), i, j) for i, (x, n) in live.items() for j, (y, m) in live.items() if i < j)
        (x, n), (y, m) = live.pop(a), live.pop(b)
        k = len(points) + len(heights)
        live[k], sets[k] = ((x * n + y * m) / (n + m), n + m), sets[a] | sets[b]
        heights.append((math.sqrt(h), frozenset(sets[k])))
    return heights


def test_ward_equals_the_plain_linkage(spark):
    rng = np.random.default_rng(2)
    pts = np.round(np.concatenate([rng.normal(c, 0.4, (25, 2)) for c in ((0, 0), (3, 0), (0, 4), (5, 5))]), 6)
    want = plain_ward(pts)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    tree = CL.ward_tree(df, ["x", "y"]).orderBy("step").collect()
    assert [r.height for r in tree] == pytest.approx([h for h, _ in want]) and [r.n for r in tree] == [len(s) for _, s in want]
    for height in (1.0, 3.0, 20.0):
        parts = [{i} for i in range(100)]
        for h, s in want:
            if h <= height:
                parts = [p for p in parts if not p <= s] + [set(s)]
        got = {}
        for r in CL.hierarchical(df, ["x", "y"], height=height).collect():
            got.setdefault(r.cluster, set()).add(r.id)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, parts))
    assert CL.hierarchical(df, ["x", "y"], leaves=4).select("cluster").distinct().count() == 4


def test_ward_on_more_points_than_features(spark):
    rng = np.random.default_rng(4)
    pts = [(k, float(x), float(y)) for k, (x, y) in enumerate(np.concatenate([rng.normal(c, 0.3, (3000, 2)) for c in ((0, 0), (6, 0), (0, 6))]))]
    df = spark.createDataFrame([*pts, (-1, None, 1.0), (-2, 0.0, 0.0), (-3, 0.0, 0.0)], "id int, x double, y double")
    rows, cells = CL.micro_clusters(df, ["x", "y"], most=200)
    assert 20 < cells.count() <= 200 and cells.agg(F.sum("n")).first()[0] == 9002 and rows.count() == 9003
    got = CL.hierarchical(df, ["x", "y"], leaves=3, most=200).toPandas()
    assert got[got.id == -1].cluster.isna().all()
    by = [set(got[(got.id >= k * 3000) & (got.id < (k + 1) * 3000)].cluster) for k in range(3)]
    assert all(len(s) == 1 for s in by) and len(set.union(*by)) == 3
    none = spark.createDataFrame([], "id int, x double, y double")
    assert CL.hierarchical(none, ["x", "y"]).count() == 0 and CL.ward_tree(none, ["x", "y"]).count() == 0
    same = spark.createDataFrame([(k, 1.0, 2.0) for k in range(5)], "id int, x double, y double")
    assert [r.cluster for r in CL.hierarchical(same, ["x", "y"]).collect()] == [0] * 5
