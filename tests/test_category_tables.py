"""Contingency without a grid, corrected pair tests, sparse one-hot codes, shared-key pairs, drift report, partial autocorrelation."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import features as FE, monitoring as M, relational as RL, stats as S, timeseries as TS


def chi_by_grid(rows):
    rows = [r for r in rows if None not in r]
    o, na, nb, n = Counter(rows), Counter(a for a, _ in rows), Counter(b for _, b in rows), len(rows)
    yates = len(na) == len(nb) == 2
    gap = lambda a, b: abs(o[a, b] - na[a] * nb[b] / n)
    part = lambda a, b: (gap(a, b) - (min(0.5, gap(a, b)) if yates else 0)) ** 2 / (na[a] * nb[b] / n)
    return sum(part(a, b) for a in na for b in nb), (len(na) - 1) * (len(nb) - 1)


@pytest.mark.parametrize("rows", [
    [("x", "u")] * 7 + [("x", "v")] * 2 + [("y", "v")] * 5,                                   # 2 by 2 with an empty cell
    [("x", "u")] * 3 + [("x", "v")] * 3 + [("y", "u")] * 4 + [("y", "v")] * 5,                # all gaps below a half
    [("x", "u")] * 4 + [("y", "v")] * 3 + [("z", "w")] * 2 + [(None, "u"), ("x", None)] * 3,  # empty cells and nulls
])
def test_chi_square_equals_grid(spark, rows):
    got = S.chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    want, df = chi_by_grid(rows)
    assert got["chi2"] == pytest.approx(want, rel=1e-12) and got["df"] == df and 0 <= got["p"] <= 1


def test_chi_square_odd_tables(spark):
    one = S.chi_square(spark.createDataFrame([("x", "u")] * 3 + [("x", "v")], "a string, b string"), "a", "b").first()
    assert (one["r"], one["c"], one["n"], one["df"], one["chi2"], one["p"], one["v"]) == (1, 2, 4, 0, None, None, None)
    none = S.chi_square(spark.createDataFrame([], "a string, b string"), "a", "b").collect()
    assert len(none) == 1 and none[0]["chi2"] is None


def test_chi_square_many_levels(spark):
    n = 300_000
    d = spark.range(n).select((F.col("id") % 100_000).alias("a"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("b"))
    got = S.chi_square(d, "a", "b").first()
    x = d.toPandas()
    na, nb, o = x.groupby("a").size(), x.groupby("b").size(), x.groupby(["a", "b"]).size()
    e = o.index.get_level_values(0).map(na).to_numpy() * o.index.get_level_values(1).map(nb).to_numpy()
    want = n * (float(np.sum(o.to_numpy() ** 2 / e)) - 1)
    assert got["chi2"] == pytest.approx(want, rel=1e-9)
    assert (got["r"], got["c"]) == (len(na), len(nb))


def test_holm_and_bonferroni(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{i}", float(v)) for i in range(9) for v in rng.normal(i * 0.25, 1, 25)] + [("lone", 1.0), (None, 9.0)]
    d = spark.createDataFrame(rows, "g string, x double")
    got = {(r.a, r.b): r for r in S.posthoc_pairwise(d, "x", "g", "holm", blocks=4).collect()}
    names = sorted({g for g, _ in rows if g is not None})
    assert set(got) == set(combinations(names, 2))
    known = sorted((r for r in got.values() if r.p is not None), key=lambda r: r.p)
    assert len(known) >= 36
    top = 0.0
    for i, r in enumerate(known):
        top = max(top, min(1.0, r.p * (len(known) - i)))
        assert r.p_corr == pytest.approx(top)
    x = {g: np.array([v for h, v in rows if h == g]) for g in names}
    r = got["g0", "g5"]
    assert r.t == pytest.approx((x["g0"].mean() - x["g5"].mean()) / math.sqrt(x["g0"].var(ddof=1) / 25 + x["g5"].var(ddof=1) / 25))
    for r in S.posthoc_pairwise(d, "x", "g", "bonferroni").collect():
        assert r.p is None or r.p_corr == pytest.approx(min(1.0, r.p * len(known)))


def test_sparse_one_hot(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "k string")
    index = FE.category_index(train, "k")
    ix = {r.k: r["index"] for r in index.collect()}
    assert ix["b"] == 0 and sorted(ix.values()) == [0, 1, 2] and set(ix) == {"a", "b", "c"}
    got = [(r.k, r.hot.size, r.hot.indices, r.hot["values"]) for r in FE.one_hot_sparse(
        spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "k string"), "k", index).collect()]
    want = [("a", 3, [ix["a"]], [1.0]), ("b", 3, [0], [1.0]), ("new", 3, [], []), (None, 3, [], [])]
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = FE.one_hot_sparse(train, "k", FE.category_index(train.limit(0), "k")).collect()
    assert {(r.hot.size, tuple(r.hot.indices)) for r in empty} == {(0, ())}


def test_sparse_one_hot_with_many_categories(spark):
    d = spark.range(150_000).select(F.concat(F.lit("category-"), (F.col("id") % 100_000).cast("string")).alias("k"))
    ix = FE.category_index(d, "k").toPandas()
    assert sorted(ix["index"]) == list(range(100_000))
    twice = {f"category-{i}" for i in range(50_000)}
    assert set(ix[ix["index"] < 50_000]["k"]) == twice
    hot = FE.one_hot_sparse(d, "k", FE.category_index(d, "k"))
    assert hot.where("hot.size = 100000 AND size(hot.indices) = 1").count() == 150_000


def test_co_occurrence(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, "c"), (None, "a"), (4, None)] + [(5, "a")] * 500 + [(5, "c")] * 400
    got = {(r.a, r.b): (r.n_keys, r.n_pairs) for r in RL.co_occurrence(spark.createDataFrame(rows, "k int, i string"), "k", "i").collect()}
    assert got == {("a", "b"): (2, 3), ("a", "c"): (2, 1 + 500 * 400), ("b", "c"): (1, 1)}


def test_drift_report(spark):
    rows = [(p, float(i % 50 + (200 if p and i % 2 else 0)), float(i % 7)) for p in (False, True) for i in range(400)]
    d = spark.createDataFrame(rows, "p boolean, x double, y double")
    fall = M.accuracy_drop(d, F.when(F.col("p"), F.col("y") < 4).otherwise(F.lit(True)), "p")
    got = {r.column: r for r in M.drift_report(M.bin_counts(d, ["x", "y"], "p"), M.ks_two_sample(d, ["x", "y"], "p"), fall).collect()}
    assert (got["x"].status, got["x"].ks_status, got["y"].status, got["y"].ks_status) == ("drift", "drift", "stable", "stable")
    assert got["y"].retrain and got["y"].accuracy_drop == pytest.approx(1 - sum(i % 7 < 4 for i in range(400)) / 400)
    same = M.accuracy_drop(d, F.lit(None).cast("boolean"), "p")
    got = {r.column: r.retrain for r in M.drift_report(M.bin_counts(d, ["x", "y"], "p"), M.ks_two_sample(d, ["x", "y"], "p"), same).collect()}
    assert got == {"x": True, "y": False}


def test_partial_autocorrelation_solves_yule_walker(spark):
    rng = np.random.default_rng(5)
    y = np.zeros(400)
    for i in range(2, 400):
        y[i] = 0.6 * y[i - 1] - 0.3 * y[i - 2] + rng.normal()
    d = spark.createDataFrame(pd.DataFrame({"day": range(400), "y": y}))
    got = sorted(TS.acf_pacf(d, 6).collect(), key=lambda r: r.lag)
    r = [1.0] + [g.acf for g in got]
    for k in range(1, 7):
        m = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k - 1].pacf == pytest.approx(np.linalg.solve(m, r[1:k + 1])[-1], abs=1e-10)
