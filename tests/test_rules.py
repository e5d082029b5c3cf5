"""Edge rules on small hand-made frames."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import distributions as D
from tallyframe.functions.text import tokens
from tallyframe.operators import cleaning as C, evaluation as E, features as FE, market as M, monitoring as MO
from tallyframe.operators import prompts as P, relational as R, splits as SP, stats as S, text as TX, timeseries as TS, windows as WD


def col(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, x {kind}")


def values(df, c, key="id"):
    return [r[c] for r in df.orderBy(key).collect()]


def series(spark, ys):
    return spark.createDataFrame([(date.fromordinal(730000 + i), float(y) if y is not None else None) for i, y in enumerate(ys)], "day date, y double")


def test_cut_is_right_closed(spark):
    d = col(spark, [0.0, 0.5, 1.0, 2.0, 3.0, None])
    assert values(d.withColumn("b", FE.cut("x", [0, 1, 2], ["a", "b"])), "b") == [None, "a", "a", "b", None, None]
    assert values(d.withColumn("b", FE.cut("x", [0, 1, 2], ["a", "b"], True)), "b")[0] == "a"


def test_qcut_includes_lowest_and_merges_edges(spark):
    d = col(spark, [1.0, 1.0, 1.0, 1.0, 2.0, 3.0])
    assert values(FE.qcut(d, "x", 4), "bin") == [0, 0, 0, 0, 1, 1]  # edges 1, 1.75, 3


def test_constant_column_scaling(spark):
    d = col(spark, [4.0, 4.0])
    assert values(FE.standard_scale(d, ["x"]), "x") == [0.0, 0.0]
    assert values(FE.minmax_scale(d, ["x"]), "x") == [None, None]
    assert values(FE.robust_scale(d, ["x"]), "x") == [0.0, 0.0]


def test_mode_ties_take_smallest(spark):
    d = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert R.mode_value(d, ["x"]).first()["x"] == "a"


def test_all_null_column(spark):
    d = col(spark, [None, None])
    assert values(FE.impute_median(d, ["x"]), "x") == [None, None]
    assert C.missing_profile(d).first()["pct"] == 100.0


def test_iqr_cap_and_unknown_method(spark):
    d = col(spark, [1.0, 2.0, 3.0, 4.0, 100.0])
    assert values(C.cap_outliers(d, "x"), "x")[-1] == 7.0
    s = C.outlier_stats(d, "x").first()
    assert (s["n_outliers"], s["pct"], s["upper"]) == (1, 20.0, 7.0)
    with pytest.raises(ValueError):
        C.cap_outliers(d, "x", "other")


def test_zscore_uses_both_deviations(spark):
    d = col(spark, [0.0] * 19 + [100.0])
    m, s = 5.0, math.sqrt((19 * 25 + 95 ** 2) / 19)
    assert values(C.cap_outliers(d, "x", "zscore"), "x")[-1] == pytest.approx(min(100.0, m + 3 * s))
    assert C.drop_outliers(d, "x").count() == 19


def test_unit_text_and_harmonize(spark):
    d = col(spark, ["450000 Ft", " 12 Ft ", "n/a", None], "string")
    assert values(d.withColumn("n", C.unit_text_to_number(F.col("x"))), "n") == [450000.0, 12.0, None, None]
    d = col(spark, ["  BUILDING ", "buildin", "zzz", None], "string")
    h = C.harmonize(F.col("x"), {"Buildin": "Building"}, ["Building"])
    assert values(d.withColumn("h", h), "h") == ["Building", "Building", "Other", None]


def test_target_encoding_unseen(spark):
    tr = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 1.0)], "c string, y double")
    te = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = {r["c"]: r["encoded"] for r in FE.target_encode(tr, te, "c", "y").collect()}
    g = 2 / 3
    assert got["a"] == pytest.approx((1 + 10 * g) / 12) and got["z"] == pytest.approx(g) and got[None] == pytest.approx(g)


def test_loo_single_row_category(spark):
    d = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("b", 1.0)], "c string, y double")
    got = sorted((r["c"], round(r["encoded"], 6)) for r in FE.target_encode_loo(d, "c", "y").collect())
    assert got == [("a", round(2 / 3, 6)), ("b", 0.0), ("b", 1.0)]


def test_one_hot_and_ordinal_unknown(spark):
    d = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [tuple(r) for r in FE.one_hot(d, "c", ["a", "b"]).collect()] == [("a", 1, 0), ("z", 0, 0), (None, 0, 0)]
    assert [r[0] for r in d.select(FE.ordinal("c", ["b", "a"])).collect()] == [1, -1, -1]


def test_rolling_needs_three_previous(spark):
    d = WD.rolling_features(series(spark, [1, 2, 3, 4]), "y", [7], [])
    assert values(d, "mean_7", "day") == [None, None, None, 2.0]


def test_even_centred_mean(spark):
    d = series(spark, range(6)).withColumn("m", WD.centered_mean("y", 4, []))
    assert values(d, "m", "day") == [None, None, 1.5, 2.5, 3.5, None]


def test_interpolation_edges(spark):
    d = TS.interpolate_zeros(series(spark, [0, 2, 0, 0, 8, 0]))
    assert values(d, "y", "day") == [None, 2.0, 4.0, 6.0, 8.0, 8.0]


def test_rsi_without_losses_and_warmup(spark):
    d = M.rsi(series(spark, range(1, 18)), [])
    v = values(d, "rsi", "day")
    assert v[:13] == [None] * 13 and v[13] == pytest.approx(100, abs=1e-4)


def test_backtest_matches_walk(spark):
    ys = [10 + 5 * math.sin(i / 9) + 0.03 * i for i in range(200)]
    b = M.backtest(M.crossover_signals(series(spark, ys), [], 5, 12), []).orderBy("day").collect()
    cash, units, want = 100_000.0, 0.0, []
    for r in b:
        if r["buy"] and cash > 0:
            units, cash = cash / r["y"], 0.0
        elif r["sell"] and units > 0:
            cash, units = units * r["y"], 0.0
        want.append(cash + units * r["y"])
    assert [r["value"] for r in b] == pytest.approx(want)
    assert any(r["buy"] for r in b) and any(r["sell"] for r in b)


def test_mape_with_zero(spark):
    d = spark.createDataFrame([(0.0, 2.0), (4.0, 4.0)], "y double, m double")
    assert TS.forecast_metrics(d, "y", ["m"]).first()["mape"] == pytest.approx(100.0)


def test_report_with_class_never_predicted(spark):
    d = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "y int, p int")
    r = {x["row"]: x for x in E.classification_report(d, "y", "p").collect()}
    assert r["1"]["precision"] == 0 and r["1"]["f1"] == 0 and r["accuracy"]["f1"] == pytest.approx(1 / 3)


def test_auc_of_separable_and_tied(spark):
    d = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, s double")
    assert E.auc(E.roc_points(d, "y", "s")).first()[0] == 1.0
    tied = d.withColumn("s", F.lit(0.5))
    assert E.auc(E.roc_points(tied, "y", "s")).first()[0] == 0.5


def test_split_sizes(spark):
    d = spark.range(101).withColumn("c", (F.col("id") % 3 == 0).cast("int"))
    n = dict(SP.random_split(d, "id").groupBy("part").count().collect())
    assert n == {"train": 80, "test": 21}
    s = {(r[0], r[1]): r[2] for r in SP.stratified_split(d, "id", "c").groupBy("c", "part").count().collect()}
    assert s[0, "train"] == 53 and s[0, "validation"] + s[0, "test"] == 14


def test_psi_of_equal_and_shifted(spark):
    d = spark.range(2000).select((F.col("id") % 2 == 0).alias("p"), (F.col("id") / 20).cast("int").cast("double").alias("x"))
    assert MO.psi(MO.bin_counts(d, ["x"], "p")).first()["psi"] == pytest.approx(0, abs=1e-9)
    far = d.withColumn("x", F.when(F.col("p"), F.col("x") + 60).otherwise(F.col("x")))
    v = MO.psi(MO.bin_counts(far, ["x"], "p"))
    assert v.select(MO.drift_status(F.col("psi"))).first()[0] == "drift"


def test_ks_two_sample_distance(spark):
    d = spark.createDataFrame([(False, float(i)) for i in range(10)] + [(True, float(i + 5)) for i in range(10)], "p boolean, x double")
    assert MO.ks_two_sample(d, ["x"], "p").first()["d"] == pytest.approx(0.5)


def test_reply_parsing(spark):
    d = col(spark, ['{"sentiment":"good","score":0.9,"priority":"high"}', 'Sure:\n{"sentiment":"bad"}\nbye', "nothing here", "{broken"], "string")
    got = [(r["sentiment"], r["score"], r["priority"]) for r in P.parse_reply(d, "x").orderBy("id").collect()]
    assert got == [("good", 0.9, "high"), ("bad", 0.5, "?"), ("unknown", 0.5, "?"), ("unknown", 0.5, "?")]


def test_model_map_retries_and_reports(spark):
    def flaky(p, system, max_tokens):
        if p == "boom":
            raise RuntimeError("no")
        return p.upper()

    d = P.model_map(col(spark, ["a", "boom"], "string"), "x", flaky, fallback=lambda p: "?")
    assert [(r["reply"], r["error"]) for r in d.orderBy("id").collect()] == [("A", None), ("?", "RuntimeError: no")]


def test_tokens_and_pairs(spark):
    d = col(spark, ["Az Új termék, 2 db: NAGYON jó!", ""], "string")
    t = values(d.withColumn("t", tokens(F.col("x"))), "t")
    assert t == [["termék", "nagyon"], []]
    g = values(d.withColumn("g", TX.ngrams(tokens(F.col("x")))), "g")
    assert g == [["termék", "nagyon", "termék nagyon"], []]


def test_kendall_against_pairs(spark):
    xs = [1, 2, 2, 3, 4, 5, 5, 6, 7, 7]
    ys = [3, 1, 1, 4, 4, 9, 2, 6, 5, 3]
    d = spark.createDataFrame(list(zip(map(float, xs), map(float, ys))), "x double, y double")
    sgn = lambda v: (v > 0) - (v < 0)
    pairs = [(sgn(xs[i] - xs[j]), sgn(ys[i] - ys[j])) for i in range(10) for j in range(i)]
    con, dis = sum(a * b > 0 for a, b in pairs), sum(a * b < 0 for a, b in pairs)
    tau = (con - dis) / math.sqrt(sum(a != 0 for a, _ in pairs) * sum(b != 0 for _, b in pairs))
    r = S.kendall_tau(d, "x", "y").first()
    assert (r["concordant"], r["discordant"]) == (con, dis) and r["tau"] == pytest.approx(tau)


def test_distributions_textbook():
    assert float(D.t_sf2(2.228, 10)) == pytest.approx(0.05, abs=1e-4)
    assert float(D.f_sf(4.96, 1, 10)) == pytest.approx(0.05, abs=2e-4)
    assert float(D.chi2_sf(3.841, 1)) == pytest.approx(0.05, abs=1e-4)
    assert float(D.chi2_sf(18.307, 10)) == pytest.approx(0.05, abs=1e-4)
    assert float(D.normal_cdf(1.959964)) == pytest.approx(0.975, abs=1e-7)
    assert float(D.normal_ppf(0.975)) == pytest.approx(1.959964, abs=1e-6)
    assert D.t_ppf(0.975, 10) == pytest.approx(2.228139, abs=1e-5)
    assert float(D.kolmogorov_sf(1.358)[0]) == pytest.approx(0.05, abs=1e-3)


def test_shapiro_known_sample():
    # the weights example of Shapiro and Wilk (1965)
    w = S.shapiro_w([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.79, abs=0.01)
    assert S.shapiro_pvalue(w, 11) == pytest.approx(0.0067, abs=0.002)


def test_yates_only_for_two_by_two(spark):
    d = spark.createDataFrame([("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40, "a string, b string")
    r = S.chi_square(d, "a", "b").first()
    e = [12, 18, 28, 42]
    assert r["chi2"] == pytest.approx(sum((abs(o - x) - 0.5) ** 2 / x for o, x in zip([10, 20, 30, 40], e)))


def test_ols_recovers_line(spark):
    d = spark.range(200).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")).withColumn(
        "y", 3 + 2 * F.col("a") - F.col("b") + F.when(F.col("a") % 2 == 0, 0.01).otherwise(-0.01))
    coef, summary, beta = S.ols(d, "y", ["a", "b"])
    assert beta["a"] == pytest.approx(2, abs=1e-2) and beta["b"] == pytest.approx(-1, abs=1e-2)
    assert summary.first()["r2"] > 0.9999
    assert coef.where("term = 'a'").first()["p"] < 1e-6


def test_adf_on_random_walk_and_noise(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    e = rng.normal(size=300)
    assert TS.adf_test(series(spark, e + 10)).first()["p"] < 0.01
    assert TS.adf_test(series(spark, np.cumsum(e))).first()["p"] > 0.05


def test_arma_recovers_parameters():
    import numpy as np

    rng = np.random.default_rng(3)
    e, x = rng.normal(size=3000), [0.0]
    for t in range(1, 3000):
        x.append(0.6 * x[-1] + e[t] + 0.3 * e[t - 1])
    phi, theta, s2 = TS.fit_arma11(np.array(x))
    assert phi == pytest.approx(0.6, abs=0.06) and theta == pytest.approx(0.3, abs=0.08) and s2 == pytest.approx(1, abs=0.1)


def test_pacf_of_ar1():
    assert TS.pacf_values([0.5, 0.25, 0.125])[1:] == pytest.approx([0, 0], abs=1e-12)
