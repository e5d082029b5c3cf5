"""The bucketed operators are exact, also with hot groups, hot values, ties and nulls."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators import ordered as O
from tallyframe.operators import windows as WD


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 4000
    pdf = pd.DataFrame({
        "id": np.arange(n), "g": np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abc"), n)),
        "t": np.where(rng.random(n) < 0.4, 77.0, np.round(rng.normal(50, 20, n), 1)),  # one value holds 40 % of the rows
        "v": np.round(rng.exponential(10, n), 3)})
    pdf.loc[rng.random(n) < 0.3, "v"] = None
    return spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).cache()


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("buckets", [2, 16, 128])
def test_row_index_equals_window(skewed, buckets):
    got = O.row_index(skewed, "t", "id", ["g"], buckets=buckets)
    want = skewed.withColumn("rn", F.row_number().over(W.partitionBy("g").orderBy("t", "id")).cast("long"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")


def test_hot_value_is_split(skewed):
    b = O.bucketize(skewed, "t", "id", 32).groupBy("__b").count().agg(F.max("count")).first()[0]
    assert b < 4000 / 32 * 4


def test_prefix_sums_descending(skewed):
    d = skewed.where("v IS NOT NULL")
    got = O.prefix_sums(d, {"s": F.col("v")}, "t", "id", ["g"], ascending=False, buckets=16)
    w = W.partitionBy("g").orderBy(F.desc("t"), F.desc("id")).rowsBetween(W.unboundedPreceding, 0)
    want = d.withColumn("s", F.sum("v").over(w))
    assert rows(got.withColumn("s", F.round("s", 6)), "id", "s") == rows(want.withColumn("s", F.round("s", 6)), "id", "s")


def test_forward_fill_equals_window(skewed):
    got = O.forward_fill(skewed, "v", "t", "id", ["g"], buckets=64)
    w = W.partitionBy("g").orderBy("t", "id").rowsBetween(W.unboundedPreceding, 0)
    want = skewed.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert rows(got, "id", "v") == rows(want, "id", "v")


def test_bounded_window_equals_window(skewed):
    f = lambda w: {"a": F.lag("v", 3).over(w), "b": F.lead("v", 2).over(w), "m": F.avg("v").over(w.rowsBetween(-3, 2))}
    got = O.bounded_window(skewed, f, "t", "id", ["g"], back=3, ahead=2, block=7)
    want = skewed.withColumns(f(W.partitionBy("g").orderBy("t", "id")))
    r = lambda d: rows(d.withColumn("m", F.round("m", 9)), "id", "a", "b", "m")
    assert r(got) == r(want)


def test_competition_rank(skewed):
    got = WD.competition_rank(skewed, "t", "r")
    want = skewed.withColumn("r", F.rank().over(W.orderBy(F.desc("t"))).cast("long"))
    assert rows(got, "id", "r") == rows(want, "id", "r")


@pytest.mark.parametrize("accuracy", [20, 100, 10000])
def test_quantiles_of_groups(skewed, accuracy):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {(r["g"], r["column"], r["p"]): r["value"] for r in O.exact_quantiles(skewed, ["t", "v"], probs, ["g"], accuracy).collect()}
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        for c in ("t", "v"):
            for p in probs:
                assert got[g, c, p] == pytest.approx(part[c].astype(float).dropna().quantile(p), abs=1e-9)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40), st.sampled_from([0.0, 0.2, 1 / 3, 0.5, 0.75, 1.0]))
def test_quantile_of_small_lists(spark, xs, p):
    d = spark.createDataFrame([(float(x),) for x in xs], "x double")
    assert O.exact_quantiles(d, ["x"], [p]).first()["value"] == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)


def test_quantiles_of_nothing(spark):
    d = spark.createDataFrame([(None,), (None,)], "x double")
    assert O.exact_quantiles(d, ["x"], [0.5]).count() == 0


def test_hash_rank_is_a_permutation(skewed):
    r = [x[0] for x in O.hash_rank(skewed, "id").select("rn").collect()]
    assert sorted(r) == list(range(1, 4001))
