"""Every query of the library with check SQL agrees with DuckDB on the smallest tables; the others return rows."""

import pytest

import __spark_entry__ as entry
from tallyframe.plans import registry
from tools.compare import check, connect

registry.load_all()

FOLDER = "/root/testdata/sf0.001"
SLOW = {"text_classifiers", "random_search", "model_search", "feature_set_scores", "recursive_elimination", "learning_curve",
        "kmeans", "communities", "gradient_boosting", "run_log", "word_embeddings", "additive_forecast"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_duckdb(spark, con, name):
    msg, _, _ = check(spark, con, name, FOLDER)
    assert msg == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES) - SLOW))
def test_runs(spark, con, name):
    msg, _, n = check(spark, con, name, FOLDER)
    assert msg == "" and n > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
