"""Every registered query with SQL against DuckDB, on the smallest test data."""

import pytest

from check import compare, connect
from oracle.queries import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    from __spark_entry__ import queries

    exact, _, note = compare(queries()[name](spark, FOLDER), duck, SQL[name])
    assert exact, note


def test_entry_runs(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_every_query_is_named_and_checked():
    from __spark_entry__ import oracle_sql, queries
    from catalogue import QUERIES

    names = set(QUERIES)
    assert names <= set(queries()) and set(SQL) <= names and set(SQL) <= set(oracle_sql())
    rows_only = names - set(SQL)
    assert rows_only == {
        "segments", "segment_profiles", "cluster_eval", "champion_holdout", "champion_thresholds",
        "champion_frozen_threshold", "batch_scores", "tree_attribution", "tree_importance",
        "customer_reports", "model_compare", "tuned_model", "holdout_comparison",
    }
