"""Every registered query against its SQL, all rows, at the smallest scale."""

import pytest
from oracle_check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from tallyforge.plans.oracles import ORACLES
from tallyforge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, sf_dir, name):
    count, wrong = difference(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert wrong is None
    assert count > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_without_oracle_are_only_models_without_a_closed_form():
    assert set(QUERIES) - set(ORACLES) == {
        "explained_variance",
        "eigenvectors_top3",
        "reconstruction_error",
        "reconstruction_extremes",
        "gbt_depth_sweep",
        "rf_depth_sweep",
        "model_compare",
    }


def test_entry(spark):
    assert entry(spark).count() == 25
