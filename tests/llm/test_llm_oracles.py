"""Every query with SQL against it, all rows; the others give rows with the columns asked for."""

import pytest
from oracle_check import connect, difference

from tallyforge.llm.oracles import ORACLES
from tallyforge.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, sf_dir, name):
    count, wrong = difference(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert wrong is None
    assert count > 0


def test_without_oracle_are_only_trained_models():
    assert set(QUERIES) - set(ORACLES) == {"op3_url_filter", "op5_secrets", "op6_pii", "op12_toxicity", "op13_alignment"}
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
