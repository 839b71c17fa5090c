"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
HEAVY = {"tune", "boosted_trees", "logistic_baseline", "score_all"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, queries()[name], oracle_sql()[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - HEAVY))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
