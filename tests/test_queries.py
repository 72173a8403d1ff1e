"""Every registered query against its DuckDB oracle on the smallest scale, and the
plans it executed."""

import os

import pytest

import __spark_entry__ as E
from skein.plans.catalog import QUERIES
from skein.plans.oracle import ORACLE
import sys
sys.path.insert(0, os.path.dirname(__file__))
from oracle_check import compare, duck  # noqa: E402
from plan_check import check, watch  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r, plans = watch(spark, lambda: compare(spark, name, QUERIES[name], ORACLE[name], SF, con))
    assert r["ok"], r
    check(name, plans)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["pos", "id", "parent_id", "parent_pos", "parent_body", "reply_body"]
    assert df.count() >= 0
