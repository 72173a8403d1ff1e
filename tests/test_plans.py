"""What reaches the scan. (The shape of every executed plan is checked with the
query's result, in test_queries.)"""

import os

import pytest

from skein.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["filter_rows"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan


def test_group_lists_reach_the_scan(spark):
    from skein.functions import predicates as P
    df = P.keep_groups(spark.read.parquet(f"{SF}/events.parquet"), ["click", "view"], "event_type")
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [click,view])]" in \
        df._jdf.queryExecution().executedPlan().toString()
