"""A Python flat map runs by batches of rows, not by calls of a table function."""

import os
import sys

from pyspark.sql import functions as F

from skein.functions.udfs import flat_map_rows, table_function
from skein.plans.catalog import QUERIES
sys.path.insert(0, os.path.dirname(__file__))
from plan_check import watch  # noqa: E402


def test_flat_map_equals_the_table_function(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 3, "a"), (None, 0, "b"), (2, -1, None), (3, 150_000, "long")],
                               "id long, n long, s string").repartition(2)
    got = flat_map_rows(df, range, "n")
    assert got.columns == ["id", "n", "s", "elem", "value"]
    want = df.lateralJoin(table_function(range)(F.col("n").outer()))
    assert got.schema["value"].dataType == want.schema["value"].dataType
    assert got.count() == 150_006 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    words = flat_map_rows(df.where("s IS NOT NULL"), lambda s: s[:2], "s", "string").groupBy("s", "value").count()
    assert {tuple(r) for r in words.collect()} == {("a", "a", 2), ("b", "b", 1), ("long", "l", 1), ("long", "o", 1)}


def test_no_function_call_joins_rows(spark, tmp_path):
    spark.range(20).selectExpr("id AS event_id", "1L AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    found, plans = watch(spark, lambda: QUERIES["udtf_flat_map"](spark, str(tmp_path)).collect())
    assert len(found) == 30 and not any("UDTF" in p for p in plans)
