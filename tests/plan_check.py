"""What a query executed: the plans of all its written stages and of its result."""

import re

PYTHON_OK = {"udf_scalar", "udtf_flat_map", "udaf_reduce", "reduce_concat", "reduce_concat_all", "foreach_rows",
             "stream_late_pairs", "stream_pair_lines", "encode"}
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "AggregateInPandas", "MapInPandas",
          "MapInArrow", "BatchEvalPythonUDTF", "ArrowEvalPythonUDTF")


def _executions(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    seq = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [seq.apply(i) for i in range(seq.size())]


def watch(spark, work):
    """Run ``work`` and return (its result, the plans it executed)."""
    before = {e.executionId() for e in _executions(spark)}
    result = work()
    return result, [e.physicalPlanDescription() for e in _executions(spark) if e.executionId() not in before]


def check(name, plans):
    """No cross products or nested-loop joins, and no Python outside the
    user-function queries."""
    assert plans
    for plan in plans:
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        if name not in PYTHON_OK:
            for node in PYTHON:
                assert not re.search(rf"\b{node}\b", plan), node


def rows_scanned(spark, work, kind=""):
    """Run ``work`` and return (its result, rows that its file scans gave out); ``kind``:
    of files of this format only."""
    before = {e.executionId() for e in _executions(spark)}
    result = work()
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    for e in _executions(spark):
        if e.executionId() in before:
            continue
        values, nodes = store.executionMetrics(e.executionId()), store.planGraph(e.executionId()).allNodes()
        for i in range(nodes.size()):
            if not nodes.apply(i).name().startswith(f"Scan {kind}"):
                continue
            metrics = nodes.apply(i).metrics()
            for k in range(metrics.size()):
                m = metrics.apply(k)
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return result, total
