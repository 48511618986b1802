"""Plan-shape guards over every registered query (sf0.001)."""

import __spark_entry__ as E
from test_entry import core

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_or_nested_loop_joins(spark):
    bad = {}
    for key, fn in core(E.queries()).items():
        plan = physical(fn(spark, SF))
        found = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin") if p in plan]
        if found:
            bad[key] = found
    assert bad == {}


def test_dedupe_limits_before_the_shuffle(spark):
    plan = physical(E.queries()["dedupe_latest"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_scans_are_pruned(spark):
    plan = physical(E.queries()["orphan_rows"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
