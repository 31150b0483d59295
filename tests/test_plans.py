"""Plan shape of every registered query: no cross products or nested-loop joins, no
row-at-a-time Python UDFs, and column pruning reaching the Parquet scans."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plans(df):
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString(), qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    logical, physical = _plans(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in physical, f"{name}: {bad} in plan"
    assert "Join Cross" not in logical
    # scans read only the columns the query needs: `props` is never used
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()):
        assert "props" not in schema, f"{name}: unpruned scan {schema}"
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", physical)
    for cols in scans:
        assert "props" not in cols, f"{name}: unpruned scan {cols}"


def test_backtest_scans_events_once(spark):
    df = E.queries()["backtest_metrics"](spark, SF_SMALL)
    df.collect()
    physical = df._jdf.queryExecution().executedPlan().toString()
    # every branch reads the persisted grid, so the raw table appears only inside it
    assert "InMemoryTableScan" in physical or "InMemoryRelation" in physical
