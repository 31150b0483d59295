import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tidecast.plans.catalog import QUERIES

#: The other registered queries have their tests beside them.
ORACLE = {name: sql for name, (_fn, sql) in QUERIES.items() if sql is not None}


def test_entry_returns_metrics(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and {"rmse", "mae", "smape"} <= set(df.columns)


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (str(v) if math.isinf(v) else round(v, 6) + 0.0)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(recs, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(cur.fetchall(), dcols)
    # same Arrow types column by column (INT vs BIGINT, DATE vs TIMESTAMP …)
    s_types = {f.name: str(f.type) for f in df.toArrow().schema}
    d_types = {f.name: str(f.type) for f in duck.sql(E.oracle_sql()[name]).arrow().schema}
    assert s_types == d_types


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_bench_headline_names_are_registered():
    import bench
    assert set(bench.HEADLINE) <= set(E.queries())
    assert "backtest_metrics" in bench.HEADLINE
