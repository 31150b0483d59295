"""Properties: results do not depend on row order or partitioning; metrics agree with a
plain numpy evaluation on random inputs; edge cases (one series, NaN input)."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, grid_df, hourly_rows, series_df
from tidecast.operators import metrics as M
from tidecast.operators import series as S
from tidecast.operators.models import naive
from tidecast.plans import datasets as D
from tidecast.plans.backtest import backtest


def _metrics_of(spark, events):
    cells = S.aggregate_cells(events, "1 hour", "exact_sum", 2)
    grid = S.regularise(cells, "1 hour", fill=0.0, span="global")
    bt = backtest(grid, lambda h, n: naive.seasonal_naive(h, n, 24), 72)
    return sorted(tuple(r) for r in M.point_metrics(bt.paired(None)).collect())


def test_row_order_and_partitioning_do_not_change_results(spark):
    ev = D.events_as_series(spark, SF_SMALL)
    base = _metrics_of(spark, ev)
    shuffled = ev.withColumn("_k", F.rand(11)).orderBy("_k").drop("_k").repartition(7)
    other = _metrics_of(spark, shuffled)
    assert len(other) == len(base)
    for r1, r2 in zip(base, other):
        # inputs are summed exactly; only the order of the final double averages may differ
        assert all(_same(a, b) if isinstance(a, float) else a == b for a, b in zip(r1, r2))


def _np_metrics(y, f):
    y, f = np.asarray(y, float), np.asarray(f, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return {
            "rmse": float(np.sqrt(np.mean((f - y) ** 2))),
            "mae": float(np.mean(np.abs(f - y))),
            "smape": float(np.mean(2 * np.abs(f - y) / (np.abs(y) + np.abs(f)))),
            "mpe": float(np.mean((f - y) / y)),
            "mape": float(np.mean(np.abs(f - y) / np.abs(y))),
            "mean_y": float(np.mean(y)),
        }


def _same(a, b):
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    if math.isinf(a) or math.isinf(b):
        return a == b
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


values = st.lists(st.integers(min_value=-3, max_value=3).map(float), min_size=1, max_size=12)


@settings(max_examples=25, deadline=None)
@given(values, st.data())
def test_point_metrics_match_numpy(spark, ys, data):
    fs = data.draw(st.lists(st.integers(min_value=-3, max_value=3).map(float),
                            min_size=len(ys), max_size=len(ys)))
    rows = [("m", "a", i + 1, y, f) for i, (y, f) in enumerate(zip(ys, fs))]
    df = spark.createDataFrame(rows, "model STRING, item_id STRING, step INT, y DOUBLE, f DOUBLE")
    got = M.point_metrics(df).first().asDict()
    want = _np_metrics(ys, fs)
    for k, v in want.items():
        assert _same(got[k], v), (k, got[k], v)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50).map(float), min_size=1, max_size=40),
       st.sampled_from([0.1, 0.3, 0.5, 0.7, 0.9]))
def test_nearest_rank_matches_sorted_index(spark, xs, q):
    df = spark.createDataFrame([("a", x) for x in xs], "item_id STRING, value DOUBLE")
    idx = int(np.round((len(xs) - 1) * q))
    for bins in (None, 4):
        got = M.summarise_samples(df, ["item_id"], "value", (q,), bins=bins).first()
        assert got[f"q{int(round(q * 100)):02d}"] == sorted(xs)[idx]


def test_one_series_and_nan_input(spark):
    g = grid_df(spark, hourly_rows("only", [1.0, float("nan"), 3.0, 4.0]))
    assert S.describe_series(g).first().n_series == 1
    fc = naive.seasonal_naive(g, 2, 2)
    vals = [r.value for r in fc.orderBy("step").collect()]
    assert vals == [3.0, 4.0]


def test_gaps_become_nulls_and_shift_nothing(spark):
    from datetime import timedelta
    from conftest import T0
    rows = [("a", T0, 1.0), ("a", T0 + timedelta(hours=5), 6.0)]
    g = S.regularise(series_df(spark, rows), "1 hour").orderBy("step").collect()
    assert [r.target for r in g] == [1.0, None, None, None, None, 6.0]
    assert g[-1].ts == T0 + timedelta(hours=5)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=0, max_value=30),
                          st.integers(min_value=-5, max_value=5)),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])),
       st.integers(min_value=1, max_value=8))
def test_grid_and_splits_match_python(spark, pts, horizon):
    from datetime import timedelta
    from conftest import T0
    rows = [(i, T0 + timedelta(hours=h), float(v)) for i, h, v in pts]
    g = S.regularise(series_df(spark, rows), "1 hour", fill=0.0)
    got = {(r.item_id, r.step): r.target for r in g.collect()}
    want = {}
    for item in {i for i, _, _ in pts}:
        hours = {h: float(v) for i, h, v in pts if i == item}
        lo, hi = min(hours), max(hours)
        for k in range(hi - lo + 1):
            want[(item, k)] = hours.get(lo + k, 0.0)
    assert got == want
    # holdout = last `horizon` grid points, train = the rest (slicing semantics)
    split = {(r.item_id, r.ts): r.split for r in S.holdout_split(g, horizon).collect()}
    raw = {(r.item_id, r.ts): r.split for r in S.holdout_split(series_df(spark, rows), horizon).collect()}
    for item in {i for i, _, _ in pts}:
        ts_grid = sorted(t for (i, t) in split if i == item)
        assert [split[(item, t)] for t in ts_grid] == ["train"] * max(len(ts_grid) - horizon, 0) + \
            ["holdout"] * min(horizon, len(ts_grid))
        ts_raw = sorted(t for (i, t) in raw if i == item)
        assert [raw[(item, t)] for t in ts_raw] == ["train"] * max(len(ts_raw) - horizon, 0) + \
            ["holdout"] * min(horizon, len(ts_raw))
    ctx = S.context(g, 3, horizon).collect()
    for item in {i for i, _, _ in pts}:
        n = sum(1 for (i, _) in want if i == item)
        steps = sorted(r.step for r in ctx if r.item_id == item)
        assert steps == list(range(max(n - horizon - 3, 0), max(n - horizon, 0)))
