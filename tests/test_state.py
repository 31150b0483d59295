"""Fitted-state tables: save, load, identical forecasts, buckets never shuffled."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, grid_df, hourly_rows
from tidecast.operators import series as S
from tidecast.operators.models import autoreg, fourier, naive, state
from tidecast.plans import datasets as D

QS = (0.1, 0.9)


@pytest.fixture(scope="module")
def history(spark):
    hist = S.train_part(D.events_hourly(spark, SF_SMALL), 72).filter("item_id in ('click', 'view', 'error')")
    short = grid_df(spark, hourly_rows("short", [1.0, 2.0, 4.0]))
    return hist.unionByName(short).persist()


CASES = {
    "resample": (state.resample_state, state.resample_forecast, lambda h: naive.kernel_resample(h, 48, quantiles=QS)),
    "fourier": (state.fourier_state, state.fourier_forecast, lambda h: fourier.fourier_forecast(h, 48, quantiles=QS)),
    "ar": (state.ar_state, state.ar_forecast, lambda h: autoreg.ar_p_forecast(h, 48, 2, quantiles=QS)),
}


def rows(df):
    return {(r["model"], r["item_id"], r["step"], r["quantile"]): (r["ts"], r["value"]) for r in df.collect()}


@pytest.mark.parametrize("kind", CASES)
def test_forecasts_from_the_saved_state_are_those_from_the_history(spark, history, tmp_path, kind):
    make, forecast, direct = CASES[kind]
    target = str(tmp_path / kind)
    state.save(make(history), target, buckets=4)
    got, want = rows(forecast(state.load(spark, target), 48, quantiles=QS)), rows(direct(history))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("kind", CASES)
def test_the_state_is_never_shuffled(spark, history, tmp_path, kind):
    make, forecast, _ = CASES[kind]
    target = str(tmp_path / kind)
    state.save(make(history), target, buckets=8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        loaded = state.load(spark, target)
        plan = forecast(loaded, 48, quantiles=QS)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        some = state.requested(loaded, spark.createDataFrame([("click",), ("click",)], "item_id string"))
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        # the plan prints the state's side first: no exchange before its scan
        assert "Exchange" not in plan[:plan.index("FileScan")]
        assert [r["item_id"] for r in some.collect()] == ["click"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_new_version_replaces_the_old_one(spark, history, tmp_path):
    target = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        state.load(spark, target)
    state.save(state.ar_state(history.filter("item_id = 'click'")), target, buckets=2)
    old = state.load(spark, target)
    state.save(state.ar_state(history.filter("item_id = 'view'")), target, buckets=3)
    assert [r["item_id"] for r in state.load(spark, target).select("item_id").collect()] == ["view"]
    assert [r["item_id"] for r in old.select("item_id").collect()] == ["click"]     # a reader keeps what it resolved
    assert state.load(spark, target).agg(F.count(F.lit(1))).first()[0] == 1
