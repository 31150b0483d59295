import math

import pytest
from pyspark.sql import functions as F

from conftest import T0, grid_df, hourly_rows
from tidecast.operators import series as S
from tidecast.operators.models import autoreg, fourier, global_ar, naive, samples


def values(fc, q=None):
    rows = fc.filter(F.col("quantile").isNull() if q is None else F.col("quantile") == q).orderBy("step").collect()
    return [r.value for r in rows]


def test_c4_seasonal_naive(spark):
    g = grid_df(spark, hourly_rows("a", [1, 2, 3, 1, 2, 3]))
    fc = naive.seasonal_naive(g, 4, season_length=3)
    assert values(fc) == [1.0, 2.0, 3.0, 1.0]
    ts = [r.ts for r in fc.orderBy("step").collect()]
    assert ts[0] == T0.replace(hour=6)


def test_seasonal_naive_short_series_uses_mean(spark):
    g = grid_df(spark, hourly_rows("a", [1, 3]))
    assert values(naive.seasonal_naive(g, 3, season_length=24)) == [2.0, 2.0, 2.0]


def test_seasonal_naive_replicates_quantiles(spark):
    g = grid_df(spark, hourly_rows("a", [1, 2, 3, 1, 2, 3]))
    fc = naive.seasonal_naive(g, 2, season_length=3, quantiles=(0.1, 0.9))
    assert values(fc, 0.1) == values(fc, 0.9) == values(fc)


def test_periodic_series_has_zero_error(spark):
    from tidecast.operators.metrics import point_metrics
    from tidecast.plans.backtest import backtest
    vals = [float(i % 24) for i in range(24 * 5)]
    g = grid_df(spark, hourly_rows("a", vals))
    bt = backtest(g, lambda h, n: naive.seasonal_naive(h, n, 24), 48)
    assert point_metrics(bt.paired(None)).first().mae == 0.0


def test_kernel_resample_quantiles_are_monotone_and_from_history(spark):
    vals = [float((i * 7) % 11) for i in range(24 * 8)]
    g = grid_df(spark, hourly_rows("a", vals))
    fc = naive.kernel_resample(g, 48, context_length=168, season_length=24, quantiles=(0.1, 0.5, 0.9))
    q1, q5, q9 = values(fc, 0.1), values(fc, 0.5), values(fc, 0.9)
    assert len(q1) == 48
    assert all(a <= b <= c for a, b, c in zip(q1, q5, q9))
    assert set(q5) <= set(vals)


def test_kernel_resample_phase_alignment(spark):
    # constant per hour-of-day → every quantile equals that hour's value
    vals = [float(i % 24) for i in range(24 * 8 + 5)]
    g = grid_df(spark, hourly_rows("a", vals))
    fc = naive.kernel_resample(g, 30, quantiles=(0.5,))
    expect = [float((len(vals) - 1 + h) % 24) for h in range(1, 31)]
    assert values(fc, 0.5) == expect and values(fc) == pytest.approx(expect)


def test_context_mean(spark):
    g = grid_df(spark, hourly_rows("a", [10, 1, 2, 3]))
    assert values(naive.context_mean(g, 2, context_length=3)) == [2.0, 2.0]


def test_fourier_recovers_known_coefficients(spark):
    n = 24 * 21
    vals = [5.0 + 0.01 * i + 2.0 * math.sin(2 * math.pi * (i / 24.0)) for i in range(n)]
    g = grid_df(spark, hourly_rows("a", vals))
    hist = S.train_part(g, 24)
    fc = fourier.fourier_forecast(hist, 24, quantiles=(0.5,))
    got = values(fc)
    assert got == pytest.approx(vals[-24:], abs=0.05)


def test_fourier_gram_matches_numpy(spark):
    import numpy as np
    vals = [float(i % 5) for i in range(50)]
    g = grid_df(spark, hourly_rows("a", vals))
    gram = fourier.gram_sums(g).first()
    assert gram["n"] == 50
    assert gram["g__const__const"] == 50.0
    assert gram["g__const__y"] == pytest.approx(sum(vals))
    assert gram["g__trend__trend"] == pytest.approx(float(np.sum((np.arange(50) / 24.0) ** 2)))


def test_ar1_closed_form_matches_recursion(spark):
    import random
    rnd = random.Random(3)
    vals, d = [], 0.0
    base = [float(i % 24) for i in range(24)]
    for i in range(24 * 10):
        d = 0.5 + 0.6 * d + rnd.gauss(0, 0.1)
        vals.append(base[i % 24] + (vals[i - 24] - base[i % 24] if i >= 24 else 0) + d if i >= 24 else base[i])
    g = grid_df(spark, hourly_rows("a", vals))
    fit = autoreg.fit_ar1(g, 24).first()
    fc = values(autoreg.ar_forecast(g, 60, 24, quantiles=(0.5,)))
    # recursion by hand
    y = list(vals)
    dl = y[-1] - y[-25]
    for h in range(1, 61):
        dl = fit.intercept + fit.phi * dl
        y.append(y[-24] + dl)
    assert fc == pytest.approx(y[-60:], rel=1e-9, abs=1e-9)


def test_global_model_save_load_and_quantiles(spark, tmp_path):
    vals_a = [10.0 + (i % 24) for i in range(24 * 12)]
    vals_b = [50.0 + 2 * (i % 24) for i in range(24 * 12)]
    g = grid_df(spark, hourly_rows("a", vals_a) + hourly_rows("b", vals_b))
    params = global_ar.GlobalARParams(horizon=24, quantiles=(0.1, 0.5, 0.9))
    model = global_ar.GlobalARModel.fit(S.train_part(g, 24), params)
    fc = model.forecast(S.train_part(g, 24))
    assert fc.count() == 2 * 24 * 4
    a = fc.filter("item_id = 'a'")
    assert all(x <= y <= z for x, y, z in zip(values(a, 0.1), values(a, 0.5), values(a, 0.9)))
    assert values(a) == pytest.approx(vals_a[-24:], abs=0.5)
    path = str(tmp_path / "model")
    model.save(spark, path)
    again = global_ar.GlobalARModel.load(spark, path)
    fc2 = again.forecast(S.train_part(g, 24))
    assert fc2.exceptAll(fc).count() == 0


def test_sample_paths_do_not_depend_on_partitioning(spark):
    g = grid_df(spark, hourly_rows("a", [float(i % 7) for i in range(24 * 4)]))
    point = naive.seasonal_naive(g, 24, 24)
    pool = samples.residual_pool(g, 24)
    p1 = samples.sample_paths(point, pool, 50, seed=7)
    p2 = samples.sample_paths(point.repartition(5), pool.repartition(3), 50, seed=7)
    assert p1.count() == 24 * 50
    assert p1.exceptAll(p2).count() == 0 and p2.exceptAll(p1).count() == 0
    from tidecast.operators.metrics import describe_forecast
    d = describe_forecast(p1).first()
    assert (d.num_samples, d.horizon, d.n_values) == (50, 24, 24 * 50)
    assert d.start_date == T0 + (24 * 4) * (T0.replace(hour=1) - T0)


def test_m7_configure_hook_replaces_by_name(spark):
    from tidecast.functions.features import DAILY
    got = fourier.configured((DAILY,), fourier.add_seasonality("weekly", 7, 3, 0.1))
    assert [s.name for s in got] == ["daily", "weekly"] and got[1].prior_scale == 0.1
    again = fourier.configured(got, fourier.add_seasonality("weekly", 7, 2, 1.0))
    assert len(again) == 2 and again[1].order == 2
    g = grid_df(spark, hourly_rows("a", [float(i % 24) for i in range(24 * 8)]))
    fc = fourier.fourier_forecast(g, 24, seasonalities=(DAILY,),
                                  configure=fourier.add_seasonality("weekly", 7, 3, 0.1), quantiles=(0.5,))
    assert fc.count() == 24 * 2


def test_ar_p_matches_hand_recursion(spark):
    import random
    rnd = random.Random(5)
    m, p = 24, 3
    vals = [float(i % m) for i in range(m)]
    d = [0.0, 0.0, 0.0]
    for i in range(m, m * 12):
        nd = 0.3 + 0.5 * d[-1] - 0.2 * d[-2] + 0.1 * d[-3] + rnd.gauss(0, 0.2)
        d.append(nd)
        vals.append(vals[i - m] + nd)
    g = grid_df(spark, hourly_rows("a", vals))
    beta = autoreg.fit_ar(g, p, m).first().beta
    assert beta[1] == pytest.approx(0.5, abs=0.15) and beta[2] == pytest.approx(-0.2, abs=0.15)
    fc = values(autoreg.ar_p_forecast(g, 50, p, m, quantiles=(0.5,)))
    y = list(vals)
    dd = [y[-k] - y[-k - m] for k in (3, 2, 1)]
    for h in range(50):
        nxt = beta[0] + sum(beta[1 + i] * dd[-1 - i] for i in range(p))
        dd.append(nxt)
        y.append(y[-m] + nxt)
    assert fc == pytest.approx(y[-50:], rel=1e-9, abs=1e-9)


def test_ar_p1_general_equals_closed_form(spark):
    vals = [float((i * 5) % 13) + 0.01 * i for i in range(24 * 6)]
    g = grid_df(spark, hourly_rows("a", vals))
    a = values(autoreg.ar_forecast(g, 30, 24, quantiles=(0.5,)))
    b = values(autoreg.ar_p_forecast(g, 30, 1, 24, quantiles=(0.5,)))
    assert a == pytest.approx(b, rel=1e-6, abs=1e-6)


def test_residual_pool_holds_every_residual_in_time_order(spark):
    vals = [float((i * 7) % 24) + (i // 24) ** 2 for i in range(24 * 5)]
    g = grid_df(spark, hourly_rows("a", vals))
    pool = samples.residual_pool(g, 24).first().pool
    assert pool == [vals[i] - vals[i - 24] for i in range(24, len(vals))]


def test_path_quantiles_equal_those_of_the_exploded_paths(spark):
    from tidecast.operators.metrics import summarise_samples
    g = grid_df(spark, hourly_rows("a", [float(i % 7) + i / 9 for i in range(24 * 4)]))
    point, pool = naive.seasonal_naive(g, 30, 24), samples.residual_pool(g, 24)
    a = summarise_samples(samples.sample_paths(point, pool), ["model", "item_id", "step"], "value", (0.1, 0.5, 0.7, 0.9))
    b = samples.path_quantiles(point, pool, (0.1, 0.5, 0.7, 0.9))
    rows = lambda df: {r.step: [round(r[c], 9) for c in ("q10", "q50", "q70", "q90", "mean", "n")] for r in df.collect()}
    assert rows(a) == rows(b)


def test_ar1_keeps_the_drift_of_a_linear_trend(spark):
    g = grid_df(spark, hourly_rows("a", [2.0 * i for i in range(200)]))
    assert values(autoreg.ar_forecast(g, 30, 24, quantiles=())) == pytest.approx([2.0 * (200 + h) for h in range(30)])


def test_every_model_forecasts_every_step_of_short_series(spark):
    import math
    rows = hourly_rows("short", [1.0, 3.0] * 5) + hourly_rows("one", [4.0]) + hourly_rows("gap", [None] * 3 + [5.0] + [None] * 30) + hourly_rows("long", [float(i % 24) for i in range(240)])
    g = grid_df(spark, rows)
    for fc in (naive.seasonal_naive(g, 24, 24), naive.kernel_resample(g, 24, 168, 24), autoreg.ar_forecast(g, 24, 24), autoreg.ar_p_forecast(g, 24, 2, 24), naive.context_mean(g, 24, 168)):
        got = fc.filter(F.col("quantile").isNull()).collect()
        by = {}
        for r in got:
            by.setdefault(r.item_id, {})[r.step] = r.value
        assert {k: sorted(v) for k, v in by.items()} == {k: list(range(1, 25)) for k in ("short", "one", "gap", "long")}
        assert by["one"][1] == 4.0 and math.isclose(by["short"][1], 2.0)


def test_global_model_beats_mean_forecast_on_seasonal_series(spark):
    import math
    import random
    from tidecast.operators.metrics import point_metrics
    from tidecast.plans.backtest import backtest_all
    rnd = random.Random(9)
    rows = []
    for item, level in (("a", 10.0), ("b", 30.0), ("c", 60.0)):
        vals = [level * (1.0 + 0.5 * math.sin(2 * math.pi * i / 24)) + rnd.gauss(0, 0.5) for i in range(24 * 14)]
        rows += hourly_rows(item, vals)
    g = grid_df(spark, rows)
    bt = backtest_all(g, {
        "global": lambda h, n: global_ar.global_ar_forecast(h, n, quantiles=(0.5,)),
        "mean": lambda h, n: naive.context_mean(h, n, 168),
    }, 24)
    mae = {r.model: r.mae for r in point_metrics(bt.paired(None), ("model",)).collect()}
    assert mae["global"] < 0.5 * mae["mean"]


def test_global_model_uses_dynamic_covariates(spark):
    import random
    from datetime import timedelta
    from conftest import T0
    rnd = random.Random(4)
    n, h = 24 * 12, 24
    feat = [float(rnd.choice([0, 1])) for _ in range(n)]          # a known-ahead on/off driver
    vals = [20.0 + 15.0 * x + rnd.gauss(0, 0.3) for x in feat]
    g = grid_df(spark, hourly_rows("a", vals))
    cov = spark.createDataFrame([("a", T0 + timedelta(hours=i), 0, x) for i, x in enumerate(feat)],
                                "item_id STRING, ts TIMESTAMP_NTZ, feat_index INT, value DOUBLE")
    hist = S.train_part(g, h)
    with_cov = values(global_ar.global_ar_forecast(hist, h, quantiles=(0.5,), covariates=cov, n_covariates=1))
    without = values(global_ar.global_ar_forecast(hist, h, quantiles=(0.5,)))
    err = lambda f: sum(abs(a - b) for a, b in zip(f, vals[-h:])) / h
    assert err(with_cov) < 1.0 < err(without)
