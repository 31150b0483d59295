"""M5's quantiles: the check loss reaches its minimum, beats one residual quantile, never crosses."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID, grid_df, hourly_rows
from tidecast.operators import metrics as M
from tidecast.operators import series as S
from tidecast.operators.models import pinball
from tidecast.operators.models.global_ar import GlobalARModel, GlobalARParams
from tidecast.plans import datasets as D


def loss(y, f, q):
    return np.where(y < f, (q - 1) * (y - f), q * (y - f)).mean()


def test_fit_reaches_the_optimum(spark):
    """The optimum of a quantile regression passes through k points: every pair of points is tried."""
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 3, 60)
    y = 1 + x + rng.normal(size=60) * (0.3 + x)
    df = spark.createDataFrame([(1.0, float(a), float(b)) for a, b in zip(x, y)], "const double, x double, y double").persist()
    qs = (0.1, 0.5, 0.9)
    fit = pinball.fit(df, ["const", "x"], "y", qs, [[0.0, 0.0]] * 3, max_rounds=200, tolerance=1e-7)
    for q, beta, got in zip(qs, fit.betas, fit.losses):
        best = min(loss(y, a + b * x, q) for i, j in itertools.combinations(range(60), 2) for b in [(y[j] - y[i]) / (x[j] - x[i])] for a in [y[i] - b * x[i]])
        assert abs(got - loss(y, beta[0] + beta[1] * x, q)) < 1e-9 and best <= got + 1e-9 < best * 1.01 + 1e-9


def test_result_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(1.0, float(a), float(a + rng.normal())) for a in rng.normal(size=300)]
    fits = [pinball.fit(spark.createDataFrame(rows, "const double, x double, y double").repartition(n), ["const", "x"], "y", (0.3,), [[0.0, 0.0]]) for n in (1, 9)]
    assert np.allclose(fits[0].betas, fits[1].betas, atol=1e-6)


def _scored(grid, method, spark):
    hist, hold = S.train_part(grid, 72), S.holdout_part(grid, 72)
    cats = S.static_categories(hist, "item_id")
    model = GlobalARModel.fit(hist, GlobalARParams(quantiles=(0.1, 0.5, 0.9), quantile_method=method), cats)
    fc = model.forecast(hist, cats).persist()
    wql = M.weighted_quantile_loss(M.quantile_metrics(fc, hold, (0.1, 0.5, 0.9))).agg(F.avg("wql")).first()[0]
    return model, fc, wql


def _uneven(spark):
    """Series whose noise differs by series and by hour of day."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(6):
        hour = np.arange(24 * 40) % 24
        y = 50 + 20 * np.sin(hour / 24 * 2 * np.pi) + rng.normal(size=len(hour)) * (1 + 4 * k) * (0.3 + np.abs(np.cos(hour / 24 * 2 * np.pi)))
        rows += hourly_rows(f"s{k}", y)
    return grid_df(spark, rows).persist()


def test_fitted_quantiles_beat_one_residual_quantile_and_never_cross(spark, tmp_path):
    grid = _uneven(spark)
    _, _, before = _scored(grid, "residual", spark)
    model, fc, after = _scored(grid, "check_loss", spark)
    assert after < 0.95 * before
    wide = fc.filter("quantile is not null").groupBy("item_id", "step").agg(F.transform(F.sort_array(F.collect_list(F.struct("quantile", "value"))), lambda x: x["value"]).alias("v"))
    assert wide.filter("v[0] > v[1] or v[1] > v[2]").count() == 0
    widths = {r["item_id"]: r["w"] for r in wide.groupBy("item_id").agg(F.avg(F.col("v")[2] - F.col("v")[0]).alias("w")).collect()}
    assert widths["s5"] > 4 * widths["s0"]      # not one band for all
    model.save(spark, str(tmp_path / "m"))
    assert GlobalARModel.load(spark, str(tmp_path / "m")).quantile_fit == model.quantile_fit


def test_nothing_is_lost_where_there_is_nothing_to_find(spark):
    """The event values are drawn alike for every type and hour: one residual quantile fits them."""
    grid = D.events_hourly(spark, SF_MID).persist()
    before, after = (_scored(grid, m, spark)[2] for m in ("residual", "check_loss"))
    assert after < 1.005 * before


def test_no_rows_keep_the_start(spark):
    df = spark.createDataFrame([], "const double, y double")
    assert pinball.fit(df, ["const"], "y", (0.5,), [[2.0]]).betas == [[2.0]]
