"""The per-series solver, orders with moving-average terms, and ancestral paths."""

import numpy as np
from pyspark.sql import functions as F

from conftest import grid_df, hourly_rows
from tidecast.operators.models import arma, autoreg, linear, samples


def test_solved_equals_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        k = 1 + i % 16
        a = rng.normal(size=(k + 4, k))
        g, b = a.T @ a, rng.normal(size=k)
        rows.append((i, g.tolist(), b.tolist()))
    df = spark.createDataFrame(rows, "i int, g array<array<double>>, b array<double>")
    for r in df.select("*", linear.solved(F.col("g"), F.col("b")).alias("x")).collect():
        assert np.allclose(r["x"], np.linalg.solve(np.array(r["g"]), np.array(r["b"])), rtol=1e-8)


def test_ridge_fit_equals_numpy(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for item in ("a", "b"):
        x = rng.normal(size=(60, 2))
        y = 5 + x @ [2.0, -1.0] + rng.normal(size=60)
        rows += [(item, 1.0, float(u), float(v), float(t)) for (u, v), t in zip(x, y)]
        d = np.column_stack([np.ones(60), x])
        beta = np.linalg.solve(d.T @ d + np.diag([0.0, 0.5, 2.0]), d.T @ y)
        want[item] = beta, np.sqrt(((y - d @ beta) ** 2).sum() / 57)
    df = spark.createDataFrame(rows, "item_id string, const double, u double, v double, y double")
    names = ["const", "u", "v"]
    for r in linear.solve(linear.gram_sums(df, "item_id", names), "item_id", names, [0.0, 0.5, 2.0]).collect():
        assert np.allclose(r["beta"], want[r["item_id"]][0]) and abs(r["sigma"] - want[r["item_id"]][1]) < 1e-9


def test_a_singular_system_does_not_fail(spark):
    df = spark.createDataFrame([([[1.0, 1.0], [1.0, 1.0]], [1.0, 1.0])], "g array<array<double>>, b array<double>")
    assert len(df.select(linear.solved(F.col("g"), F.col("b")).alias("x")).first()["x"]) == 2


def simulated(rng, n, phi, theta, season=4, scale=1.0):
    e = rng.normal(size=n) * scale
    d = np.zeros(n)
    for t in range(1, n):
        d[t] = 0.1 + sum(p * d[t - 1 - i] for i, p in enumerate(phi) if t > i) + e[t] + sum(q * e[t - 1 - i] for i, q in enumerate(theta) if t > i)
    y = rng.normal(size=season).tolist()
    for v in d:
        y.append(y[-season] + v)
    return y


def test_orders_and_coefficients_are_recovered(spark):
    rng = np.random.default_rng(5)
    rows = hourly_rows("arma11", simulated(rng, 4000, [0.7], [0.5])) + hourly_rows("ar1", simulated(rng, 4000, [0.6], []))
    rows += hourly_rows("ma1", simulated(rng, 4000, [], [0.6])) + hourly_rows("white", simulated(rng, 4000, [], []))
    fit = {r["item_id"]: r for r in arma.fit_arma(arma.innovation_rows(grid_df(spark, rows), season_length=4)).collect()}
    order = {k: (r["p"], r["q"]) for k, r in fit.items()}
    assert order == {"arma11": (1, 1), "ar1": (1, 0), "ma1": (0, 1), "white": (0, 0)}
    assert abs(fit["arma11"]["beta"][1] - 0.7) < 0.06 and abs(fit["arma11"]["beta"][3] - 0.5) < 0.08
    assert abs(fit["arma11"]["sigma"] - 1.0) < 0.05 and fit["ar1"]["beta"][3] == 0.0


def test_short_series_fall_back_to_their_mean(spark):
    rows = hourly_rows("long", simulated(np.random.default_rng(6), 300, [0.5], [0.4])) + hourly_rows("short", [1, 2, 3])
    grid = grid_df(spark, rows)
    fc = arma.arma_forecast(grid, 8, 4, quantiles=(0.5,)).collect()
    assert len(fc) == 2 * 8 * 2 and {r["value"] for r in fc if r["item_id"] == "short"} == {2.0}
    paths = samples.ancestral_paths(grid, 8, 2, 4, num_samples=5).collect()
    assert len(paths) == 2 * 8 * 5 and {r["value"] for r in paths if r["item_id"] == "short"} == {2.0}


def test_arma_forecast_equals_the_recursion(spark):
    grid = grid_df(spark, hourly_rows("x", simulated(np.random.default_rng(7), 400, [0.5], [0.6])))
    rows = arma.innovation_rows(grid, season_length=4)
    fit = arma.fit_arma(rows).first()
    y = [r["target"] for r in grid.orderBy("step").collect()]
    tail = rows.orderBy("step").collect()[-2:]
    w, e, out = [tail[1]["d"], tail[0]["d"]], [tail[1]["e"], tail[0]["e"]], []
    for _ in range(10):
        b = fit["beta"]
        d = b[0] + b[1] * w[0] + b[2] * w[1] + b[3] * e[0] + b[4] * e[1]
        y.append(y[-4] + d)
        out.append(y[-1])
        w, e = [d, w[0]], [0.0, e[0]]
    got = [r["value"] for r in arma.arma_forecast(grid, 10, 4, quantiles=()).orderBy("step").collect()]
    assert np.allclose(got, out)


def test_ancestral_paths_depend_on_their_own_past(spark):
    """The draws of a path accumulate; independent draws around the point forecast do not."""
    grid = grid_df(spark, hourly_rows("x", simulated(np.random.default_rng(8), 600, [0.9], [])))
    paths = samples.ancestral_paths(grid, 12, 2, 4, num_samples=200)
    wide = np.array([[v for _, v in sorted((r["step"], r["value"]) for r in rows)] for rows in
                     [g["rows"] for g in paths.groupBy("sample_id").agg(F.collect_list(F.struct("step", "value")).alias("rows")).collect()]])
    assert np.corrcoef(wide[:, 0], wide[:, 1])[0, 1] > 0.5 and wide[:, 11].std() > 1.5 * wide[:, 0].std()
    again = samples.ancestral_paths(grid.repartition(7, "step"), 12, 2, 4, num_samples=200)
    assert paths.exceptAll(again).count() == 0
    d = autoreg.lagged_differences(grid, 2, 4)
    pool = samples.innovations(d, autoreg.fit_ar(grid, 2, 4), 2).first()["pool"]
    assert len(pool) == 604 - 4 - 2 and abs(np.mean(pool)) < 1e-6
