"""A trend + Fourier fit from mergeable moments: no reading is looked at twice.

The normal equations of a linear fit on a regular grid need ``Σ x x'``, which the grid's span alone
gives, and ``Σ x y``, which is linear in the readings: every contribution (a file, a batch) has its own
moments per series, and the moments of any set of contributions are their sum.  A contribution is
retracted by leaving it out.  The trend is kept in days since 1970 and moved to the series' start by
``Σ (t − t0) y = Σ t y − t0 Σ y``.  Only the residual scale needs merged cells (``Σ y²``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.features import Seasonality, epoch_days
from tidecast.functions.time import add_steps, steps_between
from tidecast.operators.models import fourier, linear
from tidecast.operators.models.base import gaussian_rows

#: Daily and weekly terms of the refreshed fit (fewer than the full model: it is refitted often).
SEASONALITIES = (Seasonality("daily", 1.0, 2, 10.0), Seasonality("weekly", 7.0, 1, 0.1))


def _design(ts: Column, step: Column, freq: str, seasonalities) -> list[tuple[str, Column, float]]:
    return fourier.design(ts, step, freq, seasonalities)


def contributions(cells: DataFrame, by: Sequence[str] = (), seasonalities=SEASONALITIES) -> DataFrame:
    """Moments of ``cells`` (``by.., item_id, ts, total``) per contribution and series: ``lo, hi`` and
    ``m__<term>`` (the trend in days since 1970)."""
    y = F.col("total").cast("double")
    columns = {name: c for name, c, _ in _design(F.col("ts"), F.lit(0), "1 day", seasonalities)} | {"trend": epoch_days("ts")}
    return cells.groupBy(*by, "item_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"),
                                             *[F.sum(c * y).alias(f"m__{name}") for name, c in columns.items()])


def merge(moments: DataFrame) -> DataFrame:
    """One row per series from the rows of its contributions."""
    sums = [c for c in moments.columns if c.startswith("m__")]
    return moments.groupBy("item_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in sums])


def fit(merged: DataFrame, cells: DataFrame, freq: str = "1 hour", seasonalities=SEASONALITIES) -> DataFrame:
    """``item_id, lo, n_steps, beta, sigma`` of the ridge fit on each series' grid from its first to its
    last cell, empty cells 0; ``cells`` (``item_id, ts, target``) are the merged cells."""
    d = _design(F.col("ts"), F.col("step"), freq, seasonalities)
    names, penalties = [n for n, _, _ in d], [p for _, _, p in d]
    spans = merged.withColumn("n_steps", steps_between("lo", "hi", freq) + 1)
    # series of one span share its sums
    steps = spans.select("lo", "n_steps").distinct().withColumn("step", F.explode(F.sequence(F.lit(0), F.col("n_steps") - 1)))
    x = steps.select("lo", "n_steps", *[c.alias(n) for n, c, _ in _design(add_steps("lo", "step", freq), F.col("step"), freq, seasonalities)])
    xx = x.groupBy("lo", "n_steps").agg(*[F.sum(F.col(a) * F.col(b)).alias(f"g__{a}__{b}") for a, b in linear.pairs(names) if b != "y"])
    yy = cells.groupBy("item_id").agg(F.sum(F.col("target") * F.col("target")).alias("g__y__y"), F.sum(F.abs("target")).alias("abs_sum"))
    start = epoch_days("lo")
    xy = {f"g__{n}__y": F.col("m__trend") - start * F.col("m__const") if n == "trend" else F.col(f"m__{n}") for n in names}
    gram = spans.join(yy, "item_id").join(xx, ["lo", "n_steps"]).withColumns(xy)
    gram = gram.withColumns({"n": F.col("n_steps").cast("long"), "scale": F.col("abs_sum") / F.col("n_steps")})
    solved = linear.solve(gram, "item_id", names, penalties, scale="scale", dof_correction=False)
    return spans.select("item_id", "lo", "n_steps").join(solved, "item_id")


def forecast(fitted: DataFrame, horizon: int, freq: str = "1 hour", quantiles: Sequence[float] = (0.1, 0.5, 0.9),
             model: str = "refresh", seasonalities=SEASONALITIES) -> DataFrame:
    """FORECAST rows past each series' last cell."""
    rows = fitted.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("at", F.col("n_steps") - 1 + F.col("h"))
    rows = rows.select("item_id", F.col("h").alias("step"), add_steps("lo", "at", freq).alias("ts"), "at", "beta", "sigma")
    x = F.array(*[c for _, c, _ in _design(F.col("ts"), F.col("at"), freq, seasonalities)])
    return gaussian_rows(rows.select("item_id", "step", "ts", linear.dot(F.col("beta"), x).alias("value"), "sigma"), model, quantiles)


