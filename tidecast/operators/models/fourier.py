"""Additive trend + Fourier seasonality, fitted per series by ridge regression (M3, M7).

The fit is split the Spark way:

1. one ``groupBy(item_id)`` computes the Gram sums ``Σ x_i x_j``, ``Σ x_i y``, ``Σ y²``
   (a partial aggregate, so a long series is summed in many tasks);
2. ``linear.solve`` (``mapInPandas``) solves the ``k×k`` ridge system of every series —
   one small row in, one coefficient array out, batched through numpy, no shuffle;
3. the forecast is a dot product of the coefficient array with the future rows'
   features, all inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.features import DEFAULT_SEASONALITIES, Seasonality, fourier_terms
from tidecast.functions.time import freq_days
from tidecast.operators.models import linear
from tidecast.operators.models.base import future_steps, gaussian_rows

# ridge weight of the intercept and trend (almost unpenalised)
_FREE = 1e-6


def design(ts: Column, step: Column, freq: str,
           seasonalities=DEFAULT_SEASONALITIES) -> list[tuple[str, Column, float]]:
    """``(name, column, ridge penalty)``: constant, trend in days, Fourier terms."""
    cols = [("const", F.lit(1.0), _FREE),
            ("trend", step.cast("double") * F.lit(freq_days(freq)), _FREE)]
    for name, c, prior in fourier_terms(ts, seasonalities):
        cols.append((name, c, 1.0 / (prior * prior)))
    return cols


def gram_pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return linear.pairs(names)


def gram_sums(history: DataFrame, freq: str = "1 hour",
              seasonalities=DEFAULT_SEASONALITIES, exact_target: bool = False) -> DataFrame:
    """One row per series: ``n``, ``abs_sum`` and every Gram entry ``g__<a>__<b>``.

    exact_target: targets are exact to the cent, so ``Σy`` and ``Σy²`` are summed in
    DECIMAL — independent of summation order, hence of partitioning.
    """
    d = design(F.col("ts"), F.col("step"), freq, seasonalities)
    names = [n for n, _, _ in d]
    x = history.filter(F.col("target").isNotNull()).select(
        "item_id", F.col("target").alias("y"), *[c.alias(n) for n, c, _ in d])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.abs("y")).alias("abs_sum")]
    cents = F.col("y").cast("decimal(18,2)")
    for a, b in gram_pairs(names):
        if exact_target and (a, b) == ("const", "y"):
            g = F.sum(cents).cast("double")
        elif exact_target and (a, b) == ("y", "y"):
            g = F.sum(cents * cents).cast("double")
        else:
            g = F.sum(F.col(a) * F.col(b))
        aggs.append(g.alias(f"g__{a}__{b}"))
    return x.groupBy("item_id").agg(*aggs)


def gram_long(gram: DataFrame, names: Sequence[str]) -> DataFrame:
    """Gram sums as ``(item_id, term_pair, value)`` rows."""
    entries = [F.struct(F.lit(f"{a}__{b}").alias("term_pair"), F.col(f"g__{a}__{b}").alias("value"))
               for a, b in gram_pairs(names)]
    return (gram.select("item_id", F.explode(F.array(*entries)).alias("e"))
                .select("item_id", "e.term_pair", "e.value"))


def fit_fourier(history: DataFrame, freq: str = "1 hour",
                seasonalities=DEFAULT_SEASONALITIES) -> DataFrame:
    """Per-series coefficients ``(item_id, beta ARRAY<DOUBLE>, sigma)``; each series is
    solved on ``y / mean|y|`` so the ridge penalties mean the same for every series."""
    d = design(F.col("ts"), F.col("step"), freq, seasonalities)
    names = [n for n, _, _ in d]
    penalties = [p for _, _, p in d]
    g = gram_sums(history, freq, seasonalities)
    g = g.withColumn("scale", F.col("abs_sum") / F.col("n"))
    return linear.solve(g, "item_id", names, penalties, scale="scale", dof_correction=False)


def configured(seasonalities=DEFAULT_SEASONALITIES,
               configure: Callable[[list[Seasonality]], list[Seasonality]] | None = None) -> tuple:
    """M7: let a user callback edit the seasonality list before the fit (add, replace or
    drop terms); a term with an existing name replaces it."""
    items = list(seasonalities)
    if configure is not None:
        items = list(configure(items))
    merged: dict[str, Seasonality] = {}
    for s in items:
        merged[s.name] = s
    return tuple(merged.values())


def add_seasonality(name: str, period: float, fourier_order: int, prior_scale: float = 10.0):
    """A ready-made M7 callback: ``configure=add_seasonality('weekly', 7, 3, 0.1)``."""
    def configure(items: list[Seasonality]) -> list[Seasonality]:
        return items + [Seasonality(name, period, fourier_order, prior_scale)]
    return configure


def fourier_forecast(history: DataFrame, horizon: int, freq: str = "1 hour",
                     seasonalities=DEFAULT_SEASONALITIES,
                     quantiles: Sequence[float] = (0.1, 0.5, 0.9),
                     model: str = "fourier",
                     configure: Callable[[list[Seasonality]], list[Seasonality]] | None = None) -> DataFrame:
    """Trend + seasonality forecast with Gaussian quantiles from the fit's residual scale."""
    seasonalities = configured(seasonalities, configure)
    coef = fit_fourier(history, freq, seasonalities)
    fut = future_steps(history, horizon, freq)
    abs_step = F.col("n_steps") - 1 + F.col("step")
    feats = F.array(*[c for _, c, _ in design(F.col("ts"), abs_step, freq, seasonalities)])
    j = fut.join(coef, "item_id")
    value = F.aggregate(F.zip_with("beta", feats, lambda b, x: b * x), F.lit(0.0), lambda acc, v: acc + v)
    return gaussian_rows(j.select("item_id", "step", "ts", value.alias("value"), "sigma"), model, quantiles)
