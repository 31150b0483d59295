"""Shared pieces of the forecast operators.

Every forecaster maps a *history grid* (``item_id, ts, step, n_steps, target``) to
FORECAST rows ``model, item_id, step (1..H), ts, quantile (NULL = mean), value``.
Point models repeat their value for each requested quantile (a one-sample
distribution), so every model can be scored at any quantile.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.time import add_steps
from tidecast.schema import FORECAST_COLUMNS


def quantile_array(quantiles: Sequence[float]) -> Column:
    """``[NULL, q1, q2, …]`` — NULL stands for the mean row."""
    return F.array(F.lit(None).cast("double"), *[F.lit(float(q)) for q in quantiles])


def last_ts(freq: str) -> Column:
    """Time of the last history point, computed from any row of the series."""
    return add_steps(F.col("ts"), F.col("n_steps") - 1 - F.col("step"), freq)


def point_rows(df: DataFrame, model: str, quantiles: Sequence[float]) -> DataFrame:
    """``(item_id, step, ts, value)`` → FORECAST rows, one per quantile plus the mean."""
    return (df.select("item_id", "step", "ts", "value",
                      F.explode(quantile_array(quantiles)).alias("quantile"))
              .select(F.lit(model).alias("model"), "item_id",
                      F.col("step").cast("int").alias("step"), "ts",
                      F.col("quantile"), F.col("value").cast("double").alias("value"))
              .select(*FORECAST_COLUMNS))


def gaussian_rows(df: DataFrame, model: str, quantiles: Sequence[float]) -> DataFrame:
    """``(item_id, step, ts, value, sigma)`` → mean row + ``value + z_q·sigma`` rows.

    ``z_q`` comes from the standard normal inverse CDF, evaluated once per quantile on
    the driver and planned as a literal.
    """
    entries = [F.struct(F.lit(None).cast("double").alias("q"), F.lit(0.0).alias("z"))]
    for q in quantiles:
        entries.append(F.struct(F.lit(float(q)).alias("q"), F.lit(NormalDist().inv_cdf(q)).alias("z")))
    return (df.select("item_id", "step", "ts", "value", "sigma", F.explode(F.array(*entries)).alias("e"))
              .select(F.lit(model).alias("model"), "item_id", F.col("step").cast("int").alias("step"), "ts",
                      F.col("e.q").alias("quantile"),
                      (F.col("value") + F.col("e.z") * F.coalesce(F.col("sigma"), F.lit(0.0)))
                      .cast("double").alias("value"))
              .select(*FORECAST_COLUMNS))


def future_steps(history: DataFrame, horizon: int, freq: str) -> DataFrame:
    """``(item_id, step 1..H, ts, n_steps)`` for every series, from its last history row."""
    last = history.filter(F.col("step") == F.col("n_steps") - 1)
    return (last.select("item_id", "n_steps", "ts",
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
                .select("item_id", F.col("h").alias("step"), "n_steps",
                        add_steps(F.col("ts"), F.col("h"), freq).alias("ts")))


def mean_steps(history: DataFrame, horizon: int, freq: str) -> DataFrame:
    """``(item_id, step 1..H, ts, value)`` with the mean of each history for every step."""
    return (history.groupBy("item_id").agg(F.avg("target").alias("value"), F.max(last_ts(freq)).alias("t_end"))
                   .select("item_id", "value", "t_end", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
                   .select("item_id", F.col("h").alias("step"), add_steps(F.col("t_end"), F.col("h"), freq).alias("ts"), "value"))
