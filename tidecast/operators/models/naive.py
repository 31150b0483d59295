"""Seasonal naive (M1), context mean, and the kernel-weighted resampler (M2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.time import add_steps
from tidecast.operators.models.base import future_steps, last_ts, mean_steps, point_rows
from tidecast.schema import FORECAST_COLUMNS


def seasonal_naive(history: DataFrame, horizon: int, season_length: int = 24,
                   freq: str = "1 hour", quantiles: Sequence[float] = (),
                   model: str | None = None) -> DataFrame:
    """Step ``s`` repeats the value one season earlier: ``y[T − m + ((s−1) mod m) + 1]``.

    Each of the last ``m`` history rows emits the forecast steps of its phase
    (``p+1, p+1+m, …``) itself — no join, no shuffle beyond the history's own.
    A series shorter than ``m`` is forecast by the mean of its history.
    """
    m = season_length
    model = model or f"seasonal_naive_{m}"
    n, step = F.col("n_steps"), F.col("step")
    recent = history.filter((n >= m) & (step >= n - m)).withColumn("p", step - (n - m))
    recent = recent.filter(F.col("p") + 1 <= horizon)
    seasonal = (recent.select("item_id", "target", last_ts(freq).alias("t_end"),
                              F.explode(F.sequence(F.col("p") + 1, F.lit(horizon), F.lit(m))).alias("h"))
                      .select("item_id", F.col("h").alias("step"),
                              add_steps(F.col("t_end"), F.col("h"), freq).alias("ts"),
                              F.col("target").alias("value")))
    mean = mean_steps(history.filter(n < m), horizon, freq)
    return point_rows(seasonal.unionByName(mean), model, quantiles)


def context_mean(history: DataFrame, horizon: int, context_length: int = 168,
                 freq: str = "1 hour", quantiles: Sequence[float] = (),
                 model: str = "mean") -> DataFrame:
    """Every step = mean of the last ``context_length`` history values."""
    ctx = history.filter(F.col("step") >= F.col("n_steps") - context_length)
    means = ctx.groupBy("item_id").agg(F.avg("target").alias("value"))
    fut = future_steps(history, horizon, freq)
    return point_rows(fut.join(means, "item_id").select("item_id", "step", "ts", "value"),
                      model, quantiles)


def kernel_resample(history: DataFrame, horizon: int, context_length: int = 168,
                    season_length: int = 24, decay: float = 0.5, freq: str = "1 hour",
                    quantiles: Sequence[float] = (0.1, 0.5, 0.9),
                    model: str = "resample") -> DataFrame:
    """Non-parametric forecast from the past values of the same phase (M2).

    Candidates for a step are the context values whose position has the same phase
    (``position mod m``); a candidate ``a`` whole seasons old has weight
    ``exp(−decay·a)``.  Quantile ``q`` = smallest candidate whose cumulative weight
    (ordered by value, then time) reaches ``q·total``; the mean row is the weighted
    mean.  A phase without a candidate is forecast by the mean of the history.  Candidate sets hold at most ``ceil(context/m)`` rows, so the window per
    ``(item, phase)`` is small whatever the data size.
    """
    m = season_length
    n, step = F.col("n_steps"), F.col("step")
    cand = (history.filter((step >= n - context_length) & F.col("target").isNotNull())
                   .select("item_id", "ts", "target", "n_steps", last_ts(freq).alias("t_end"),
                           F.pmod(step, F.lit(m)).alias("phase"),
                           F.exp(F.lit(-decay) * F.floor((n - 1 - step) / F.lit(m))).alias("w")))
    part = Window.partitionBy("item_id", "phase")
    run = part.orderBy("target", "ts").rowsBetween(Window.unboundedPreceding, 0)
    cand = cand.select("*", F.sum("w").over(run).alias("cum_w"), F.sum("w").over(part).alias("tot_w"))
    cols = [(F.sum(F.col("w") * F.col("target")) / F.sum("w")).alias("v_mean")]
    for i, q in enumerate(quantiles):
        cols.append(F.min(F.when(F.col("cum_w") >= F.lit(float(q)) * F.col("tot_w"), F.col("target")))
                    .alias(f"v_{i}"))
    per_phase = cand.groupBy("item_id", "phase").agg(
        F.max("n_steps").alias("n_steps"), F.max("t_end").alias("t_end"), *cols)
    # forecast step h sits at position n_steps-1+h, so its phase is (n_steps-1+h) mod m; every
    # phase that a step needs is there, with candidates or without
    ends = (history.groupBy("item_id").agg(F.avg("target").alias("mean"), F.max("n_steps").alias("n_steps"), F.max(last_ts(freq)).alias("t_end"))
                   .withColumn("h0", F.explode(F.sequence(F.lit(1), F.lit(min(m, horizon)))))
                   .withColumn("phase", F.pmod(F.col("n_steps") - 1 + F.col("h0"), F.lit(m))))
    per_phase = (ends.join(per_phase.drop("n_steps", "t_end"), ["item_id", "phase"], "left")
                     .withColumns({c: F.coalesce(c, "mean") for c in ["v_mean", *[f"v_{i}" for i in range(len(quantiles))]]}))
    entries = [F.struct(F.lit(None).cast("double").alias("quantile"), F.col("v_mean").alias("value"))]
    entries += [F.struct(F.lit(float(q)).alias("quantile"), F.col(f"v_{i}").alias("value"))
                for i, q in enumerate(quantiles)]
    return (per_phase.select("item_id", "t_end", F.array(*entries).alias("entries"),
                             F.explode(F.sequence(F.col("h0"), F.lit(horizon), F.lit(m))).alias("step"))
                     .select("item_id", "t_end", "step", F.explode("entries").alias("e"))
                     .select(F.lit(model).alias("model"), "item_id", F.col("step").cast("int").alias("step"),
                             add_steps(F.col("t_end"), F.col("step"), freq).alias("ts"),
                             F.col("e.quantile").alias("quantile"), F.col("e.value").alias("value"))
                     .select(*FORECAST_COLUMNS))
