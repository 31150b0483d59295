"""Autoregression on seasonally differenced, optionally truncated history (M4).

``d_t = y_t − y_{t−m}``, fitted as ``d_t = c + φ·d_{t−1}`` by least squares
(``regr_slope``/``regr_intercept``, a partial aggregate per series).  The forecast
needs no recursion: ``d̂(h) = c·(1−φ^h)/(1−φ) + φ^h·d_T`` in closed form, and
``ŷ(T+h) = y(T+h−(J+1)m) + Σ_{j=0..J} d̂(h−j·m)`` — the seasonal-naive base plus the
summed differences, evaluated with ``aggregate`` over a short ``sequence`` in the JVM.

AR(p) for p > 1 (``fit_ar``/``ar_p_forecast``) fits from per-series Gram sums and rolls
the differences forward with ``aggregate`` over ``1..H`` carrying the last ``p`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.time import add_steps
from tidecast.operators.models.base import gaussian_rows, last_ts, mean_steps


def differenced(history: DataFrame, season_length: int = 24,
                trunc_length: int | None = None) -> DataFrame:
    """``(item_id, step, n_steps, d_t, d_prev)`` over the (truncated) history of each series."""
    h = history
    if trunc_length:
        h = h.filter(F.col("step") >= F.col("n_steps") - trunc_length)
    m = season_length
    w = Window.partitionBy("item_id").orderBy("step")
    y = F.col("target")
    return h.select("item_id", "step", "n_steps",
                    (y - F.lag(y, m).over(w)).alias("d_t"),
                    (F.lag(y, 1).over(w) - F.lag(y, m + 1).over(w)).alias("d_prev"))


def fit_ar1(history: DataFrame, season_length: int = 24,
            trunc_length: int | None = None) -> DataFrame:
    """Per series: ``phi``, ``intercept``, residual ``sigma``, pair count ``n``, mean difference
    ``d_mean`` and last difference ``d_last``."""
    d = differenced(history, season_length, trunc_length)
    sse = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    return (d.groupBy("item_id")
             .agg(F.regr_slope("d_t", "d_prev").alias("phi"),
                  F.regr_intercept("d_t", "d_prev").alias("intercept"),
                  F.regr_count("d_t", "d_prev").alias("n"),
                  F.regr_sxx("d_t", "d_prev").alias("sxx"),
                  F.regr_syy("d_t", "d_prev").alias("syy"),
                  F.regr_sxy("d_t", "d_prev").alias("sxy"),
                  F.avg("d_t").alias("d_mean"),
                  F.max(F.when(F.col("step") == F.col("n_steps") - 1, F.col("d_t"))).alias("d_last"))
             .select("item_id", "phi", "intercept", "n", "d_mean", "d_last",
                     F.when((F.col("n") > 2) & (F.col("sxx") > 0),
                            F.sqrt(F.greatest(sse, F.lit(0.0)) / (F.col("n") - 2)))
                      .alias("sigma")))


def _dhat(k: Column, c: Column, phi: Column, d_last: Column) -> Column:
    pk = F.pow(phi, k.cast("double"))
    geometric = F.when(F.abs(phi - 1.0) < 1e-12, c * k).otherwise(c * (1.0 - pk) / (1.0 - phi))
    return geometric + pk * d_last


def ar_forecast(history: DataFrame, horizon: int, season_length: int = 24,
                trunc_length: int | None = None, freq: str = "1 hour",
                quantiles: Sequence[float] = (0.1, 0.5, 0.9), model: str = "seasonal_ar1") -> DataFrame:
    """Seasonal AR(1).  Where the lagged differences do not vary there is no slope: the drift
    is then the mean difference.  A series shorter than a season is forecast by its mean."""
    m = season_length
    fit = fit_ar1(history, m, trunc_length)
    n, step = F.col("n_steps"), F.col("step")
    base = (history.filter((n >= m) & (step >= n - m))
                   .withColumn("p", step - (n - m)).filter(F.col("p") + 1 <= horizon)
                   .select("item_id", "p", F.col("target").alias("y_base"), last_ts(freq).alias("t_end")))
    j = (base.join(fit.drop("n"), "item_id")
             .select("item_id", "y_base", "t_end", "p",
                     F.coalesce("phi", F.lit(0.0)).alias("phi"),
                     F.coalesce("intercept", "d_mean", F.lit(0.0)).alias("c"),
                     F.coalesce("d_last", F.lit(0.0)).alias("d_last"), "sigma",
                     F.explode(F.sequence(F.col("p") + 1, F.lit(horizon), F.lit(m))).alias("h")))
    n_terms = F.floor((F.col("h") - F.col("p") - 1) / F.lit(m)).cast("int")
    summed = F.aggregate(F.sequence(F.lit(0), n_terms), F.lit(0.0),
                         lambda acc, jj: acc + _dhat(F.col("h") - jj * F.lit(m), F.col("c"),
                                                     F.col("phi"), F.col("d_last")))
    out = j.select("item_id", F.col("h").alias("step"),
                   add_steps(F.col("t_end"), F.col("h"), freq).alias("ts"),
                   (F.col("y_base") + summed).alias("value"),
                   (F.col("sigma") * F.sqrt((n_terms + 1).cast("double"))).alias("sigma"))
    short = mean_steps(history.filter(n < m), horizon, freq).withColumn("sigma", F.lit(None).cast("double"))
    return gaussian_rows(out.unionByName(short), model, quantiles)


# ----------------------------------------------------------------------------- AR(p)

def lagged_differences(history: DataFrame, p: int, season_length: int = 24,
                       trunc_length: int | None = None) -> DataFrame:
    """``(item_id, step, n_steps, d, d_lag1 … d_lagp)`` on the (truncated) history."""
    h = history
    if trunc_length:
        h = h.filter(F.col("step") >= F.col("n_steps") - trunc_length)
    w = Window.partitionBy("item_id").orderBy("step")
    d = h.select("item_id", "step", "n_steps",
                 (F.col("target") - F.lag("target", season_length).over(w)).alias("d"))
    return d.select("*", *[F.lag("d", i).over(w).alias(f"d_lag{i}") for i in range(1, p + 1)])


def fit_ar(history: DataFrame, p: int = 2, season_length: int = 24,
           trunc_length: int | None = None, ridge: float = 1e-8) -> DataFrame:
    """Per series ``beta = [c, φ1 … φp]`` (φ1 on the latest difference) and ``sigma``."""
    from tidecast.operators.models import linear
    d = lagged_differences(history, p, season_length, trunc_length)
    names = ["const"] + [f"d_lag{i}" for i in range(1, p + 1)]
    rows = d.withColumn("const", F.lit(1.0)).dropna(subset=["d"] + names[1:])
    g = linear.gram_sums(rows, "item_id", names, "d")
    return linear.solve(g, "item_id", names, [ridge] * len(names))


def ar_p_forecast(history: DataFrame, horizon: int, p: int = 2, season_length: int = 24,
                  trunc_length: int | None = None, freq: str = "1 hour",
                  quantiles: Sequence[float] = (0.1, 0.5, 0.9), model: str | None = None) -> DataFrame:
    """Seasonal AR(p): the differences roll forward by ``aggregate`` over ``1..H`` with the
    last ``p`` values as state (all in the JVM), then integrate seasonally as AR(1) does."""
    m = season_length
    model = model or f"seasonal_ar{p}"
    fit = fit_ar(history, p, m, trunc_length)
    d = lagged_differences(history, p, m, trunc_length)
    per = fit.join(last_differences(d, p), "item_id").filter(F.col("beta").isNotNull())
    phis = F.slice(F.col("beta"), 2, p)
    c = F.col("beta")[0]
    init = F.struct(F.col("w0").alias("w"), F.array().cast("array<double>").alias("out"))

    def step(acc, _h):
        nxt = c + F.aggregate(F.zip_with(phis, F.reverse(acc["w"]), lambda a, b: a * b),
                              F.lit(0.0), lambda x, y: x + y)
        window = F.concat(F.slice(acc["w"], 2, p - 1), F.array(nxt)) if p > 1 else F.array(nxt)
        return F.struct(window.alias("w"), F.concat(acc["out"], F.array(nxt)).alias("out"))

    dh = per.select("item_id", "sigma",
                    F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step,
                                lambda acc: acc["out"]).alias("dhat"))
    return integrated(history, dh, horizon, m, freq, quantiles, model)


def integrated(history: DataFrame, dh: DataFrame, horizon: int, season_length: int, freq: str,
               quantiles: Sequence[float], model: str) -> DataFrame:
    """FORECAST rows from forecast differences ``dh`` (``item_id, sigma, dhat ARRAY`` of H): the
    seasonal-naive base plus the differences of the seasons passed.  A series that ``dh``
    lacks (too short, or gaps at its end) is forecast by its mean."""
    m = season_length
    n, stp = F.col("n_steps"), F.col("step")
    base = (history.filter((n >= m) & (stp >= n - m))
                   .withColumn("p", stp - (n - m)).filter(F.col("p") + 1 <= horizon)
                   .select("item_id", "p", F.col("target").alias("y_base"), last_ts(freq).alias("t_end")))
    j = (base.join(dh, "item_id")
             .select("item_id", "y_base", "t_end", "p", "sigma", "dhat",
                     F.explode(F.sequence(F.col("p") + 1, F.lit(horizon), F.lit(m))).alias("h")))
    n_terms = F.floor((F.col("h") - F.col("p") - 1) / F.lit(m)).cast("int")
    summed = F.aggregate(F.sequence(F.lit(0), n_terms), F.lit(0.0),
                         lambda acc, jj: acc + F.element_at(F.col("dhat"), (F.col("h") - jj * F.lit(m)).cast("int")))
    out = j.select("item_id", F.col("h").alias("step"), add_steps(F.col("t_end"), F.col("h"), freq).alias("ts"),
                   (F.col("y_base") + summed).alias("value"),
                   (F.col("sigma") * F.sqrt((n_terms + 1).cast("double"))).alias("sigma"))
    other = mean_steps(history.join(dh.select("item_id"), "item_id", "left_anti"), horizon, freq)
    return gaussian_rows(out.unionByName(other.withColumn("sigma", F.lit(None).cast("double"))), model, quantiles)


def last_differences(d: DataFrame, p: int) -> DataFrame:
    """``(item_id, w0 ARRAY)``: the last ``p`` differences in time order, of series that have them all."""
    last = (d.filter((F.col("step") >= F.col("n_steps") - p) & F.col("d").isNotNull())
             .groupBy("item_id")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "d"))), lambda x: x["d"]).alias("w0")))
    return last.filter(F.size("w0") == p)
