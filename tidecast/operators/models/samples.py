"""Sample paths (M6): residuals drawn by hash, not by a random stream, added to a point forecast
(``sample_paths``) or fed back through an autoregression (``ancestral_paths``), where each step of
a path starts from what the path drew before, so that its steps depend on one another.

Sample ``s`` of step ``h`` takes residual number ``hash(item_id, h, s, seed) mod n`` of the
series' ``n`` in-sample seasonal differences, in time order.  The draw depends only on the
row's own keys, so the samples are identical however the data is partitioned or re-run after
an executor loss; the hash (the first 32 bits of MD5) is one that other engines have too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.time import add_steps
from tidecast.operators.models import autoreg
from tidecast.schema import SAMPLES


def residual_pool(history: DataFrame, season_length: int = 24) -> DataFrame:
    """``(item_id, pool ARRAY<DOUBLE>)``: all seasonal differences of each series in time order;
    the array is bounded by the series' grid length."""
    w = Window.partitionBy("item_id").orderBy("step")
    r = (history.select("item_id", "step", (F.col("target") - F.lag("target", season_length).over(w)).alias("r"))
                .filter(F.col("r").isNotNull()))
    return r.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "r"))), lambda x: x["r"]).alias("pool"))


def _draw(sample_id: Column, seed: int) -> Column:
    """The residual that a sample takes: 0 for a series without any."""
    name = F.concat_ws("|", F.col("item_id"), F.col("step").cast("string"), sample_id.cast("string"), F.lit(str(seed)))
    number = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")
    n = F.coalesce(F.size("pool"), F.lit(0))
    return F.when(n > 0, F.element_at("pool", (F.pmod(number, F.greatest(n, F.lit(1))) + 1).cast("int"))).otherwise(F.lit(0.0))


def _steps(point: DataFrame, pool: DataFrame, model: str | None) -> DataFrame:
    base = point.filter(F.col("quantile").isNull())
    name = F.lit(model) if model else F.col("model")
    return base.join(pool, "item_id", "left").withColumn("model", name).withColumn("step", F.col("step").cast("int"))


def sample_paths(point: DataFrame, pool: DataFrame, num_samples: int = 100, seed: int = 42,
                 model: str | None = None) -> DataFrame:
    """SAMPLES rows from point forecast rows (``quantile IS NULL``) and a residual pool."""
    numbers = F.sequence(F.lit(0), F.lit(num_samples - 1))
    drawn = F.transform(numbers, lambda s: F.struct(s.alias("sample_id"), (F.col("value") + _draw(s, seed)).alias("value")))
    out = _steps(point, pool, model).select("model", "item_id", "step", "ts", F.explode(drawn).alias("d"))
    return out.select("model", "item_id", "step", "ts", F.col("d.sample_id").cast("int").alias("sample_id"),
                      F.col("d.value").alias("value")).select(*[f.name for f in SAMPLES.fields])


def path_quantiles(point: DataFrame, pool: DataFrame, quantiles: Sequence[float], num_samples: int = 100, seed: int = 42,
                   model: str | None = None) -> DataFrame:
    """Nearest-rank quantiles, mean and count of the same samples per forecast step, from one
    sorted array per step: nothing is exploded or shuffled after the pool's join."""
    numbers = F.sequence(F.lit(0), F.lit(num_samples - 1))
    values = F.array_sort(F.transform(numbers, lambda s: F.col("value") + _draw(s, seed)))
    rows = _steps(point, pool, model).select("model", "item_id", "step", values.alias("v"))
    # rank round-half-even((n - 1) q), as in summarise_samples
    cols = [F.element_at("v", int(round((num_samples - 1) * q)) + 1).alias(f"q{int(q * 100):02d}") for q in quantiles]
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / num_samples
    return rows.select("model", "item_id", "step", *cols, mean.alias("mean"), F.lit(num_samples).cast("long").alias("n"))


# ---------------------------------------------------------------- ancestral paths

def innovations(d: DataFrame, fit: DataFrame, p: int) -> DataFrame:
    """``(item_id, pool ARRAY<DOUBLE>)``: what the AR(p) of each series left unexplained of its
    differences ``d``, in time order."""
    expected = F.col("beta")[0]
    for i in range(1, p + 1):
        expected = expected + F.col("beta")[i] * F.col(f"d_lag{i}")
    r = d.join(fit.select("item_id", "beta"), "item_id").select("item_id", "step", (F.col("d") - expected).alias("r")).filter(F.col("r").isNotNull())
    return r.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "r"))), lambda x: x["r"]).alias("pool"))


def ancestral_states(history: DataFrame, p: int = 2, season_length: int = 24) -> DataFrame:
    """What a series' paths start from: ``item_id, t_end, beta, w0`` (last p differences), ``season``
    (last season's values), ``pool`` and ``mean``; the fitted parts are null where there is no fit."""
    d = autoreg.lagged_differences(history, p, season_length)
    fit = autoreg.fit_ar(history, p, season_length).filter(F.col("beta").isNotNull())
    per = fit.select("item_id", "beta").join(autoreg.last_differences(d, p), "item_id").join(innovations(d, fit, p), "item_id")
    recent = F.when(F.col("step") >= F.col("n_steps") - season_length, F.struct("step", "target"))
    ends = history.groupBy("item_id").agg(
        F.avg("target").alias("mean"), F.max("ts").alias("t_end"),
        F.transform(F.array_sort(F.collect_list(recent)), lambda x: x["target"]).alias("season"))
    whole = (F.size("season") == season_length) & F.forall("season", lambda y: y.isNotNull())
    return ends.join(per, "item_id", "left").withColumn("beta", F.when(whole, F.col("beta")))


def ancestral_paths(history: DataFrame, horizon: int, p: int = 2, season_length: int = 24, freq: str = "1 hour",
                    num_samples: int = 100, seed: int = 42, model: str | None = None) -> DataFrame:
    """SAMPLES rows of a seasonal AR(p) with hashed innovations.

    A path is an ``aggregate`` over the steps with the path itself as state: a step's difference comes
    from the path's last ``p`` differences and its draw, its value from the value a season before,
    which for later steps is the path's own.  All paths of a series share one row until they are
    exploded, so the pool of innovations is not copied.  A series without a fit repeats its mean.
    """
    m = season_length
    states = ancestral_states(history, p, m)
    beta, pool = F.col("beta"), F.col("pool")

    def draw(h: Column, s: Column) -> Column:
        name = F.concat_ws("|", F.col("item_id"), h.cast("string"), s.cast("string"), F.lit(str(seed)))
        return F.get(pool, F.pmod(F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long"), F.size(pool)).cast("int"))

    def path(s: Column) -> Column:
        def step(state: Column, h: Column) -> Column:
            d = beta[0] + draw(h, s)
            for i in range(1, p + 1):
                d = d + beta[i] * F.get(state["w"], F.size(state["w"]) - i)
            # the season's values, then the path's own: the one a season back is always the h-th
            return F.struct(F.concat(F.slice(state["w"], 2, p - 1), F.array(d)).alias("w"),
                            F.concat(state["y"], F.array(F.get(state["y"], h - 1) + d)).alias("y"))

        start = F.struct(F.col("w0").alias("w"), F.col("season").alias("y"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda state: F.slice(state["y"], m + 1, horizon))

    numbers = F.sequence(F.lit(0), F.lit(num_samples - 1))
    flat = F.transform(numbers, lambda s: F.array_repeat("mean", horizon))
    rows = states.select("item_id", "t_end", F.posexplode(F.when(beta.isNotNull(), F.transform(numbers, path)).otherwise(flat)).alias("sample_id", "values"))
    rows = rows.select("item_id", "t_end", "sample_id", F.posexplode("values").alias("at", "value"))
    return rows.select(F.lit(model or f"ancestral_ar{p}").alias("model"), "item_id", (F.col("at") + 1).cast("int").alias("step"),
                       add_steps(F.col("t_end"), F.col("at") + 1, freq).alias("ts"), F.col("sample_id").cast("int").alias("sample_id"),
                       "value").select(*[f.name for f in SAMPLES.fields])
