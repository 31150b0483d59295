"""Fitted state per series (K8, S9): what M2 to M4 need to forecast, without the history.

``resample_state``   the context values of each series (M2)
``fourier_state``    coefficients and residual scale (M3)
``ar_state``         coefficients, last differences and last season (M4)

``save`` writes a state bucketed by ``item_id`` and publishes it with its number of buckets and its
schema in the manifest; ``load`` gives the live version as a bucketed table.  Forecasts are made from
the rows themselves, and ``requested`` joins a list of series to the state: in every case the state is
read in its buckets and never shuffled.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.features import DEFAULT_SEASONALITIES
from tidecast.functions.time import add_steps
from tidecast.operators.models import autoreg, fourier, linear
from tidecast.operators.models.base import gaussian_rows
from tidecast.schema import FORECAST_COLUMNS
from tidecast.sources import manifest


# ---------------------------------------------------------------- states and their forecasts

def resample_state(history: DataFrame, context_length: int = 168) -> DataFrame:
    """``item_id, n_steps, t_end, mean, context ARRAY<STRUCT<step, target>>``."""
    recent = F.when(F.col("step") >= F.col("n_steps") - context_length, F.struct("step", "target"))
    return history.groupBy("item_id").agg(F.max("n_steps").alias("n_steps"), F.max("ts").alias("t_end"), F.avg("target").alias("mean"),
                                          F.array_sort(F.collect_list(recent)).alias("context"))


def resample_forecast(state: DataFrame, horizon: int, context_length: int = 168, season_length: int = 24, decay: float = 0.5,
                      freq: str = "1 hour", quantiles: Sequence[float] = (0.1, 0.5, 0.9), model: str = "resample") -> DataFrame:
    """What :func:`naive.kernel_resample` gives on the history; the candidates of a step are picked
    from the context in the row."""
    n, m = F.col("n_steps"), season_length

    def values(h: Column) -> Column:
        same = F.filter("context", lambda x: x["target"].isNotNull() & (x["step"] >= n - context_length) & (F.pmod(x["step"], F.lit(m)) == F.pmod(n - 1 + h, F.lit(m))))
        weighted = F.transform(same, lambda x: F.struct(x["target"].alias("y"), x["step"].alias("step"), F.exp(F.lit(-decay) * F.floor((n - 1 - x["step"]) / m)).alias("w")))
        return linear.let(F.sort_array(weighted), lambda c: linear.let(F.aggregate(c["w"], F.lit(0.0), lambda a, w: a + w), lambda total: F.array(
            linear.dot(c["w"], c["y"]) / total, *[smallest(c, q * total) for q in quantiles])))

    def smallest(c: Column, bound: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("v"))
        return F.aggregate(c, start, lambda s, x: F.struct((s["cum"] + x["w"]).alias("cum"), F.when(s["v"].isNull() & (s["cum"] + x["w"] >= bound), x["y"]).otherwise(s["v"]).alias("v")), lambda s: s["v"])

    per_phase = F.transform(F.sequence(F.lit(1), F.lit(min(m, horizon))), lambda h: F.when(F.exists("context", lambda x: x["target"].isNotNull() & (
        F.pmod(x["step"], F.lit(m)) == F.pmod(n - 1 + h, F.lit(m)))), values(h)))
    rows = state.withColumn("v", per_phase).select("item_id", "t_end", "mean", "v", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    rows = rows.withColumn("v", F.get("v", F.pmod(F.col("step") - 1, F.lit(m))))
    entries = [F.struct(F.lit(q).cast("double").alias("quantile"), F.coalesce(F.get("v", i), "mean").alias("value")) for i, q in enumerate((None, *quantiles))]
    return (rows.select("item_id", "step", add_steps("t_end", "step", freq).alias("ts"), F.explode(F.array(*entries)).alias("e"))
                .select(F.lit(model).alias("model"), "item_id", F.col("step").cast("int").alias("step"), "ts", "e.quantile", "e.value").select(*FORECAST_COLUMNS))


def fourier_state(history: DataFrame, freq: str = "1 hour", seasonalities=DEFAULT_SEASONALITIES) -> DataFrame:
    """``item_id, n_steps, t_end, beta, sigma``."""
    ends = history.groupBy("item_id").agg(F.max("n_steps").alias("n_steps"), F.max("ts").alias("t_end"))
    return ends.join(fourier.fit_fourier(history, freq, seasonalities), "item_id")


def fourier_forecast(state: DataFrame, horizon: int, freq: str = "1 hour", seasonalities=DEFAULT_SEASONALITIES,
                     quantiles: Sequence[float] = (0.1, 0.5, 0.9), model: str = "fourier") -> DataFrame:
    """What :func:`fourier.fourier_forecast` gives on the history."""
    rows = state.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("ts", add_steps("t_end", "step", freq))
    x = F.array(*[c for _, c, _ in fourier.design(F.col("ts"), F.col("n_steps") - 1 + F.col("step"), freq, seasonalities)])
    return gaussian_rows(rows.select("item_id", "step", "ts", linear.dot(F.col("beta"), x).alias("value"), "sigma"), model, quantiles)


def ar_state(history: DataFrame, p: int = 2, season_length: int = 24) -> DataFrame:
    """``item_id, t_end, mean, season ARRAY, w0 ARRAY, beta ARRAY, sigma``; the last three are null
    where the series is too short or ends in gaps."""
    fit = autoreg.fit_ar(history, p, season_length).filter(F.col("beta").isNotNull())
    last = autoreg.last_differences(autoreg.lagged_differences(history, p, season_length), p)
    recent = F.when(F.col("step") >= F.col("n_steps") - season_length, F.struct("step", "target"))
    ends = history.groupBy("item_id").agg(F.max("ts").alias("t_end"), F.avg("target").alias("mean"),
                                          F.transform(F.array_sort(F.collect_list(recent)), lambda x: x["target"]).alias("season"))
    return ends.join(fit.join(last, "item_id"), "item_id", "left")


def ar_forecast(state: DataFrame, horizon: int, p: int = 2, season_length: int = 24, freq: str = "1 hour",
                quantiles: Sequence[float] = (0.1, 0.5, 0.9), model: str | None = None) -> DataFrame:
    """What :func:`autoreg.ar_p_forecast` gives on the history."""
    m, beta = season_length, F.col("beta")

    def step(s: Column, _: Column) -> Column:
        d = beta[0] + linear.dot(F.slice(beta, 2, p), F.reverse(s["w"]))
        return linear.let(d, lambda d: F.struct(F.concat(F.slice(s["w"], 2, p - 1), F.array(d)).alias("w"), F.concat(s["out"], F.array(d)).alias("out")))

    start = F.struct(F.col("w0").alias("w"), F.array().cast("array<double>").alias("out"))
    rolled = F.when(beta.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"]))
    rows = state.withColumn("dhat", rolled).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    before = F.floor((F.col("step") - 1) / m).cast("int")        # whole seasons passed
    summed = F.aggregate(F.sequence(F.lit(0), before), F.lit(0.0), lambda a, j: a + F.get("dhat", F.col("step") - 1 - j * m))
    value = F.when(beta.isNotNull(), F.get("season", F.pmod(F.col("step") - 1, F.lit(m))) + summed).otherwise(F.col("mean"))
    sigma = F.when(beta.isNotNull(), F.col("sigma") * F.sqrt((before + 1).cast("double")))
    return gaussian_rows(rows.select("item_id", "step", add_steps("t_end", "step", freq).alias("ts"), value.alias("value"), sigma.alias("sigma")),
                         model or f"seasonal_ar{p}", quantiles)


# ---------------------------------------------------------------- tables

def save(state: DataFrame, target: str, buckets: int = 200, keep: int = 2) -> str:
    """Publish the state, bucketed and sorted by ``item_id``; its folder."""
    spark, target = state.sparkSession, target.rstrip("/")
    folder, name = f"version-{uuid.uuid4().hex}", f"tidecast_state_{uuid.uuid4().hex}"
    state.repartition(buckets, "item_id").write.bucketBy(buckets, "item_id").sortBy("item_id").option("path", f"{target}/{folder}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")       # an external table: the files stay
    manifest.commit(spark, target, {"folder": folder, "format": "parquet", "buckets": buckets, "columns": _columns(state)})
    manifest.expire(spark, target, keep)
    return f"{target}/{folder}"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def load(spark: SparkSession, target: str) -> DataFrame:
    """The live version as a bucketed table of this session's catalog."""
    target = target.rstrip("/")
    path = manifest.resolve(spark, target)
    if path is None:
        raise FileNotFoundError(f"{target} has no published state")
    entry = next(e for _, e in manifest.entries(spark, target) if path.endswith(e["folder"]))
    name = "tidecast_state_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({entry['columns']}) USING parquet "
              f"CLUSTERED BY (item_id) SORTED BY (item_id) INTO {entry['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def requested(state: DataFrame, items: DataFrame) -> DataFrame:
    """The state of the series in ``items`` (``item_id``): only the list is shuffled, into the buckets
    (save with at least ``spark.sql.shuffle.partitions`` of them; with fewer Spark deals both sides anew)."""
    return state.join(items.select("item_id").distinct(), "item_id", "left_semi")
