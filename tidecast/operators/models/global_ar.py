"""One pooled probabilistic model over all series (M5) — the global-model role.

Re-aimed as a Spark MLlib pipeline: a single linear regression fitted on every
series at once, on

* lagged values at lags ≥ horizon (so every forecast step reads only observed
  history and all steps score in one pass, no recursion),
* calendar fields (hour of day, day of week) one-hot encoded,
* a static category per series, one-hot encoded,
* optional dynamic covariates (COVARIATE rows known over the horizon too),

with each series scaled by its mean absolute value.  Quantiles are fitted by the check loss on
the point forecast, the lags, the series' own spread and the time of day
(``quantile_method="check_loss"``, see :mod:`pinball`), so that they differ by series and step and
never cross; ``"residual"`` takes the point forecast plus pooled residual quantiles
(``percentile_approx``, a mergeable sketch) instead, one offset for all.
MLlib's normal-equation solver aggregates over partitions with ``treeAggregate``; no
series or group is ever gathered into one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.operators.models import pinball
from tidecast.operators.models.base import future_steps
from tidecast.schema import FORECAST_COLUMNS


def default_lags(horizon: int, season_length: int = 24) -> tuple[int, ...]:
    """Lags ≥ horizon: H, H+m, H+2m and one week (notebook preset → 72, 96, 120, 168)."""
    lags = {horizon, horizon + season_length, horizon + 2 * season_length, max(168, horizon)}
    return tuple(sorted(lags))


@dataclass
class GlobalARParams:
    horizon: int = 72
    freq: str = "1 hour"
    season_length: int = 24
    lags: tuple = ()
    quantiles: tuple = (0.1, 0.5, 0.9)
    reg_param: float = 1e-3
    max_iter: int = 50
    model_name: str = "global_ar"
    n_covariates: int = 0
    quantile_method: str = "check_loss"

    def resolved_lags(self) -> tuple[int, ...]:
        lags = tuple(self.lags) or default_lags(self.horizon, self.season_length)
        if min(lags) < self.horizon:
            raise ValueError("global model lags must be ≥ horizon (no recursive forecasting)")
        return lags


def _features(frame: DataFrame, lags: Sequence[int]) -> DataFrame:
    """Lag columns over the (history + future) frame, scaled, plus calendar fields."""
    w = Window.partitionBy("item_id").orderBy("step")
    cols = {f"lag_{k}": F.lag("y_scaled", k).over(w) for k in lags}
    return (frame.withColumns(cols)
                 .withColumn("hour", F.hour("ts").cast("double"))
                 .withColumn("dow", F.weekday("ts").cast("double")))


def _covariate_columns(n: int) -> list[str]:
    return [f"cov_{i}" for i in range(n)]


def _with_covariates(frame: DataFrame, covariates: DataFrame | None, n: int) -> DataFrame:
    """Attach COVARIATE rows (``item_id, ts, feat_index, value``) as ``cov_<i>`` columns.

    Covariates are dynamic features known ahead (calendar effects, planned events …):
    they must cover the future rows too; a missing value counts as 0.
    """
    if not n:
        return frame
    if covariates is None:
        return frame.withColumns({c: F.lit(0.0) for c in _covariate_columns(n)})
    wide = (covariates.groupBy("item_id", "ts").pivot("feat_index", list(range(n)))
                      .agg(F.first("value")))
    wide = wide.withColumnsRenamed({str(i): f"cov_{i}" for i in range(n)})
    out = frame.join(wide, ["item_id", "ts"], "left")
    return out.na.fill(0.0, _covariate_columns(n))


def _extended(history: DataFrame, params: GlobalARParams, scale: DataFrame,
              categories: DataFrame | None, covariates: DataFrame | None = None) -> DataFrame:
    """History rows (with target) + H future rows (target NULL), one frame per series."""
    hist = history.select("item_id", "ts", "step", "target", F.lit(False).alias("future"))
    hist = hist.withColumn("h", F.lit(None).cast("int"))
    fut = future_steps(history, params.horizon, params.freq)
    fut = fut.select("item_id", "ts", (F.col("n_steps") - 1 + F.col("step")).cast("int").alias("step"),
                     F.lit(None).cast("double").alias("target"), F.lit(True).alias("future"), F.col("step").cast("int").alias("h"))
    frame = hist.unionByName(fut).join(scale, "item_id")
    frame = frame.withColumn("y_scaled", F.col("target") / F.col("scale"))
    if categories is not None:
        frame = frame.join(categories.select("item_id", F.col("category").cast("double").alias("cat")),
                           "item_id", "left")
    else:
        frame = frame.withColumn("cat", F.lit(0.0))
    frame = frame.withColumn("cat", F.coalesce("cat", F.lit(0.0)))
    return _with_covariates(frame, covariates, params.n_covariates)


def series_scale(history: DataFrame) -> DataFrame:
    """Per series: ``scale``, the mean absolute value, and on that scale ``level``, the mean, and
    ``spread``, the standard deviation."""
    m = F.avg(F.abs("target"))
    scale = F.when(m.isNull() | (m == 0), F.lit(1.0)).otherwise(m)
    return history.groupBy("item_id").agg(scale.alias("scale"), (F.coalesce(F.avg("target"), F.lit(0.0)) / scale).alias("level"),
                                          (F.coalesce(F.stddev_pop("target"), F.lit(0.0)) / scale).alias("spread"))


def quantile_terms(lags: Sequence[int]) -> list[str]:
    """Terms of the quantiles' regressions: ``with_quantile_terms`` makes those that are no column yet."""
    return ["const", "pred", "spread", *[f"lag_{k}" for k in lags], "hour_sin", "hour_cos"]


def with_quantile_terms(frame: DataFrame) -> DataFrame:
    angle = F.col("hour") * F.lit(2.0 * math.pi / 24.0)
    return frame.withColumns({"const": F.lit(1.0), "hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})


@dataclass
class GlobalARModel:
    params: GlobalARParams
    pipeline: PipelineModel
    residual_quantiles: list
    quantile_fit: pinball.PinballFit | None = None

    # ------------------------------------------------------------------ fit
    @classmethod
    def fit(cls, history: DataFrame, params: GlobalARParams,
            categories: DataFrame | None = None, covariates: DataFrame | None = None) -> "GlobalARModel":
        lags = params.resolved_lags()
        scale = series_scale(history)
        frame = _features(_extended(history, params, scale, categories, covariates), lags)
        train = frame.filter(~F.col("future") & F.col("target").isNotNull())
        for k in lags:
            train = train.filter(F.col(f"lag_{k}").isNotNull())
        # three passes read it (encoder sizes, normal equations, residual sketch):
        # keep the windowed feature rows instead of recomputing them each time
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        enc = OneHotEncoder(inputCols=["hour", "dow", "cat"], outputCols=["hour_v", "dow_v", "cat_v"],
                            handleInvalid="keep")
        asm = VectorAssembler(inputCols=[f"lag_{k}" for k in lags] + ["hour_v", "dow_v", "cat_v"]
                              + _covariate_columns(params.n_covariates),
                              outputCol="features")
        lr = LinearRegression(featuresCol="features", labelCol="y_scaled", predictionCol="pred",
                              regParam=params.reg_param, elasticNetParam=0.0, maxIter=params.max_iter,
                              solver="auto")    # normal equations up to 4096 features, L-BFGS beyond
        model = Pipeline(stages=[enc, asm, lr]).fit(train)
        resid = model.transform(train).select((F.col("y_scaled") - F.col("pred")).alias("r"))
        qs = [float(q) for q in params.quantiles]
        row = resid.agg(F.percentile_approx("r", qs, 10000).alias("rq")).first()
        rq = list(row["rq"]) if row and row["rq"] is not None else [0.0] * len(qs)
        fitted = None
        if params.quantile_method == "check_loss" and qs:
            names = quantile_terms(lags)
            # the pooled residual quantiles are where the rounds start from, so they never end behind them
            start = [[r, 1.0] + [0.0] * (len(names) - 2) for r in rq]
            z = with_quantile_terms(model.transform(train)).select(*names, "y_scaled").persist(StorageLevel.MEMORY_AND_DISK)
            fitted = pinball.fit(z, names, "y_scaled", qs, start)
            z.unpersist()
        train.unpersist()
        return cls(params, model, rq, fitted)

    # ------------------------------------------------------------------ predict
    def forecast(self, history: DataFrame, categories: DataFrame | None = None,
                 covariates: DataFrame | None = None) -> DataFrame:
        """Forecast the H steps after the end of every series in ``history``.  Only the rows that
        a lag reaches are windowed; a lag before a series' start, or in a gap, takes the
        series' mean."""
        p = self.params
        lags = p.resolved_lags()
        scale = series_scale(history)
        recent = history.filter(F.col("step") >= F.col("n_steps") - max(lags))
        frame = _features(_extended(recent, p, scale, categories, covariates), lags)
        fut = frame.filter(F.col("future")).withColumns({f"lag_{k}": F.coalesce(f"lag_{k}", "level") for k in lags})
        scored = self.pipeline.transform(fut)
        entries = [F.struct(F.lit(None).cast("double").alias("q"), F.col("pred").alias("v"))]
        if self.quantile_fit is not None:
            scored = with_quantile_terms(scored).withColumn("qv", pinball.predictions(quantile_terms(lags), self.quantile_fit))
            entries += [F.struct(F.lit(q).alias("q"), F.get("qv", i).alias("v")) for i, q in enumerate(sorted(self.quantile_fit.quantiles))]
        else:
            entries += [F.struct(F.lit(float(q)).alias("q"), (F.col("pred") + F.lit(float(r))).alias("v")) for q, r in zip(p.quantiles, self.residual_quantiles)]
        return (scored.select("item_id", "h", "ts", "scale", F.explode(F.array(*entries)).alias("e"))
                      .select(F.lit(p.model_name).alias("model"), "item_id", F.col("h").alias("step"), "ts",
                              F.col("e.q").alias("quantile"), (F.col("e.v") * F.col("scale")).alias("value"))
                      .select(*FORECAST_COLUMNS))

    # ------------------------------------------------------------------ persistence
    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        meta = {"params": {**self.params.__dict__, "lags": list(self.params.resolved_lags()),
                           "quantiles": list(self.params.quantiles)},
                "residual_quantiles": self.residual_quantiles,
                "quantile_fit": self.quantile_fit.__dict__ if self.quantile_fit else None}
        spark.createDataFrame([(json.dumps(meta),)], "meta STRING").coalesce(1) \
             .write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "GlobalARModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        prm = meta["params"]
        prm["lags"] = tuple(prm["lags"])
        prm["quantiles"] = tuple(prm["quantiles"])
        fitted = meta.get("quantile_fit")
        if fitted:
            fitted = pinball.PinballFit(**{**fitted, "quantiles": tuple(fitted["quantiles"])})
        elif "quantile_method" not in prm:      # saved before quantiles were fitted
            prm["quantile_method"] = "residual"
        return cls(GlobalARParams(**prm), PipelineModel.load(f"{path}/pipeline"), list(meta["residual_quantiles"]), fitted or None)


def global_ar_forecast(history: DataFrame, horizon: int, freq: str = "1 hour",
                       quantiles: Sequence[float] = (0.1, 0.5, 0.9),
                       categories: DataFrame | None = None, season_length: int = 24,
                       covariates: DataFrame | None = None, n_covariates: int = 0,
                       quantile_method: str = "check_loss") -> DataFrame:
    """Fit on ``history`` and forecast its next ``horizon`` steps (one call)."""
    params = GlobalARParams(horizon=horizon, freq=freq, season_length=season_length, quantiles=tuple(quantiles),
                            n_covariates=n_covariates, quantile_method=quantile_method)
    model = GlobalARModel.fit(history, params, categories, covariates)
    return model.forecast(history, categories, covariates)
