"""The scheduled forecast run as Spark jobs.

export_table      source table → mapping → CSV published under a fixed name (B7)
generate_dataset  CSV → series grid → train/test split → JSON-lines records  (B2)
fit               train records → pooled global model                        (B3)
batch_score       test records → forecast past the end → forecast documents  (B4)
output_forecast   forecast documents → chosen quantile → database rows       (B5)
run_forecast_job  all stages for one run date, resumable by a ledger of stages (B6)

Stages hand over through files under the run-dated folder, as in the workload, which
also cuts lineage: a lost executor re-runs at most its own stage.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import series as S
from tidecast.operators.models.global_ar import GlobalARModel, GlobalARParams
from tidecast.schema import SCHEDULED, Preset
from tidecast.sources import manifest
from tidecast.sources import readers as R
from tidecast.sources import sinks as K


@dataclass
class JobConfig:
    base: str                                   # shared folder of the run
    source_csv: str | None = None               # input of generate_dataset
    ts_column: str = "datetime"
    value_column: str | None = None
    item_column: str | None = None
    preset: Preset = SCHEDULED
    quantiles: tuple = (0.1, 0.5, 0.9)
    output_quantile: str = "0.5"
    jdbc_url: str | None = None
    jdbc_table: str = "forecast_result"
    jdbc_props: dict = field(default_factory=dict)
    mappings: Sequence = ()
    source_table: tuple | None = None           # (database, table) for export_table


def _day(run_date) -> str:
    return run_date.strftime("%Y-%m-%d") if isinstance(run_date, (date, datetime)) else str(run_date)


def run_paths(cfg: JobConfig, run_date) -> dict[str, str]:
    root = R.run_path(cfg.base, _day(run_date))
    return {"root": root, "train": f"{root}/train", "test": f"{root}/test",
            "model": f"{root}/model", "output": f"{root}/output", "export": f"{root}/export"}


def run_ids(run_time: datetime) -> dict[str, str]:
    """Job and model names stamped ``yyyy-MM-dd-HH-mm-ss`` (F1)."""
    stamp = run_time.strftime("%Y-%m-%d-%H-%M-%S")
    return {"run": f"forecast-{stamp}", "model_id": f"forecast-model-{stamp}"}


# ----------------------------------------------------------------------------- B7
def export_table(spark: SparkSession, cfg: JobConfig, run_date, df: DataFrame | None = None) -> str:
    """Read the source (catalog table or given frame), apply the mapping, publish one CSV."""
    if df is None:
        db, tbl = cfg.source_table
        df = R.read_table(spark, db, tbl)
    if cfg.mappings:
        df = S.apply_mapping(df, cfg.mappings)
    return K.publish_fixed_name(df, run_paths(cfg, run_date)["export"], "series.csv")


# ----------------------------------------------------------------------------- B2
def generate_dataset(spark: SparkSession, cfg: JobConfig, run_date, series: DataFrame | None = None,
                     mode: str = "overwrite", run_time: datetime | None = None,
                     categories: DataFrame | None = None, covariates: DataFrame | None = None) -> dict[str, str]:
    """Series → regular grid → train (all but the last H) and test (all) records.

    ``categories`` (``item_id, category``) become ``cat``; ``covariates`` (COVARIATE rows from each
    series' start on, and over the horizon to be scored) become ``dynamic_feat``.

    ``run_time`` stamps the run's names; it defaults to midnight of the run date, so that
    every stage and every rerun of a date has the same names.
    """
    p = run_paths(cfg, run_date)
    if series is None:
        series = R.read_series_csv(spark, cfg.source_csv, cfg.ts_column, cfg.value_column, cfg.item_column)
    grid = S.regularise(S.aggregate_cells(series, cfg.preset.freq, "sum"), cfg.preset.freq)
    train = S.train_part(grid, cfg.preset.horizon)
    K.write_series_json(_record(S.nest_target(train), categories, covariates), p["train"], mode)
    K.write_series_json(_record(S.nest_target(grid), categories, covariates), p["test"], mode)
    return {**p, **run_ids(run_time or datetime.combine(datetime.fromisoformat(str(_day(run_date))[:10]), datetime.min.time()))}


def _record(nested: DataFrame, categories: DataFrame | None, covariates: DataFrame | None) -> DataFrame:
    if categories is not None:
        cat = categories.groupBy("item_id").agg(F.array(F.min(F.col("category").cast("int"))).alias("cat"))
        nested = nested.join(cat, "item_id", "left")
    if covariates is not None:
        own = covariates.join(nested.select("item_id", "start"), "item_id").filter(F.col("ts") >= F.col("start"))
        nested = nested.join(S.nest_features(own.drop("start")), "item_id", "left")
    return nested


def _static(nested: DataFrame) -> DataFrame:
    return nested.select("item_id", F.coalesce(F.get("cat", F.lit(0)), F.lit(0)).alias("category"))


def _nested_to_grid(nested: DataFrame, freq: str) -> DataFrame:
    return S.unnest_target(nested, freq, {"n_steps": F.size("target").cast("int")}).select(*S.GRID_COLUMNS)


# ----------------------------------------------------------------------------- B3
def fit(spark: SparkSession, cfg: JobConfig, train_path: str) -> GlobalARModel:
    """Pooled model over all records, with their category and dynamic features where given."""
    nested = R.read_series_json(spark, train_path)
    channels = nested.agg(F.max(F.size("dynamic_feat")).alias("n")).first()["n"]
    params = GlobalARParams(horizon=cfg.preset.horizon, freq=cfg.preset.freq, season_length=cfg.preset.season_length,
                            quantiles=tuple(cfg.quantiles), n_covariates=max(channels or 0, 0))
    return GlobalARModel.fit(_nested_to_grid(nested, cfg.preset.freq), params, _static(nested),
                             S.unnest_feature(nested, None, cfg.preset.freq))


# ----------------------------------------------------------------------------- B4
def batch_score(spark: SparkSession, cfg: JobConfig, model: GlobalARModel, test_path: str,
                out_path: str, mode: str = "overwrite") -> DataFrame:
    """Forecast past the end of every full series; one document line per series."""
    nested = R.read_series_json(spark, test_path)
    fc = model.forecast(_nested_to_grid(nested, cfg.preset.freq), _static(nested), S.unnest_feature(nested, None, cfg.preset.freq))
    K.write_forecast_json(fc, out_path, mode)
    return fc


# ----------------------------------------------------------------------------- B5
def output_forecast(spark: SparkSession, cfg: JobConfig, doc_path: str) -> DataFrame:
    """Chosen quantile of each document → rows; written to the database when configured."""
    rows = R.read_forecast_json(spark, doc_path, cfg.output_quantile, cfg.preset.freq)
    if cfg.jdbc_url:
        K.write_forecast_jdbc(rows, cfg.jdbc_url, cfg.jdbc_table, **cfg.jdbc_props)
    return rows


# ----------------------------------------------------------------------------- B6
def content_hash(df: DataFrame | None) -> str:
    """A fingerprint of a frame's rows, whatever their order: one aggregate over the frame."""
    if df is None:
        return "none"
    columns = sorted(df.columns)
    h = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("x"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)).alias("s")).first()
    return json.dumps([df.select(*[f"`{c}`" for c in columns]).schema.simpleString(), row["n"], row["x"], row["s"]])


class Ledger:
    """Which stages of a run are done, with the fingerprint of all that went into each.

    Every finished stage is one manifest entry, created at once, so a run that ends anywhere leaves
    a stage either done or not.  A stage's fingerprint holds those of the stages before it: when an
    input or a parameter changes, it and all that depends on it run again, and nothing else does.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.target = spark, f"{root}/ledger"

    def done(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for _, entry in manifest.entries(self.spark, self.target):      # newest first
            out.setdefault(entry["stage"], entry["fingerprint"])
        return out

    def run(self, stage: str, inputs: Sequence[str], work) -> str:
        """Do ``work()`` unless it was done with equal ``inputs``; the stage's fingerprint."""
        fingerprint = hashlib.sha256(json.dumps([stage, list(inputs)]).encode()).hexdigest()
        if self.done().get(stage) != fingerprint:
            work()
            manifest.commit(self.spark, self.target, {"stage": stage, "fingerprint": fingerprint})
        return fingerprint


def run_forecast_job(spark: SparkSession, cfg: JobConfig, run_date, series: DataFrame | None = None,
                     categories: DataFrame | None = None, covariates: DataFrame | None = None) -> DataFrame:
    """All stages for one run date (the date is fixed once for every stage).

    A run that is started again goes on behind the last stage that ended; stages whose inputs or
    parameters changed run again with those that depend on them.
    """
    day = _day(run_date)
    p = run_paths(cfg, day)
    ledger = Ledger(spark, p["root"])
    if series is None:
        series = R.read_series_csv(spark, cfg.source_csv, cfg.ts_column, cfg.value_column, cfg.item_column)
    grid = [str(cfg.preset.freq), str(cfg.preset.horizon)]
    data = ledger.run("dataset", [*grid, *map(content_hash, (series, categories, covariates))],
                      lambda: generate_dataset(spark, cfg, day, series, categories=categories, covariates=covariates))
    fitted = ledger.run("fit", [data, str(cfg.preset.season_length), str(list(cfg.quantiles))],
                        lambda: fit(spark, cfg, p["train"]).save(spark, p["model"]))
    ledger.run("score", [fitted], lambda: batch_score(spark, cfg, GlobalARModel.load(spark, p["model"]), p["test"], p["output"]))
    return output_forecast(spark, cfg, p["output"])
