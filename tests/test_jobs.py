import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidecast.plans import jobs
from tidecast.schema import Preset


def test_run_forecast_job_from_events(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    series = ev.select(F.col("event_type").alias("item_id"), "ts", F.col("value").alias("target"))
    cfg = jobs.JobConfig(base=str(tmp_path / "runs"), preset=Preset(horizon=24, context_length=168))
    rows = jobs.run_forecast_job(spark, cfg, "2024-02-01", series)
    got = rows.collect()
    assert len(got) == 5 * 24
    assert os.path.isdir(tmp_path / "runs" / "run_date=2024-02-01" / "model")
    train = spark.read.json(str(tmp_path / "runs" / "run_date=2024-02-01" / "train"))
    test = spark.read.json(str(tmp_path / "runs" / "run_date=2024-02-01" / "test"))
    tl = {r.item_id: len(r.target) for r in train.collect()}
    sl = {r.item_id: len(r.target) for r in test.collect()}
    assert all(sl[k] - tl[k] == 24 for k in tl)


def test_export_table_publishes_one_mapped_file(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 7, "1.5", "x")], "taken STRING, meter INT, reading STRING, junk STRING")
    cfg = jobs.JobConfig(base=str(tmp_path), mappings=[("taken", "string", "at", "timestamp"), ("meter", "int", "meter_id", "string"),
                                                      ("reading", "string", "kwh", "double")])
    out = jobs.export_table(spark, cfg, "2024-01-02", df)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["at", "meter_id", "kwh"] and back.first()["kwh"] == "1.5"


def test_run_ids():
    from datetime import datetime
    ids = jobs.run_ids(datetime(2024, 1, 2, 3, 4, 5))
    assert ids["model_id"].endswith("2024-01-02-03-04-05")


def test_covariates_and_categories_reach_the_model(spark, tmp_path):
    import random
    from datetime import timedelta
    from conftest import T0
    rnd = random.Random(3)
    rows, cov = [], []
    for item in ("a", "b", "c"):
        for i in range(24 * 12 + 24):
            x = float(rnd.random() < 0.3)
            cov.append((item, T0 + timedelta(hours=i), 0, x))
            if i < 24 * 12:
                rows.append((item, T0 + timedelta(hours=i), 10.0 + 50.0 * x))
    series = spark.createDataFrame(rows, "item_id STRING, ts TIMESTAMP_NTZ, target DOUBLE")
    covariates = spark.createDataFrame(cov, "item_id STRING, ts TIMESTAMP_NTZ, feat_index INT, value DOUBLE")
    cats = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1)], "item_id STRING, category INT")
    cfg = jobs.JobConfig(base=str(tmp_path / "runs"), preset=Preset(horizon=24, context_length=168))
    got = jobs.run_forecast_job(spark, cfg, "2024-02-01", series, cats, covariates).collect()
    want = {(i, t): 10.0 + 50.0 * x for i, t, _, x in cov}
    assert len(got) == 3 * 24
    assert all(abs(r.value - want[r.item_id, r.ts]) < 5 for r in got)


def _stages(monkeypatch):
    ran = []
    for name in ("generate_dataset", "fit", "batch_score"):
        real = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda *a, _n=name, _r=real, **k: (ran.append(_n), _r(*a, **k))[1])
    return ran


def test_a_run_goes_on_behind_the_stage_that_ended_and_repeats_only_what_changed(spark, tmp_path, monkeypatch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("event_type in ('click', 'view')")
    series = ev.select(F.col("event_type").alias("item_id"), "ts", F.col("value").alias("target"))
    cfg = jobs.JobConfig(base=str(tmp_path / "runs"), preset=Preset(horizon=24, context_length=168))
    want = None
    for crash in ("generate_dataset", "fit", "batch_score", None):
        with monkeypatch.context() as m:
            ran = _stages(m)
            if crash:
                m.setattr(jobs, crash, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
                try:
                    jobs.run_forecast_job(spark, cfg, "2024-02-01", series)
                    raise AssertionError
                except RuntimeError:
                    pass
            else:
                want = jobs.run_forecast_job(spark, cfg, "2024-02-01", series).count()
        # a stage that ended is not run again
        assert ran == {"generate_dataset": [], "fit": ["generate_dataset"], "batch_score": ["fit"], None: ["batch_score"]}[crash]
    assert want == 2 * 24
    with monkeypatch.context() as m:
        ran = _stages(m)
        jobs.run_forecast_job(spark, cfg, "2024-02-01", series.repartition(5))      # the same rows
        assert ran == []
        cfg.quantiles = (0.2, 0.5)
        jobs.run_forecast_job(spark, cfg, "2024-02-01", series)
        assert ran == ["fit", "batch_score"]
        jobs.run_forecast_job(spark, cfg, "2024-02-01", series.filter("target > 1"))
        assert ran == ["fit", "batch_score", "generate_dataset", "fit", "batch_score"]
