"""R1 refresh: arrivals, a replacement, compaction, runs that end early; the manifest protocol."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidecast.sources import manifest
from tidecast.streaming import ingest, refresh as R

SPEC = R.RefreshSpec(scale=2, horizon=6, quantiles=(0.5,))


def land(spark, rows, folder, name):
    """One Parquet file ``name`` with the rows."""
    out = folder.parent / f"write-{name}-{time.time_ns()}"
    rows.coalesce(1).write.parquet(str(out))
    part = next(p for p in out.iterdir() if p.name.startswith("part-"))
    os.replace(part, folder / f"{name}.parquet")


def full(spark, folder):
    rows = spark.read.parquet(f"{folder}/events*.parquet").withColumn("arrival", F.lit("all"))
    return R.forecast_by_parts(rows, "arrival", SPEC)


def same(a, b):
    key = lambda r: (r["item_id"], r["step"], str(r["quantile"]))
    a, b = ({key(r): (r["ts"], r["value"]) for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys() and a
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], rel=1e-9, abs=1e-9)


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return spark.read.parquet(f"{SF_SMALL}/events.parquet"), folder


def test_three_arrivals_and_a_replacement(spark, landing, tmp_path):
    ev, folder = landing
    st = str(tmp_path / "state")
    land(spark, ev.filter("event_id % 3 = 0"), folder, "events_a")
    same(R.refresh(spark, str(folder), "events", "r3", SPEC, st), full(spark, folder))
    land(spark, ev.filter("event_id % 3 = 1 and event_type in ('click', 'view')"), folder, "events_b")
    same(R.refresh(spark, str(folder), "events", "r3", SPEC, st), full(spark, folder))
    base = ingest.state_folder(spark, "r3", st)
    scored = {r["refresh"]: r["items"] for r in spark.read.parquet(f"{base}/scored").groupBy("refresh").agg(F.sort_array(F.collect_set("item_id")).alias("items")).collect()}
    assert len(scored[0]) == 5 and scored[1] == ["click", "view"]       # only what the second file touched
    land(spark, ev.filter("event_id % 3 = 2"), folder, "events_c")
    same(R.refresh(spark, str(folder), "events", "r3", SPEC, st), full(spark, folder))
    # the second file is replaced by one of another series: its old readings are retracted
    time.sleep(1.1)
    land(spark, ev.filter("event_id % 3 = 1 and event_type = 'error'"), folder, "events_b")
    same(R.refresh(spark, str(folder), "events", "r3", SPEC, st), full(spark, folder))
    items = {r["item_id"] for r in spark.read.parquet(f"{base}/scored/refresh=3").collect()}
    assert items == {"click", "view", "error"}
    # nothing new: nothing is scored
    R.refresh(spark, str(folder), "events", "r3", SPEC, st)
    assert len(list((tmp_path / "state").rglob("scored/refresh=*"))) == 4


def test_compaction_keeps_the_result_and_the_versions(spark, landing, tmp_path):
    ev, folder = landing
    st, spec = str(tmp_path / "state"), R.RefreshSpec(scale=2, horizon=6, quantiles=(0.5,), compact_after=1)
    for k, name in enumerate("abc"):
        land(spark, ev.filter(f"event_id % 3 = {k}"), folder, f"events_{name}")
        got = R.refresh(spark, str(folder), "events", "rc", spec, st)
    same(got, full(spark, folder))
    state = R.RefreshState(spark, ingest.state_folder(spark, "rc", st))
    assert all(len(state.live_folders(t)) == 1 for t in state.TABLES)
    time.sleep(1.1)
    land(spark, ev.filter("event_id % 3 = 0 and event_id > 300"), folder, "events_a")
    same(R.refresh(spark, str(folder), "events", "rc", spec, st), full(spark, folder))


def test_a_compaction_that_never_ends_changes_nothing(spark, landing, tmp_path, monkeypatch):
    ev, folder = landing
    st = str(tmp_path / "state")
    for k in (0, 1):
        land(spark, ev.filter(f"event_id % 2 = {k}"), folder, f"events_{k}")
        R.refresh(spark, str(folder), "events", "rx", SPEC, st)
    state = R.RefreshState(spark, ingest.state_folder(spark, "rx", st))
    before = [state.live_folders(t) for t in state.TABLES]
    with monkeypatch.context() as m:
        m.setattr(R.manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.compact()
    assert [state.live_folders(t) for t in state.TABLES] == before
    assert state.compact() and len(state.live_folders("parts")) == 1
    same(R.refresh(spark, str(folder), "events", "rx", SPEC, st), full(spark, folder))


def test_a_run_that_ends_before_its_record_scores_again(spark, landing, tmp_path, monkeypatch):
    ev, folder = landing
    st = str(tmp_path / "state")
    land(spark, ev, folder, "events_a")
    with monkeypatch.context() as m:
        m.setattr(R, "_score", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            R.refresh(spark, str(folder), "events", "re", SPEC, st)
    same(R.refresh(spark, str(folder), "events", "re", SPEC, st), full(spark, folder))


# ---------------------------------------------------------------- manifest

def test_publish_resolve_expire(spark, tmp_path):
    target = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, target)
    paths = [manifest.publish(spark.range(n), target, keep=2) for n in (1, 2, 3)]
    assert manifest.read(spark, target).count() == 3
    assert not os.path.exists(paths[0]) and os.path.exists(paths[1]) and manifest.resolve(spark, target) == paths[2]
    assert manifest.publish(spark.range(9), target, mode="ignore") == paths[2]
    with pytest.raises(FileExistsError):
        manifest.publish(spark.range(9), target, mode="error")


@pytest.mark.parametrize("step", ["write", "commit", "half a manifest", "expire"])
def test_a_failure_at_each_step_leaves_a_version_readable(spark, tmp_path, monkeypatch, step):
    target = str(tmp_path / "out")
    manifest.publish(spark.range(1), target)

    def lost(*a, **k):
        raise RuntimeError("lost")

    if step == "write":
        bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception, match="lost"):
            manifest.publish(bad, target)
    elif step == "half a manifest":
        name = "version-half"
        spark.range(7).write.parquet(f"{target}/{name}")
        (tmp_path / "out" / "_manifest" / "0000000002").write_text('{"folder": "' + name)
    else:
        with monkeypatch.context() as m:
            m.setattr(manifest, step, lost)
            with pytest.raises(RuntimeError):
                manifest.publish(spark.range(5), target)
    assert manifest.read(spark, target).count() == (5 if step == "expire" else 1)
    manifest.publish(spark.range(3), target, keep=1)
    assert manifest.read(spark, target).count() == 3
    manifest.sweep(spark, target)
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("version-")]) == 1


def test_two_writers_take_different_numbers(spark, tmp_path):
    target = str(tmp_path / "out")
    a = manifest.commit(spark, target, {"folder": "x", "format": "parquet"})
    (tmp_path / "out" / "_manifest" / f"{a + 1:010d}").write_text("")       # another writer has begun
    b = manifest.commit(spark, target, {"folder": "y", "format": "parquet"})
    assert b == a + 2 and [e["folder"] for _, e in manifest.entries(spark, target)] == ["y", "x"]
