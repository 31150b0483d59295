from tidecast.streaming.ingest import append_to_table, ingest_available, stream_series_csv


def test_second_run_sees_only_new_file(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text("datetime,value\n2024-01-01 00:00:00,1\n2024-01-01 01:00:00,2\n")
    out, ck = str(tmp_path / "table"), str(tmp_path / "ck")
    got = []

    def on_batch(df, epoch):
        got.append(df.count())
        append_to_table(out)(df, epoch)

    schema = "datetime STRING, value DOUBLE"
    n1 = ingest_available(spark, stream_series_csv(spark, str(src), schema), "t1", on_batch, ck)
    assert n1 >= 1 and sum(got) == 2
    (src / "b.csv").write_text("datetime,value\n2024-01-01 02:00:00,3\n")
    got.clear()
    ingest_available(spark, stream_series_csv(spark, str(src), schema), "t1", on_batch, ck)
    assert sum(got) == 1
    assert spark.read.parquet(out).count() == 3


def test_ingest_cells_accumulates_exactly_across_arrivals(spark, tmp_path):
    import uuid

    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from tidecast.operators.series import aggregate_cells
    from tidecast.plans.datasets import events_as_series
    from tidecast.streaming.ingest import ReplacedFileError, ingest_cells, state_folder

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    land = tmp_path / "landing"
    land.mkdir()
    for label, part in (("a", 0), ("b", 1)):
        ev.filter(F.col("event_id") % 2 == part).coalesce(1).write.parquet(str(tmp_path / f"staging_{label}"))

    def arrive(label):
        f = next(p for p in (tmp_path / f"staging_{label}").iterdir() if p.name.startswith("part-"))
        f.rename(land / f"events_{label}.parquet")

    stream_name = f"arrivals_{uuid.uuid4().hex[:8]}"  # state lives in the session's shared folder
    arrive("a")
    first = ingest_cells(spark, str(land), "events", stream_name, scale=2)
    half = ev.filter(F.col("event_id") % 2 == 0).select(
        F.col("event_type").alias("item_id"), "ts", F.col("value").alias("target"))
    assert first.exceptAll(aggregate_cells(half, "1 hour", "exact_sum", 2)).count() == 0

    arrive("b")
    both = ingest_cells(spark, str(land), "events", stream_name, scale=2)
    want = aggregate_cells(events_as_series(spark, SF_SMALL), "1 hour", "exact_sum", 2)
    assert both.exceptAll(want).count() == 0 and want.exceptAll(both).count() == 0
    table = spark.read.parquet(f"{state_folder(spark, stream_name)}/table")
    assert table.select("batch_id").distinct().count() == 2  # one batch per arrival


def test_a_replaced_file_is_seen(spark, tmp_path):
    import pytest

    from conftest import SF_SMALL
    from tidecast.streaming.ingest import ReplacedFileError, cells_by_file, ingest_cells

    land, state = tmp_path / "landing", str(tmp_path / "state")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.limit(300).coalesce(1).write.parquet(f"{land}/events.parquet")
    first = ingest_cells(spark, str(land), "events", "one", state=state)
    again = ingest_cells(spark, str(land), "events", "one", state=state)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    whole = {(r[0], r[1]): r[2] for r in cells_by_file(spark, str(land), "events").collect()}
    assert {(r[0], r[1]): pytest.approx(r[2]) for r in first.collect()} == whole
    part = next(p for p in (land / "events.parquet").iterdir() if p.name.startswith("part-"))
    ev.limit(200).coalesce(1).write.parquet(str(tmp_path / "other"))
    new = next(p for p in (tmp_path / "other").iterdir() if p.name.startswith("part-"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_bytes(new.read_bytes())
    with pytest.raises(ReplacedFileError):
        ingest_cells(spark, str(land), "events", "one", state=state)
