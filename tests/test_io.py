import json
import os

import pytest

from conftest import T0, grid_df, hourly_rows
from tidecast.operators import series as S
from tidecast.operators.models import naive
from tidecast.sources import readers as R
from tidecast.sources import sinks as K


def test_c8_nan_roundtrip(spark, tmp_path):
    g = grid_df(spark, hourly_rows("a", [1, None, 2.5]))
    path = str(tmp_path / "series")
    K.write_series_json(S.nest_target(g), path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".json"))
    assert '[1.0,"NaN",2.5]' in text
    back = R.read_series_json(spark, path).first()
    assert back.target == [1.0, None, 2.5] and back.start == T0


def test_json_reader_canonicalises_names(spark, tmp_path):
    p = tmp_path / "in.json"
    # a bare NaN (not valid JSON, but written by json.dumps) must read back as NULL too
    p.write_text('{"id": "x", "start": "2024-01-01 00:00:00", "target": [1, NaN], '
                 '"feat_static_cat": [3], "feat_dynamic_real": [[0.5, 0.5]]}\n')
    r = R.read_series_json(spark, str(p)).first()
    assert r.item_id == "x" and r.cat == [3] and r.dynamic_feat == [[0.5, 0.5]] and r.target == [1.0, None]


def test_period_variant_is_a_partition(spark, tmp_path):
    for period, v in (("Aug", 1.0), ("Nov", 2.0)):
        d = tmp_path / f"period={period}"
        d.mkdir()
        (d / "part.json").write_text(json.dumps({"id": "a", "start": "2024-01-01 00:00:00", "target": [v]}) + "\n")
    r = R.read_series_json(spark, str(tmp_path), period="Nov").collect()
    assert len(r) == 1 and r[0].target == [2.0]


def test_csv_series_and_overrides(spark, tmp_path):
    p = tmp_path / "meter.csv"
    p.write_text("datetime,kwh\n2024-01-01 01:00:00,2.5\n2024-01-01 00:00:00,1.5\n")
    s = R.read_series_csv(spark, str(p)).orderBy("ts").collect()
    assert [r.target for r in s] == [1.5, 2.5] and s[0].item_id == "0"
    df = R.read_csv(spark, str(p), infer=False, overrides={"kwh": "double"})
    assert dict(df.dtypes)["kwh"] == "double"


def test_publish_fixed_name_is_idempotent_and_parallel(spark, tmp_path):
    df = spark.range(100).repartition(4)
    out = K.publish_fixed_name(df, str(tmp_path / "exp"), "readings.csv")
    out2 = K.publish_fixed_name(df, str(tmp_path / "exp"), "readings.csv")
    assert out == out2 and os.path.isdir(out)
    assert [f for f in os.listdir(tmp_path / "exp") if not f.startswith(".")] == ["readings.csv"]
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 4  # written by four tasks, not funnelled through one
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 100 and back.columns == ["id"]
    with pytest.raises(FileExistsError):
        K.publish_fixed_name(df, str(tmp_path / "exp"), "readings.csv", mode="error")


def test_forecast_documents_roundtrip(spark, tmp_path):
    g = grid_df(spark, hourly_rows("a", [1, 2, 3, 1, 2, 3]))
    fc = naive.seasonal_naive(g, 4, 3, quantiles=(0.5, 0.9))
    path = str(tmp_path / "out")
    K.write_forecast_json(fc, path)
    doc = json.loads(spark.read.text(path).first()[0])
    assert doc["quantiles"]["0.5"] == [1.0, 2.0, 3.0, 1.0] and doc["mean"] == [1.0, 2.0, 3.0, 1.0]
    rows = R.read_forecast_json(spark, path, "0.5").orderBy("step").collect()
    assert [r.value for r in rows] == [1.0, 2.0, 3.0, 1.0] and rows[0].step == 1
    assert rows[0].ts == T0.replace(hour=6) and rows[3].ts == T0.replace(hour=9)


def test_csv_sink_and_run_path(spark, tmp_path):
    K.write_csv(spark.range(10), str(tmp_path / "c"), partitions=1)
    assert len([f for f in os.listdir(tmp_path / "c") if f.endswith(".csv")]) == 1
    assert R.run_path("s3a://bucket/base/", "2024-05-01") == "s3a://bucket/base/run_date=2024-05-01"


def test_jdbc_options_partitioned_scan():
    o = R.jdbc_options("jdbc:mysql://h/db", "t", user="u", password="p", partition_column="id",
                       lower=0, upper=1000, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id" and o["user"] == "u"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x", "t", partition_column="id")


def test_catalog_table_scan(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tc_test")
    spark.range(3).write.mode("overwrite").saveAsTable("tc_test.t")
    assert R.read_table(spark, "tc_test", "t").count() == 3
