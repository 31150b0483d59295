import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidecast.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="tidecast-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidecast-wh-"),
                           # tests only: the cluster names the shared folder; here a scratch one stands in
                           "spark.checkpoint.dir": os.environ.get("TIDECAST_TEST_CHECKPOINT") or tempfile.mkdtemp(prefix="tidecast-ck-")})
    yield s


T0 = datetime(2024, 1, 1)


def hourly_rows(item, values, start=T0, freq=timedelta(hours=1)):
    return [(item, start + i * freq, None if v is None else float(v)) for i, v in enumerate(values)]


def series_df(spark, rows):
    return spark.createDataFrame(rows, "item_id STRING, ts TIMESTAMP_NTZ, target DOUBLE")


def grid_df(spark, rows, freq="1 hour"):
    from tidecast.operators.series import regularise
    return regularise(series_df(spark, rows), freq)
