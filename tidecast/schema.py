"""The long tables every operator exchanges, and the two parameter presets.

SERIES      item_id STRING, ts TIMESTAMP_NTZ, target DOUBLE
GRID        SERIES + step INT (0-based position on the regular grid) + n_steps INT
COVARIATE   item_id STRING, ts TIMESTAMP_NTZ, feat_index INT, value DOUBLE
NESTED      item_id STRING, start TIMESTAMP_NTZ, target ARRAY<DOUBLE>,
            cat ARRAY<INT>, dynamic_feat ARRAY<ARRAY<DOUBLE>>
SPLIT       SERIES + split STRING ('train' | 'holdout')
FORECAST    model STRING, item_id STRING, step INT (1..H), ts TIMESTAMP_NTZ,
            quantile DOUBLE (NULL = mean), value DOUBLE
SAMPLES     model, item_id, step, ts, sample_id INT, value DOUBLE
PAIRED      model, item_id, step, ts, y DOUBLE, f DOUBLE
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SERIES = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("target", T.DoubleType()),
])

COVARIATE = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("feat_index", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

NESTED = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("start", T.TimestampNTZType()),
    T.StructField("target", T.ArrayType(T.DoubleType())),
    T.StructField("cat", T.ArrayType(T.IntegerType())),
    T.StructField("dynamic_feat", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

FORECAST = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("quantile", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

SAMPLES = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("sample_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

# The quantile document a batch-scoring job writes: {"quantiles": {"0.5": [...]}}.
FORECAST_DOCUMENT = "quantiles MAP<STRING, ARRAY<DOUBLE>>, mean ARRAY<DOUBLE>"

FORECAST_COLUMNS = [f.name for f in FORECAST.fields]


@dataclass(frozen=True)
class Preset:
    """Forecast parameters.  Both presets come from the workload being matched."""

    freq: str = "1 hour"
    horizon: int = 72
    context_length: int = 168
    season_length: int = 24
    quantiles: tuple = (0.1, 0.5, 0.9)
    target_quantile: float = 0.7
    num_samples: int = 100
    extra: dict = field(default_factory=dict)


# Fixed values of the workload: the notebook run (hourly, 3 days ahead, one week of
# context, quantiles 0.1/0.5/0.9, scored at the 0.7 quantile, 100 sample paths) and
# the scheduled run (hourly, 7 days ahead, four weeks of context).
NOTEBOOK = Preset(freq="1 hour", horizon=72, context_length=168)
SCHEDULED = Preset(freq="1 hour", horizon=168, context_length=672)
