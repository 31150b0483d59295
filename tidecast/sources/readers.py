"""Sources (S1–S9): catalog tables, JDBC, CSV, JSON-lines series, forecast documents.

All readers take explicit schemas (inference only behind ``infer=True``) and return
lazy DataFrames, so Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.time import add_steps
from tidecast.operators.series import to_series

# JSON-lines series record as written by the dataset stage / read by the notebook.
SERIES_JSON_SCHEMA = ("id STRING, item_id STRING, start STRING, target ARRAY<DOUBLE>, "
                      "cat ARRAY<INT>, dynamic_feat ARRAY<ARRAY<DOUBLE>>, "
                      "feat_static_cat ARRAY<INT>, feat_dynamic_real ARRAY<ARRAY<DOUBLE>>")


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A named table of a named database from the session catalog."""
    return spark.table(f"{database}.{table}")


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, custom_schema: str | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a parallel JDBC scan: ``num_partitions`` range queries on
    ``partition_column`` between ``lower`` and ``upper`` (one task per range)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for k, v in (("user", user), ("password", password), ("driver", driver),
                 ("customSchema", custom_schema)):
        if v is not None:
            opts[k] = v
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned JDBC scan needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """JDBC scan (credentials come in as options, never from a secret client)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


def with_overrides(df: DataFrame, overrides: dict[str, str] | None) -> DataFrame:
    """S3: manual type overrides after discovery: ``{"col": "double", …}``."""
    if not overrides:
        return df
    return df.withColumns({c: F.col(c).cast(t) for c, t in overrides.items()})


def read_csv(spark: SparkSession, path: str, schema: str | None = None, infer: bool = False,
             overrides: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header row; columns by name."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return with_overrides(r.csv(path), overrides)


def read_series_csv(spark: SparkSession, path: str, ts: str = "datetime", value: str | None = None,
                    item_id: str | None = None, schema: str | None = None) -> DataFrame:
    """CSV → SERIES (time column as key, first other column as value by default).  Without
    a schema columns are read as text and cast, so that the file is read once."""
    df = read_csv(spark, path, schema=schema)
    return to_series(df, ts, value, item_id)


def read_series_json(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """JSON-lines series records → NESTED (canonical names, NaN → NULL).

    ``"NaN"`` strings and bare ``NaN`` both parse as NaN and become NULL.  A dataset
    laid out in ``period=<name>`` folders is filtered on that partition column, so
    only the chosen variant's files are read.  A record without an id is named by its file
    and a number, so that no two records of one read share a name (another read may number anew).
    """
    df = spark.read.schema(SERIES_JSON_SCHEMA + (", period STRING" if period is not None else "")).json(path)
    if period is not None:
        df = df.filter(F.col("period") == period)
    return series_records(df, _record_name())


def parse_series_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from a text column holding one record per row."""
    df = lines.select(F.from_json(column, SERIES_JSON_SCHEMA).alias("r")).select("r.*")
    return series_records(df, F.lit(None).cast("string"))


def series_records(df: DataFrame, unnamed: Column) -> DataFrame:
    """Parsed records with canonical names, NaN as NULL; ``unnamed`` names those without an id."""
    item = F.coalesce(F.col("item_id"), F.col("id"), unnamed)
    clean = F.transform("target", lambda x: F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x))
    return df.select(item.alias("item_id"),
                     F.col("start").cast("timestamp_ntz").alias("start"),
                     clean.alias("target"),
                     F.coalesce("cat", "feat_static_cat").alias("cat"),
                     F.coalesce("dynamic_feat", "feat_dynamic_real").alias("dynamic_feat"))


def _record_name():
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return F.concat_ws("#", name, F.monotonically_increasing_id().cast("string"))


def read_forecast_json(spark: SparkSession, path: str, quantile: str = "0.5",
                       freq: str = "1 hour") -> DataFrame:
    """Forecast documents ``{"item_id"?, "start"?, "quantiles": {"0.5": [...]}, …}``,
    one per line → ``(item_id, step, ts, value)`` for the chosen quantile key
    (``ts`` is NULL when a document carries no start, ``model`` when it names none)."""
    return document_rows(spark.read.schema(DOCUMENT_SCHEMA).json(path), _record_name(), quantile, freq)


DOCUMENT_SCHEMA = "model STRING, item_id STRING, start STRING, quantiles MAP<STRING, ARRAY<DOUBLE>>, mean ARRAY<DOUBLE>"


def parse_forecast_documents(lines: DataFrame, quantile: str = "0.5", freq: str = "1 hour", column: str = "value") -> DataFrame:
    """The same from a text column holding one document per row."""
    df = lines.select(F.from_json(column, DOCUMENT_SCHEMA).alias("r")).select("r.*")
    return document_rows(df, F.lit(None).cast("string"), quantile, freq)


def document_rows(df: DataFrame, unnamed: Column, quantile: str, freq: str) -> DataFrame:
    return (df.select("model", F.coalesce("item_id", unnamed).alias("item_id"),
                      F.col("start").cast("timestamp_ntz").alias("start"),
                      F.posexplode(F.col("quantiles")[quantile]).alias("pos", "value"))
              .select("model", "item_id", (F.col("pos") + 1).cast("int").alias("step"),
                      add_steps(F.col("start"), F.col("pos"), freq).alias("ts"), "value"))


def run_path(base: str, run_date: date | datetime | str, style: str = "partition") -> str:
    """Run-dated location: ``<base>/run_date=YYYY-MM-DD`` (partition style, prunable)
    or ``<base>/YYYY-MM-DD`` (plain prefix)."""
    if isinstance(run_date, (date, datetime)):
        run_date = run_date.strftime("%Y-%m-%d")
    return f"{base.rstrip('/')}/run_date={run_date}" if style == "partition" else f"{base.rstrip('/')}/{run_date}"


def load_forecaster(spark: SparkSession, path: str):
    """Load a saved global model."""
    from tidecast.operators.models.global_ar import GlobalARModel
    return GlobalARModel.load(spark, path)
