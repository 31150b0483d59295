"""Series sets derived from the driver tables (``/root/testdata/sf*/<table>.parquet``).

Each loader reads only the columns it needs (Catalyst prunes the Parquet scan) and
aggregates events into grid cells with a partial aggregate before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.series import aggregate_cells, regularise


#: Decimals of the values in the tables.
MONEY_SCALE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_series(spark: SparkSession, sf_dir: str, item: str = "event_type") -> DataFrame:
    """Raw event rows as a series frame: ``item_id`` = ``item`` column, ``target`` = value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col(item).cast("string").alias("item_id"), "ts", F.col("value").alias("target"))


def events_cells(spark: SparkSession, sf_dir: str, freq: str = "1 hour",
                 item: str = "event_type") -> DataFrame:
    """Events summed per item and ``freq`` cell; cells without events are absent."""
    return aggregate_cells(events_as_series(spark, sf_dir, item), freq, "exact_sum", MONEY_SCALE)


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default series set: hourly sum of ``value`` per ``event_type`` on the overall
    hourly grid, empty hours = 0."""
    return regularise(events_cells(spark, sf_dir, "1 hour"), "1 hour", fill=0.0, span="global")


def events_user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-series set: daily sum of ``value`` per ``user_id`` on the overall daily grid."""
    cells = events_cells(spark, sf_dir, "1 day", item="user_id")
    return regularise(cells, "1 day", fill=0.0, span="global")


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-history set: daily sum of ``o_totalprice`` per ``o_orderpriority``."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("item_id"), F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("target"))
    return regularise(aggregate_cells(o, "1 day", "exact_sum", MONEY_SCALE), "1 day", fill=0.0, span="series")


def lineitem_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sum of ``l_quantity`` per ``l_returnflag``."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("item_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("target"))
    return regularise(aggregate_cells(li, "1 day", "exact_sum", MONEY_SCALE), "1 day", fill=0.0, span="series")
