"""Incremental ingest (R1): process only the files that landed since the last run.

The workload reruns its pipeline when a new export lands.  Here a Structured Streaming
file source with ``trigger(availableNow=True)`` reads every not-yet-seen file once,
hands each micro-batch to ``on_batch`` (``foreachBatch``), records progress in a
checkpoint, and stops.  A second run sees only the files added in between; a run that
dies mid-way resumes from the checkpoint.

The checkpoint lives under the shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.time import bucket
from tidecast.session import checkpoint_root


def stream_series_csv(spark: SparkSession, src: str, schema: str, ts: str = "datetime",
                      value: str = "value", item: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming SERIES frame over CSV files landing in ``src`` (header row, fixed schema)."""
    r = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.csv(src)
    item_col = F.col(item).cast("string") if item else F.lit("0")
    return df.select(item_col.alias("item_id"), F.col(ts).cast("timestamp_ntz").alias("ts"),
                     F.col(value).cast("double").alias("target"))


def ingest_available(spark: SparkSession, stream: DataFrame, name: str,
                     on_batch: Callable[[DataFrame, int], None],
                     checkpoint: str | None = None) -> int:
    """Run ``on_batch`` over everything new in ``stream`` once; returns batches run."""
    ck = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"
    seen = []

    def handle(batch: DataFrame, epoch: int) -> None:
        seen.append(epoch)
        on_batch(batch, epoch)

    q = (stream.writeStream.foreachBatch(handle)
               .option("checkpointLocation", ck)
               .trigger(availableNow=True)
               .queryName(name)
               .start())
    q.awaitTermination()
    return len(seen)


def append_to_table(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that appends each batch to a table folder, idempotently
    per batch id (a replayed batch overwrites its own ``batch_id=`` partition)."""
    def run(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("batch_id", F.lit(epoch))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").format(fmt).save(path))
    return run


def state_folder(spark: SparkSession, name: str, state: str | None = None) -> str:
    """Folder of a stream's progress and tables: below ``state``, or below the shared
    ``spark.checkpoint.dir``; a session that has neither is refused."""
    return f"{(state or checkpoint_root(spark)).rstrip('/')}/tidecast-ingest/{name}"


class ReplacedFileError(RuntimeError):
    """A file that was ingested before has changed since."""


def check_unchanged(spark: SparkSession, folder: str, table: str, known: str) -> None:
    """Fails if one of the files recorded in ``known`` has another time or size now, whose old rows
    are already in the totals."""
    now = (spark.read.parquet(f"{folder}/{table}*.parquet")
           .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_size").alias("size")).distinct())
    if _exists(spark, known):
        old = spark.read.parquet(known).select("path", F.col("changed").alias("was"), F.col("size").alias("was_size"))
        differs = now.join(old, "path").filter((F.col("changed") != F.col("was")) | (F.col("size") != F.col("was_size")))
        row = differs.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first")).first()
        if row["n"]:
            raise ReplacedFileError(f"{row['n']} ingested files were replaced, the first is {row['first']}; ingest into a new state folder")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stream_parquet_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Streaming read of ``<folder>/<table>*.parquet`` (new files are picked up as they land)."""
    schema = spark.read.parquet(f"{folder}/{table}*.parquet").schema
    return spark.readStream.schema(schema).option("basePath", folder).parquet(f"{folder}/{table}*.parquet")


def cells_batch_writer(path: str, freq: str, item: str, ts: str, value: str, scale: int | None = None):
    """``foreachBatch`` handler: sum each micro-batch into ``(item, cell)`` totals and write
    them under ``batch_id=<epoch>`` (a replayed batch overwrites only itself).  ``scale``:
    decimals of money values, whose sums are then exact."""
    def run(batch: DataFrame, epoch: int) -> None:
        append_to_table(path)(partial_cells(batch, freq, item, ts, value, scale), epoch)
    return run


def partial_cells(rows: DataFrame, freq: str, item: str, ts: str, value: str, scale: int | None = None, *by: str) -> DataFrame:
    """``item_id, ts, total`` of the rows, and of each of ``by``."""
    v = F.col(value).cast("double") if scale is None else F.col(value).cast(f"decimal(18,{scale})")
    return rows.groupBy(*by, F.col(item).cast("string").alias("item_id"), bucket(ts, freq).alias("ts")).agg(F.sum(v).alias("total"))


def merged_cells(parts: DataFrame) -> DataFrame:
    return parts.groupBy("item_id", "ts").agg(F.sum("total").cast("double").alias("target"))


def cells_by_file(spark: SparkSession, folder: str, table: str, freq: str = "1 hour", item: str = "event_type",
                  ts: str = "ts", value: str = "value", scale: int | None = None) -> DataFrame:
    """What :func:`ingest_cells` leaves after all files have arrived, in one plan without any
    state: cells per file, merged over the files."""
    rows = spark.read.parquet(f"{folder}/{table}.parquet").withColumn("_file", F.col("_metadata.file_path"))
    return merged_cells(partial_cells(rows, freq, item, ts, value, scale, "_file"))


def ingest_cells(spark: SparkSession, folder: str, table: str, name: str, freq: str = "1 hour",
                 item: str = "event_type", ts: str = "ts", value: str = "value", scale: int | None = None,
                 state: str | None = None) -> DataFrame:
    """R1 end to end: ingest whatever is new in ``folder/table*``, append its cells, and
    return the whole cell table (cells summed over every batch so far).

    A file that changed after it was ingested fails the run (its old rows are in the totals).
    """
    base = state_folder(spark, name, state)
    check_unchanged(spark, folder, table, f"{base}/files")
    version = {"path": F.col("_metadata.file_path"), "changed": F.col("_metadata.file_modification_time"), "size": F.col("_metadata.file_size")}
    stream = stream_parquet_table(spark, folder, table).withColumns(version)
    cells = cells_batch_writer(f"{base}/table", freq, item, ts, value, scale)

    def handle(batch: DataFrame, epoch: int) -> None:
        cells(batch, epoch)
        # the files that this batch read, not those listed before it: one that lands meanwhile is
        # recorded with the batch that reads it; a batch that runs again records the same again
        batch.select(*version).distinct().write.mode("overwrite").parquet(f"{base}/files/batch_id={epoch}")

    ingest_available(spark, stream, name, handle, f"{base}/checkpoint")
    return merged_cells(spark.read.parquet(f"{base}/table"))
