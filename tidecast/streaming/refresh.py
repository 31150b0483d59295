"""Refresh forecasts as files land (R1): versioned contributions, merged moments, only the series
that changed are scored again.

State, below the stream's folder:

``parts``      per file version the totals of its cells (``path, changed, size, item_id, ts, total``)
``moments``    per file version the moments of its cells (see :mod:`tidecast.operators.models.moments`)
``files``      the file versions read, recorded with the batch that read them
``forecasts``  FORECAST rows per refresh, of the series touched by it
``scored``     which series each refresh scored

A run reads the files that are new (a file stream) and those that changed since they were read; a
changed file is a new version, and only the newest version of a path counts, so the old one is
retracted.  Every batch writes its own folders, named by the batch, so a batch that runs again replaces
itself.  After ``compact_after`` batches the live rows are written together; the manifest that names
that folder and the ones it replaces is the commit, and until it is there readers use the old ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.models import moments as MO
from tidecast.sources import manifest
from tidecast.streaming import ingest

_VERSION = ("path", "changed", "size")


@dataclass(frozen=True)
class RefreshSpec:
    freq: str = "1 hour"
    item: str = "event_type"
    ts: str = "ts"
    value: str = "value"
    scale: int | None = None            # decimals of money values, summed exactly
    horizon: int = 72
    quantiles: Sequence[float] = (0.1, 0.5, 0.9)
    model: str = "refresh"
    compact_after: int = 50


def forecast_by_parts(rows: DataFrame, part: str, spec: RefreshSpec = RefreshSpec()) -> DataFrame:
    """What refreshing leaves when the contributions named by the column ``part`` of the raw ``rows``
    have all arrived, in one plan without state: cells and moments per contribution, merged."""
    cells = ingest.partial_cells(rows, spec.freq, spec.item, spec.ts, spec.value, spec.scale, part)
    merged = MO.merge(MO.contributions(cells, [part]))
    return MO.forecast(MO.fit(merged, ingest.merged_cells(cells), spec.freq), spec.horizon, spec.freq, spec.quantiles, spec.model)


# ---------------------------------------------------------------- state

class RefreshState:
    """The tables of one stream's state."""

    TABLES = ("parts", "moments", "files")

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def _folders(self, table: str) -> list[str]:
        return [n for n in manifest.children(self.spark, f"{self.base}/{table}") if n.startswith("batch=")]

    def _compaction(self) -> dict:
        found = manifest.entries(self.spark, f"{self.base}/compactions")
        return found[0][1] if found else {"folder": None, "replaced": []}

    def live_folders(self, table: str) -> list[str]:
        """Folders of the batches that count: not those a compaction replaced, and of the
        compactions only the one that the newest manifest names."""
        last = self._compaction()
        return [n for n in self._folders(table) if n not in last["replaced"] and (not n.startswith("batch=c") or n == last["folder"])]

    def read(self, table: str) -> DataFrame | None:
        paths = [f"{self.base}/{table}/{n}" for n in self.live_folders(table)]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, table: str, batch: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.base}/{table}/batch={batch}")

    def live(self, table: str) -> DataFrame | None:
        """Rows of the newest version of each path."""
        rows, files = self.read(table), self.read("files")
        if rows is None or files is None:
            return None
        newest = files.groupBy("path").agg(F.max(F.struct("changed", "size")).alias("v")).select("path", "v.changed", "v.size")
        return rows.join(newest, list(_VERSION))

    def add(self, batch: str, rows: DataFrame, spec: RefreshSpec) -> None:
        """The contributions of raw rows with their file's ``path, changed, size``: cells first, the
        record of the files last, so that a file on record has all its rows."""
        self.write("parts", batch, ingest.partial_cells(rows, spec.freq, spec.item, spec.ts, spec.value, spec.scale, *_VERSION))
        parts = self.spark.read.parquet(f"{self.base}/parts/batch={batch}")
        self.write("moments", batch, MO.contributions(parts, _VERSION))
        self.write("files", batch, rows.select(*_VERSION).distinct())

    def compact(self) -> bool:
        """Write the live rows of all batches into one folder and commit it by a manifest; what it
        replaces is deleted after that."""
        replaced = sorted(set().union(*(self.live_folders(t) for t in self.TABLES)))
        folder = f"batch=c{uuid.uuid4().hex}"
        if len(replaced) < 2:
            return False
        for table in self.TABLES:
            self.live(table).select(*self.read(table).columns).write.parquet(f"{self.base}/{table}/{folder}")
        old = self._compaction()["replaced"]
        manifest.commit(self.spark, f"{self.base}/compactions", {"folder": folder, "replaced": sorted({*old, *replaced})})
        self.sweep()
        return True

    def sweep(self) -> None:
        """Delete the folders that the newest compaction replaced."""
        for table in self.TABLES:
            for name in self._folders(table):
                if name in self._compaction()["replaced"]:
                    fs, p = manifest.file_system(self.spark, f"{self.base}/{table}/{name}")
                    fs.delete(p, True)


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"path": F.col("_metadata.file_path"), "changed": F.col("_metadata.file_modification_time"), "size": F.col("_metadata.file_size")})


def replaced_files(spark: SparkSession, state: RefreshState, folder: str, table: str) -> list[str]:
    """Paths on record whose file has another time or size now (names only; Spark's driver lists the
    files of a read anyway)."""
    files = state.read("files")
    if files is None:
        return []
    now = _with_file(spark.read.parquet(f"{folder}/{table}*.parquet")).select(*_VERSION).distinct()
    known = now.join(files.select("path").distinct(), "path", "left_semi")
    row = known.join(files, list(_VERSION), "left_anti").agg(F.array_sort(F.collect_set("path")).alias("paths")).first()
    return list(row["paths"])


def refresh(spark: SparkSession, folder: str, table: str, name: str, spec: RefreshSpec = RefreshSpec(),
            state: str | None = None) -> DataFrame:
    """Take in what is new or changed in ``folder/table*.parquet``, score the series it touches again,
    and return the newest forecast of every series."""
    base = ingest.state_folder(spark, name, state)
    st = RefreshState(spark, base)
    number = len([n for n in manifest.children(spark, f"{base}/scored_files") if n.startswith("refresh=")])
    replaced = replaced_files(spark, st, folder, table)
    schema = spark.read.parquet(f"{folder}/{table}*.parquet").schema
    stream = _with_file(spark.readStream.schema(schema).option("basePath", folder).parquet(f"{folder}/{table}*.parquet"))
    ingest.ingest_available(spark, stream, name, lambda batch, epoch: st.add(f"s{epoch:08d}", batch, spec), f"{base}/checkpoint")
    if replaced:
        st.add(f"r{number:08d}", _with_file(spark.read.parquet(*replaced)), spec)
    _score(spark, st, base, number, spec)
    if len(st.live_folders("parts")) > spec.compact_after:
        st.compact()
    return newest_forecasts(spark, base)


def _score(spark: SparkSession, st: RefreshState, base: str, number: int, spec: RefreshSpec) -> None:
    """Score the series of the file versions that no refresh has scored yet; of a changed file also
    those that only its old version had (they may have no readings, hence no forecast, any more)."""
    files = st.read("files")
    if files is None:
        return
    if "scored_files" in manifest.children(spark, base):
        files = files.join(spark.read.parquet(f"{base}/scored_files").drop("refresh"), list(_VERSION), "left_anti")
    touched = st.read("parts").join(files.select("path").distinct(), "path", "left_semi").select("item_id").distinct()
    if touched.isEmpty():
        return
    merged = MO.merge(st.live("moments").join(touched, "item_id", "left_semi"))
    cells = ingest.merged_cells(st.live("parts").join(touched, "item_id", "left_semi"))
    rows = MO.forecast(MO.fit(merged, cells, spec.freq), spec.horizon, spec.freq, spec.quantiles, spec.model)
    # the record of what was scored comes last: a run that ends before it scores the same again
    rows.write.mode("overwrite").parquet(f"{base}/forecasts/refresh={number}")
    touched.write.mode("overwrite").parquet(f"{base}/scored/refresh={number}")
    files.select(*_VERSION).write.mode("overwrite").parquet(f"{base}/scored_files/refresh={number}")


def newest_forecasts(spark: SparkSession, base: str) -> DataFrame:
    """Each series' rows of the last refresh that scored it."""
    last = spark.read.parquet(f"{base}/scored").groupBy("item_id").agg(F.max("refresh").alias("refresh"))
    return spark.read.parquet(f"{base}/forecasts").join(last, ["item_id", "refresh"]).drop("refresh")
