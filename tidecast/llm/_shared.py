"""Shared-folder tables, bounded chunks of text and rolling hashes used by the operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root

CHUNK_BYTES = 2_000_000     # text bytes that a task holds as arrays at one time
BATCH_BYTES = str(8 << 20)  # most bytes of an Arrow batch sent to Python
BATCH_ROWS = "4000"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes too, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # workers import this package: from where the driver has it, or from --py-files
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (PACKAGE_ROOT, env.get("PYTHONPATH"))))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below ``spark.checkpoint.dir``; a local session that has
    none (a test) uses its warehouse folder, a cluster must name one."""
    try:
        root = checkpoint_root(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "llm-work")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage,
    so a lost executor costs no earlier stage, and lets Spark drop the shuffle files
    behind it."""
    path = shared_dir(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; Spark drops the shuffle files of this execution at its end
    instead of whenever the driver collects its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def arrow_schema(spark: SparkSession, fields: str) -> pa.Schema:
    """The Arrow schema that Spark uses for the given columns."""
    return spark.createDataFrame([], fields).toArrow().schema


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a folder that every executor can reach."""
    from pyarrow import fs
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def put_file(folder: str, name: str, write) -> None:
    """Write one file under a name of its own attempt, then move it into place: a task that
    runs twice replaces the file by an equal one and a lost task leaves no half file."""
    f, path = filesystem(folder)
    f.create_dir(path, recursive=True)
    part = f"{path}/_{name}.{uuid.uuid4().hex}"
    with f.open_output_stream(part) as out:
        write(out)
    f.move(part, f"{path}/{name}")


# ---------------------------------------------------------------- text as bytes

def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary Arrow column without a copy; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, data


def chunks(column, size: int = CHUNK_BYTES):
    """Yield (first row, last row + 1, offsets from 0, bytes) with at most ``size`` bytes
    each, or one row if it is longer."""
    if not len(column):
        return
    off, data = buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1))
        yield i, j, off[i:j + 1] - off[i], data[off[i]:off[j]]
        i = j


def spans_of(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``mask``; a run never crosses a row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    inner = off[:-1][off[:-1] < len(mask)]
    before[inner] = False
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    after[inner[inner > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


# ---------------------------------------------------------------- rolling hashes

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {}
BYTE_VALUE = np.random.RandomState(20240229).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS.get("n", -1) < n:
        m = max(n, CHUNK_BYTES) + 1
        up = np.full(m, _BASE)
        down = np.full(m, _INVERSE)
        up[0] = down[0] = 1
        _POWERS.update(n=m - 1, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"], _POWERS["down"]


def inverse_powers(n: int) -> np.ndarray:
    return _powers(n)[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash (an invertible finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of an odd base, modulo 2^64."""
    up, _ = _powers(len(values))
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] whatever its place, from ``prefix``; the length counts too."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.BinaryArray:
    """data[start:end] of each span as bytes, in one copy."""
    size = end - start
    before = np.cumsum(size) - size
    at = np.repeat(start - before, size) + np.arange(int(size.sum()))
    bounds = np.append(before, size.sum()) * data.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
