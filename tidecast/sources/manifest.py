"""Versioned output with a manifest (K2, K4): nothing is renamed and nothing is overwritten.

A publication writes its rows into a folder of its own and then creates one small file,
``<target>/_manifest/<number>``, that names the folder.  Creating that file is the only step that
changes what readers see; it fails if another writer has taken the number, and a file that is not
complete does not count.  So a publication that ends at any point leaves either the old version or
the new one readable, and a reader that has resolved a version keeps reading it until it expires.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_END = "end"


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def entries(spark: SparkSession, target: str) -> list[tuple[int, dict]]:
    """The complete manifests, newest first."""
    out = []
    for name in reversed(children(spark, f"{target}/_manifest")):
        if name.isdigit() and (entry := _read(spark, f"{target}/_manifest/{name}")) is not None:
            out.append((int(name), entry))
    return out


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, p = file_system(spark, path)
    source = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    body, _, end = text.rpartition("\n")
    return json.loads(body) if end == _END else None


def commit(spark: SparkSession, target: str, entry: dict) -> int:
    """Make ``entry`` the newest manifest; its number."""
    taken = [int(n) for n in children(spark, f"{target}/_manifest") if n.isdigit()]
    number = max(taken, default=0) + 1
    while True:
        fs, p = file_system(spark, f"{target}/_manifest/{number:010d}")
        try:
            out = fs.create(p, False)       # fails if it exists: another writer was faster
        except Exception:
            if not fs.exists(p):
                raise
            number += 1
            continue
        try:
            out.write(bytearray(f"{json.dumps(entry)}\n{_END}", "utf-8"))
        finally:
            out.close()
        return number


def resolve(spark: SparkSession, target: str) -> str | None:
    """Folder of the live version, or None."""
    for _, entry in entries(spark, target):
        path = f"{target}/{entry['folder']}"
        fs, p = file_system(spark, path)
        if fs.exists(p):
            return path
    return None


def publish(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite", keep: int = 2,
            options: dict | None = None, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of ``target`` and return its folder.

    mode: ``overwrite``, ``ignore`` (an existing live version stays) or ``error``.  The newest
    ``keep`` versions stay on disk for readers that have resolved them.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    if mode != "overwrite" and (live := resolve(spark, target)) is not None:
        if mode == "ignore":
            return live
        raise FileExistsError(target)
    folder = f"version-{uuid.uuid4().hex}"
    writer = df.write.format(fmt).options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{target}/{folder}")
    commit(spark, target, {"folder": folder, "format": fmt})
    expire(spark, target, keep)
    return f"{target}/{folder}"


def read(spark: SparkSession, target: str, **options) -> DataFrame:
    """The live version of ``target``."""
    for _, entry in entries(spark, target.rstrip("/")):
        path = f"{target.rstrip('/')}/{entry['folder']}"
        fs, p = file_system(spark, path)
        if fs.exists(p):
            return spark.read.format(entry["format"]).options(**options).load(path)
    raise FileNotFoundError(f"{target} has no published version")


def expire(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete the versions behind the newest ``keep``: first what they name, then the manifest, so
    that a version that is named is whole.  Folders of publications that never ended stay until
    :func:`sweep`."""
    gone = []
    for number, entry in entries(spark, target)[keep:]:
        for path in (f"{target}/{entry['folder']}", f"{target}/_manifest/{number:010d}"):
            fs, p = file_system(spark, path)
            if fs.exists(p) and fs.delete(p, True):
                gone.append(path)
    return gone


def sweep(spark: SparkSession, target: str) -> list[str]:
    """Delete the folders that no manifest names; call it when no publication is running."""
    named = {e["folder"] for _, e in entries(spark, target)}
    gone = []
    for name in children(spark, target):
        if name.startswith("version-") and name not in named:
            fs, p = file_system(spark, f"{target}/{name}")
            fs.delete(p, True)
            gone.append(f"{target}/{name}")
    return gone
