"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings every tidecast job relies on.  Timestamps are TIMESTAMP_NTZ throughout, and
# the few places that go through epoch microseconds assume the session zone is UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "tidecast",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the tidecast defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides.  The UI is off:
    jobs here are batch jobs and no port beyond Spark's own is opened.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; a job never invents a machine-local one.  Tests that run
    without it set it themselves before calling.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared (cluster-visible) folder")
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


def materialize(df: DataFrame, name: str = "stage", mode: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once and cut its lineage, so every later branch reads the stored
    result instead of re-scanning the source, and a lost executor does not replay it.

    ``persist`` keeps it in executor memory/disk (blocks lost with an executor are
    recomputed from lineage — right for a small intermediate reused within one job);
    ``checkpoint`` uses reliable ``DataFrame.checkpoint`` into the shared folder;
    ``parquet`` writes a named table under ``<checkpoint dir>/tables/<name>`` and reads
    it back (useful when another job reads the stage output too).  Both need
    ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    if mode == "persist":
        from pyspark import StorageLevel
        # lazy: the first action fills it; every later reader — in the same plan or
        # not — scans the stored blocks instead of the source
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    root = ensure_checkpoint_dir(spark)
    if mode == "checkpoint":
        return df.checkpoint(eager=True)
    path = os.path.join(root, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
