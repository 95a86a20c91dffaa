"""Spark session and shared-folder helpers.

Library code never creates machine-local scratch space on a cluster: every
intermediate that must survive executor loss goes below the folder the
cluster names in ``spark.checkpoint.dir``.  Only a local-mode session (tests,
benchmarks) that has no such setting gets one created for it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "paracorpus", shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tuned for (AQE on, UTC, Arrow)."""
    master = master or os.environ.get("PARACORPUS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PARACORPUS_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create one only for local sessions."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="paracorpus-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/paracorpus/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_scratch() -> None:
    """Delete the folders that ``scratch_path`` handed out so far.

    Call it when no frame that reads them is needed any more; it also runs when
    the driver's interpreter exits.
    """
    while _scratch:
        spark, path = _scratch.pop()
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended: nothing can be deleted through it
            return


def drop_written(df: DataFrame) -> None:
    """Delete the folders that ``scratch_path`` handed out and ``df`` scans: for a loop that
    has written the table that takes its place."""
    read = df.inputFiles()
    for spark, path in [x for x in _scratch if any(f"{x[1].split('://')[-1].lstrip('/')}/" in f for f in read)]:
        _delete(spark, path)
        _scratch.remove((spark, path))


atexit.register(release_scratch)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reads; other failures are raised."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder, and a scan of it.

    Cuts lineage like a checkpoint, and its readers prune columns and know its
    size, so Spark itself decides whether a join may broadcast it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
