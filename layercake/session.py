"""Session helpers: a local session for tests/bench and a shared scratch area.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it and refuses to work without it. A local
directory is used only where that setting is absent and the master is
``local`` (tests, laptops).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "layercake") -> SparkSession:
    """Session for tests and the local bench: UI off, AQE on, UTC."""
    warehouse = tempfile.mkdtemp(prefix="layercake-warehouse-")
    atexit.register(shutil.rmtree, warehouse, ignore_errors=True)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", warehouse)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where
    neither is set, a session with a ``local`` master gets a private temp folder,
    removed when the process ends; any other session raises, because executors
    would each write to a disk of their own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="layercake-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/layercake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder, in the application's own part of it."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote to its scratch area."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[SparkSession]:
    """``with scratch_area(spark): ...`` removes the run's intermediates at its end (results must be stored elsewhere by then)."""
    try:
        yield spark
    finally:
        clear_scratch(spark)


def materialize(df, name: str = "materialized"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back. This cuts lineage (a lost executor recomputes nothing upstream) and
    fixes nondeterministic parts of a plan (sampled range bounds, partition
    ids) for every later reader, in one columnar pass.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
