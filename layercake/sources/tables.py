"""Catalog tables by name (S5, S7) and batch release into a landing folder (M4)."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.operators.batches import BATCH_ID
from layercake.sources.sinks import LOSSLESS_CSV, read_batches
from layercake.sources.versioned import exclusive_write, exists, list_names, read_text

def load_tables(spark: SparkSession, names: Iterable[str], database: str | None = None) -> dict[str, DataFrame | None]:
    """``{name: DataFrame}`` for existing tables and ``None`` for missing ones,
    which ``quality_report`` turns into a failing ``table_exists`` check."""
    out: dict[str, DataFrame | None] = {}
    for name in names:
        full = f"{database}.{name}" if database else name
        out[name] = spark.table(full) if spark.catalog.tableExists(full) else None
    return out


def _claim(spark: SparkSession, log_path: str, batch: int, owner: str, stale_after: float) -> bool:
    """Take a batch: one releaser creates the claim's file, all others fail. A claim without an end that is older than
    ``stale_after`` seconds (its releaser died) is taken over by the next numbered one, again by one releaser only."""
    names = [n for n in list_names(spark, log_path) if n.startswith(f"claim-{batch}-")]
    last = max((int(n.rsplit("-", 1)[1]) for n in names), default=0)
    if last:
        held = json.loads(read_text(spark, f"{log_path}/claim-{batch}-{last}"))
        if held["owner"] == owner:
            return True
        if time.time() - held["at"] < stale_after:
            return False
    return exclusive_write(spark, f"{log_path}/claim-{batch}-{last + 1}", json.dumps({"owner": owner, "at": time.time()}))


def _land(spark: SparkSession, batches_path: str, target: str, batch: int) -> None:
    """Write a batch beside its folder and move it there whole: a reader of the landing folder sees all of its files or none."""
    if exists(spark, f"{target}/_SUCCESS"):
        return  # landed by a releaser that died before it said so
    parent, name = target.rsplit("/", 1)
    staged = f"{parent}/_staging-{name}-{uuid.uuid4().hex}"
    rows = read_batches(spark, batches_path).filter(F.col(BATCH_ID) == batch).drop(BATCH_ID)  # reads one folder
    rows.write.options(**LOSSLESS_CSV).csv(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(target)) or not fs.rename(path(staged), path(target)):
        fs.delete(path(staged), True)
        if not exists(spark, f"{target}/_SUCCESS"):
            raise RuntimeError(f"{target} exists without being complete")


def release_batch(
    spark: SparkSession,
    batches_path: str,
    landing_path: str,
    log_path: str,
    batch_id: int | None = None,
    owner: str | None = None,
    stale_after: float = 3600.0,
) -> int | None:
    """Bring the rows of one exported batch (see ``write_batches``) to the
    landing folder as header CSV (``LOSSLESS_CSV``: read it with the same
    options to get the same text back) and record it in the release log.
    Files are as large as the batch's stored partitions.

    Without ``batch_id`` the smallest batch that is neither released nor being released is
    taken; ``None`` is returned when there is none. Asking for a batch that was already
    released, or that another releaser holds, raises. The log is
    per landing target, so each source's release is checked on its own.

    Any number of releasers may run at once: a batch belongs to the one that creates its claim file. ``owner``
    (by default a new one each call) may go on with its own claim after a lost job; others may
    after ``stale_after`` seconds. A batch appears in its folder ``<landing>/batch_id=<n>`` in one move
    and is never written again. Errors of the store are raised, not read as "not released".
    """
    owner = owner or uuid.uuid4().hex
    ids = sorted(r[0] for r in spark.read.parquet(f"{batches_path}/manifest").select(F.col(BATCH_ID).cast("int")).collect())  # a number a batch
    released = {int(n[5:]) for n in list_names(spark, log_path) if n.startswith("done-")}
    if batch_id is not None and (batch_id not in ids or batch_id in released):
        raise ValueError(f"Batch {batch_id} was already released or does not exist")
    for batch in [batch_id] if batch_id is not None else [i for i in ids if i not in released]:
        if not _claim(spark, log_path, batch, owner, stale_after):
            continue
        if exists(spark, f"{log_path}/done-{batch}"):
            continue  # released between the listing and the claim
        _land(spark, batches_path, f"{landing_path.rstrip('/')}/{BATCH_ID}={batch}", batch)
        if exclusive_write(spark, f"{log_path}/done-{batch}", json.dumps({BATCH_ID: batch, "owner": owner, "at": time.time()})):
            return batch
    if batch_id is not None:
        raise ValueError(f"Batch {batch_id} is being released by another releaser")
    return None


def release_log(spark: SparkSession, log_path: str) -> DataFrame:
    """``(batch_id, owner, released_at)`` of the released batches."""
    schema = f"{BATCH_ID} int, owner string, released_at timestamp"
    done = [json.loads(read_text(spark, f"{log_path}/{n}")) for n in list_names(spark, log_path) if n.startswith("done-")]
    return spark.createDataFrame([(d[BATCH_ID], d["owner"], dt.datetime.fromtimestamp(d["at"])) for d in done], schema)
