"""Helpers shared by the operators of this package."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.session import scratch_path

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+`` (fixed values).
SPACES = " \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, unless their path has it anyway; once a session."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    path = os.path.join(tempfile.mkdtemp(prefix="layercake-ship-"), "layercake-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "layercake")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(path)


_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def fold_of(doc_id, n: int = 5) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def slices(batches, column: str, chars: int = 4_000_000):
    """Record batches cut so that one slice holds about ``chars`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        step = max(1, chars // per_row)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def strings(column) -> list[str]:
    """Python strings of an Arrow column, null as ''."""
    return [x or "" for x in column.to_pylist()]


def labelled_ids(labels: DataFrame, label: str, bound: int, doc_id: str = "doc_id") -> DataFrame:
    """One row per labelled document, ``(doc_id, label)``: the ``bound`` ids that come first in hash order.

    Rows with a null id or label take no part; of repeated ids the smallest
    label counts. The bound keeps the result broadcastable (two numbers a row).
    """
    one = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def local_rows(df: DataFrame) -> DataFrame:
    """A bounded frame, computed once and held as literal rows."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def keep_where(df: DataFrame, kept: Column) -> DataFrame:
    """Filter by a condition on computed columns, after they are computed.

    A plain filter would be pushed below them, with every use of a column
    replaced by its whole expression, inside lambdas once for each element.
    """
    return df.withColumns({"__kept": kept, "__barrier": F.monotonically_increasing_id()}).where("__kept and __barrier >= 0").drop("__kept", "__barrier")


# --- arrays in the shared folder, memory-mapped by the workers ----------------------------------------------------


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder under the session's shared checkpoint folder."""
    return scratch_path(spark, name)


def _filesystem(uri: str):
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write one .npy file; written under another name and then moved, so a retried or speculative task never leaves half a file."""
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(array))
    with fs.open_output_stream(part) as out:
        out.write(head.getvalue())
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
    fs.move(part, f"{path}/{name}.npy")


@lru_cache(maxsize=4096)
def open_array(folder: str, name: str) -> np.ndarray:
    """Memory-map an array of the shared folder; a store that is not mounted is first copied to the worker's own temp folder."""
    fs, path = _filesystem(f"{folder}/{name}.npy")
    if not isinstance(fs, pafs.LocalFileSystem):
        near = os.path.join(tempfile.mkdtemp(prefix="layercake-map-"), f"{name}.npy")
        pafs.copy_files(path, near, source_filesystem=fs, destination_filesystem=pafs.LocalFileSystem())
        path = near
    with open(path, "rb") as f:
        np.lib.format.read_magic(f)
        shape, _, dtype = np.lib.format.read_array_header_1_0(f)
    return np.load(path, mmap_mode="r") if shape[0] else np.zeros(shape, dtype)


def blob_schema() -> str:
    return "shard int, kind int, data binary"


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, b, c = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], ["shard", "kind", "data"])
