"""Tables in versioned folders behind one manifest (K1, K3 without a gap for readers).

A store is a folder with ``data/`` (parquet folders that are never changed
once written) and ``manifests/`` (one small JSON file a version: for each
table its schema and the folders of each key bucket). A transaction first writes
all new data folders and then swaps the pointer: the next manifest is created
in one step, only if no other writer created it. Readers pin the newest
manifest, so they see the old tables or the new ones, never a mixture, and a
job that dies between the two phases leaves everything as it was.

Tables may be dealt into key buckets. A transaction then replaces or extends
single buckets and keeps the folders of all others, so an increment writes
what it touches. The manifest is as large as buckets times tables, both given
by the caller, not by the data.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layercake.functions.columns import c

BUCKET = "__bucket"


class PublishConflict(RuntimeError):
    """Another writer published first; nothing was changed."""


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme."""
    fs, p = _hadoop(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exclusive_write(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, only if it does not exist; whether this call created it.

    On a local or mounted disk the complete file is linked to its name; on
    HDFS it is renamed to it; both fail if the name is taken. Object stores get one
    conditional put (``create`` without overwrite).
    """
    path = qualified(spark, path)
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    near = _local(path)
    if near is not None:
        part = os.path.join(os.path.dirname(near), f".{os.path.basename(near)}.{uuid.uuid4().hex}")
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(part, near)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    data = bytearray(text.encode())
    if fs.getScheme() in ("hdfs", "viewfs"):
        part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(data)
        out.close()
        if not fs.exists(p) and fs.rename(part, p):
            return True
        fs.delete(part, False)
        return False
    try:
        out = fs.create(p, False)
        out.write(data)
        out.close()
        return True
    except Exception as exc:
        if "AlreadyExists" in str(exc) or fs.exists(p):
            return False
        raise


def bucket_of(keys: Sequence[Column], n: int) -> Column:
    """Bucket of a key by its text, so equal values share it whatever their integer type; NULLs share one."""
    return F.pmod(F.xxhash64(*[F.coalesce(k.cast("string"), F.lit("\u0000")) for k in keys]), F.lit(n)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables of a store."""

    spark: SparkSession
    root: str
    version: int
    tables: Mapping[str, dict]
    meta: Mapping[str, object]

    def folders(self, name: str, buckets: Iterable[int] | None = None) -> list[str]:
        parts = self.tables[name]["parts"]
        wanted = sorted(parts, key=int) if buckets is None else [str(b) for b in sorted(set(buckets)) if str(b) in parts]
        return [f"{self.root}/{f}" for b in wanted for f in parts[b]]

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self.tables[name]["schema"])

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or those of its buckets; only their folders are opened."""
        schema, folders = self.schema(name), self.folders(name, buckets)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def buckets(self, name: str) -> int:
        return self.tables[name]["buckets"]

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """The buckets of a table that rows of its key columns fall into (at most its number of buckets reach the driver)."""
        n = self.buckets(name)
        return sorted(r[0] for r in keys.select(bucket_of([c(k) for k in keys.columns], n).alias("b")).distinct().collect())


class VersionedStore:
    """Tables that are published together; see the module's text."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, qualified(spark, root.rstrip("/"))

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.root}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version (version 0 has no tables) or a given one."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Snapshot(self.spark, self.root, 0, {}, {})
        held = json.loads(read_text(self.spark, f"{self.root}/manifests/{version:012d}.json"))
        return Snapshot(self.spark, self.root, version, held["tables"], held["meta"])

    def begin(self) -> "Transaction":
        return Transaction(self, self.snapshot())

    def read(self, name: str) -> DataFrame:
        return self.snapshot().read(name)

    def vacuum(self, keep: int = 2) -> int:
        """Delete data folders that none of the newest ``keep`` manifests names, and older manifests; how many folders went.

        Folders of a transaction that has not committed yet are unknown to every manifest: run it while nobody writes.
        """
        versions = self.versions()
        used = {f.split("/")[1] for v in versions[-keep:] for t in self.snapshot(v).tables.values() for fs in t["parts"].values() for f in fs}
        gone = [n for n in list_names(self.spark, f"{self.root}/data") if n not in used]
        for path in [f"{self.root}/data/{n}" for n in gone] + [f"{self.root}/manifests/{v:012d}.json" for v in versions[:-keep]]:
            fs, p = _hadoop(self.spark, path)
            fs.delete(p, True)
        return len(gone)


class Transaction:
    """New data folders now, the new manifest at ``commit``."""

    def __init__(self, store: VersionedStore, base: Snapshot):
        self.store, self.base, self.spark = store, base, store.spark
        self.tables = json.loads(json.dumps(dict(base.tables)))
        self.meta = dict(base.meta)

    def _write(self, df: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, list[str]]:
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self.store.root}/{folder}"
        if buckets == 1:
            df.write.option("compression", "zstd").parquet(path)
            return {"0": [folder]}
        # every task deals its own rows: no shuffle, and a task leaves at most one file a bucket
        df.withColumn(BUCKET, bucket_of([c(k) for k in keys], buckets)).write.option("compression", "zstd").partitionBy(BUCKET).parquet(path)
        names = [n for n in list_names(self.spark, path) if n.startswith(f"{BUCKET}=")]
        return {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in names}

    def _stored(self, parts: Mapping[str, list[str]], schema: StructType) -> DataFrame:
        folders = [f"{self.store.root}/{f}" for b in sorted(parts, key=int) for f in parts[b]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def replace(
        self, name: str, df: DataFrame, keys: Sequence[str] = (), buckets: int = 1, touched: Iterable[int] | None = None, check_schema: bool = False,
        kept: DataFrame | None = None,
    ) -> DataFrame:
        """Replace a table, or only its ``touched`` buckets (``df`` and ``kept`` then hold all rows of those); returns the rows of ``df`` as stored."""
        old = self.tables.get(name)
        schema = df.schema.jsonValue()
        if old is not None:
            same = [(f["name"], f["type"]) for f in old["schema"]["fields"]] == [(f["name"], f["type"]) for f in schema["fields"]]
            if (check_schema or touched is not None) and not same:
                raise ValueError(f"Schema of {name} would change")
            if touched is not None and old["buckets"] != buckets:
                raise ValueError(f"{name} has {old['buckets']} buckets, not {buckets}")
        parts = self._write(df, keys, buckets)
        stored = self._stored(parts, df.schema)
        if kept is not None:
            for b, folders in self._write(kept.select(*[c(n) for n in df.columns]), keys, buckets).items():
                parts.setdefault(b, []).extend(folders)
        if old is not None and touched is not None:
            gone = {str(b) for b in touched}
            stray = set(parts) - gone
            if stray:
                raise ValueError(f"Rows of {name} lie outside the touched buckets: {sorted(stray)[:5]}")
            parts = {b: f for b, f in old["parts"].items() if b not in gone} | parts
        self.tables[name] = {"schema": schema, "buckets": buckets, "parts": parts}
        return stored

    def append(self, name: str, df: DataFrame, keys: Sequence[str] = (), buckets: int = 1) -> tuple[DataFrame, list[int]]:
        """Add rows to a table; only folders of their buckets are added. Returns the rows as stored and their buckets."""
        old = self.tables.get(name)
        if old is None:
            stored = self.replace(name, df, keys, buckets)
            return stored, sorted(int(b) for b in self.tables[name]["parts"])
        rows = df.select(*[c(f["name"]) for f in old["schema"]["fields"]])
        parts = self._write(rows, keys, old["buckets"])
        for b, folders in parts.items():
            old["parts"].setdefault(b, []).extend(folders)
        return self._stored(parts, rows.schema), sorted(int(b) for b in parts)

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def commit(self, meta: Mapping[str, object] | None = None, before_swap: Callable[[], None] | None = None) -> Snapshot:
        """Create the next manifest. ``before_swap`` runs between the two phases (a place for checks, and for tests to fail)."""
        if meta:
            self.meta |= meta
        if before_swap is not None:
            before_swap()
        version = self.base.version + 1
        held = json.dumps({"version": version, "tables": self.tables, "meta": self.meta})
        if not exclusive_write(self.spark, f"{self.store.root}/manifests/{version:012d}.json", held):
            raise PublishConflict(f"Version {version} of {self.store.root} was published by another writer")
        return self.store.snapshot(version)


def publish_atomic(
    df: DataFrame, root: str, name: str, check_schema: bool = False, before_swap: Callable[[], None] | None = None, view: str | None = None,
) -> Snapshot:
    """Full replacement of a table of the store at ``root`` in one step (K1; ``check_schema``: K2).

    ``view``: a catalog view of that name is pointed at the new folder after the swap, for readers by SQL name
    (one catalog call; until then it shows the version before).
    """
    store = VersionedStore(df.sparkSession, root)
    work = store.begin()
    work.replace(name, df, check_schema=check_schema)
    done = work.commit(before_swap=before_swap)
    if view is not None:
        if "." in view:
            df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {view.rsplit('.', 1)[0]}")
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{done.folders(name)[0]}`")
    return done
