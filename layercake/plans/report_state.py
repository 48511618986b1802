"""Reports whose state merges by file (Q1, A1, A3, A4, A6 without reading old files again).

Each intake file leaves its row count and NULL counts, and each update its
partial counts of the dedupe keys. Both add up, so a report after an increment
reads the new files and the counts of the old ones. The state is a versioned
store: the counts of an update appear together, or not at all.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.profile import ROWS, completeness_columns, merge_rows, null_alias, null_details_json
from layercake.operators.rules import require_columns
from layercake.sources.versioned import VersionedStore

FILE, COUNT = "__file", "__n"
_SLASHES = "^([A-Za-z][A-Za-z0-9+.-]*):/+"


class ReportState:
    """Counts of one table's files in the store at ``root``; ``keys`` are its dedupe keys (none: no key counts).

    Files are taken as unchanging, as the intake writes them; a file counts
    once, by its full name. Empty files leave no row and are opened again.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ()):
        self.spark, self.store, self.keys = spark, VersionedStore(spark, root), list(keys)

    def counted(self) -> set[str]:
        """Names of the files already counted (one a file, as in Spark's own list of a scan's files)."""
        now = self.store.snapshot()
        return {r[0] for r in now.read("files").select(FILE).collect()} if "files" in now.tables else set()

    def update(self, names: Sequence[str], read: Callable[[Sequence[str]], DataFrame]) -> list[str]:
        """Count those of ``names`` that are new, read by ``read`` as a plain scan; returns them.

        Two updates at once: one commits, the other raises ``PublishConflict``
        and changes nothing. Other columns than before, or other keys, raise ValueError.
        """
        work, known = self.store.begin(), self.counted()
        new = sorted(n for n in set(names) if re.sub(_SLASHES, r"\1:/", n) not in known)
        if not new:
            return []
        df = read(new)
        require_columns(df, self.keys, "Key columns")
        shape = {"columns": df.columns, "keys": self.keys}
        if work.meta and {k: work.meta[k] for k in shape} != shape:
            raise ValueError(f"The state holds {work.meta}, the new files {shape}")
        path = F.regexp_replace(df.metadataColumn("_metadata").getField("file_path"), _SLASHES, "$1:/")
        nulls = [F.count_if(c(x).isNull()).alias(null_alias(i)) for i, x in enumerate(df.columns)]
        work.append("files", df.groupBy(path.alias(FILE)).agg(F.count(F.lit(1)).alias(ROWS), *nulls))
        if self.keys:
            work.append("keys", df.groupBy(*[c(k) for k in self.keys]).agg(F.count(F.lit(1)).alias(COUNT)))
        work.commit(shape)
        return new

    def report(self, table_name: str) -> DataFrame:
        """One row: the raw-layer profile with duplicates of the dedupe keys, from the counts alone."""
        now = self.store.snapshot()
        if "files" not in now.tables:
            raise ValueError("No file was counted yet")
        columns = now.meta["columns"]
        parts = [now.read("files").agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(x) for x in (ROWS, *map(null_alias, range(len(columns))))])]
        groups, extra = F.lit(0).cast("long"), F.lit(0).cast("long")
        if self.keys:
            merged = now.read("keys").groupBy(*[c(k) for k in self.keys]).agg(F.sum(COUNT).alias(COUNT))
            repeated = F.col(COUNT) > 1
            parts.append(merged.agg(
                F.count_if(repeated).alias("__groups"), F.coalesce(F.sum(F.when(repeated, F.col(COUNT) - 1)), F.lit(0)).cast("long").alias("__extra")
            ))
            groups, extra = F.col("__groups"), F.col("__extra")
        return merge_rows(parts).select(
            F.lit(table_name).alias("table_name"), *completeness_columns(columns), groups.alias("duplicate_key_groups"),
            extra.alias("duplicate_key_rows"), F.lit(json.dumps(self.keys)).alias("dedupe_keys"), null_details_json(columns).alias("null_details"),
        )
