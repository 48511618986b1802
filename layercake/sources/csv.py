"""Raw CSV sources.

Reads are declared with an explicit all-string schema so no inference pass
runs over the data; typing is deferred to cleaning. With an explicit schema
Spark binds CSV columns **by position** and ignores the header text; pass
``strict_header=True`` to have Spark validate the header against the schema.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESCUE_COLUMN = "_rescued_data"


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    strict_header: bool = False,
    header: bool = True,
) -> DataFrame:
    """Batch CSV scan (S1); ``schema=None`` infers types (S2) and drops a
    rescued-data column if the reader produced one."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not strict_header)
    else:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    if schema is None and RESCUE_COLUMN in df.columns:
        df = df.drop(RESCUE_COLUMN)
    return df


def read_csv_by_header(
    spark: SparkSession, folder: str, schema: StructType, options: Mapping[str, str] | None = None, ignore_case: bool = True,
) -> DataFrame:
    """CSV files of a folder bound by the names in their headers (S1), whatever the order of their columns.

    A column that a file lacks is NULL, one that the schema lacks is left out. Each
    file's header line is read on its own (a few bytes a file, by some threads of the driver); files with
    the same header are one scan, so the plan has as many scans as there are different headers.
    A header that names a column twice is an error.
    """
    import csv as lines
    import io
    from concurrent.futures import ThreadPoolExecutor

    options = dict(options or {})
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(
        s.getPath().toString() for s in fs.listStatus(base) if s.isFile() and s.getLen() and not s.getPath().getName().startswith(("_", "."))
    )

    def header(path: str) -> tuple[str, ...]:
        first = spark.read.options(**{"lineSep": "\n"}).text(path).limit(1).collect()
        found = next(lines.reader(io.StringIO(first[0][0]), delimiter=options.get("sep", ",")), [])
        return tuple(x.strip().lstrip("\ufeff") for x in found)

    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(header, files))
    fold = str.lower if ignore_case else str
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in zip(files, headers):
        groups.setdefault(names, []).append(path)
    parts = []
    for names, paths in sorted(groups.items()):
        places = [fold(n) for n in names]
        twice = {n for n in places if places.count(n) > 1}
        if twice:
            raise ValueError(f"{paths[0]} names columns twice: {sorted(twice)}")
        by_place = StructType([StructField(f"_c{i}", StringType(), True) for i in range(len(names))])
        df = spark.read.options(**options).option("header", True).schema(by_place).csv(paths)
        parts.append(df.select(*[
            (F.col(f"_c{places.index(fold(f.name))}") if fold(f.name) in places else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ]))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_name(path: str) -> str:
    """File name lower-cased with a case-insensitive ``.csv`` suffix removed."""
    base = os.path.basename(path.rstrip("/"))
    low = base.lower()
    return low[:-4] if low.endswith(".csv") else low


@dataclass
class IngestResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


class IngestError(RuntimeError):
    def __init__(self, result: IngestResult):
        super().__init__("Raw ingestion failed for: " + "; ".join(result.errors))
        self.result = result


def ingest_sources(
    spark: SparkSession,
    files: Iterable[str],
    registry: Mapping[str, StructType],
    table_name=lambda source: f"raw_{source}",
    mode: str = "batch",
    stream_sources: Iterable[str] = (),
    strict: bool = True,
) -> IngestResult:
    """Register each file under its source name.

    Unknown files and read failures are **collected**; all good sources still
    load, then one error lists every problem (``strict=False`` returns them).
    ``mode="streaming"`` reads the ``stream_sources`` (the two transactional
    CRM sources of ``plans.catalog.STREAMED_SOURCES`` in the retail catalog)
    as file streams and the rest as batch; any other mode is an error. A
    streamed source is read from the folder of its file, so each streamed
    source needs a landing folder of its own (later drops land there too).
    """
    if mode not in ("batch", "streaming"):
        raise ValueError(f"Unknown ingestion mode: {mode}")
    streamed = {s.lower() for s in stream_sources}
    result = IngestResult()
    for path in files:
        name = source_name(path)
        schema = registry.get(name)
        if schema is None:
            result.errors.append(f"unknown source file {path}")
            continue
        try:
            if mode == "streaming" and name in streamed:
                from layercake.streaming.ingest import stream_raw_csv

                df = stream_raw_csv(spark, os.path.dirname(path) or path, schema)
            else:
                df = read_raw_csv(spark, path, schema)
                df.schema  # resolve now so a missing path is reported here
            result.tables[table_name(name)] = df
        except Exception as exc:  # collected, reported together below
            result.errors.append(f"{path}: {type(exc).__name__}: {str(exc).splitlines()[0]}")
    if result.errors and strict:
        raise IngestError(result)
    return result


def discover_tables(
    spark: SparkSession,
    prefix: str,
    database: str | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """Catalog tables whose name starts with ``prefix`` (a literal prefix, so
    ``_`` is not a wildcard), minus ``exclude``, sorted (S6)."""
    skip = set(exclude)
    names = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix)]
    return sorted(n for n in names if n not in skip)
