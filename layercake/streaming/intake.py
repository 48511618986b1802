"""Several incremental intakes at once, each ending in a sink (S12, §2.11), with malformed lines kept apart.

All file streams of a call are started together under ``availableNow`` and then awaited; Spark's scheduler
shares the executors among them. A stream that cannot start or fails is reported with its message and does not
stop the others. Every source reports the rows its sink gained. A caller that goes on with the rows asks for
``strict=True``: then one error names every source that failed, once all streams have ended.

With ``rejects=True`` a line that does not fit the schema (too few or too many
fields, unreadable values) is not dropped or half-filled: it goes, as written,
to the ``_rejected=true`` part of the same sink, with the name of its file, in the same commit as the good lines. So
read lines are always kept lines plus rejected lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from layercake.functions.columns import c
from layercake.sources.versioned import exists

LINE, FILE, REJECTED = "_line", "_file", "_rejected"


def _checked(schema: StructType) -> StructType:
    clash = {LINE, FILE, REJECTED} & set(schema.fieldNames())
    if clash:
        raise ValueError(f"Column names reserved for rejected lines: {sorted(clash)}")
    return StructType([*schema.fields, StructField(LINE, StringType(), True)])


def _options(options: Mapping[str, str] | None) -> dict[str, str]:
    # without column pruning every line is checked in full, whatever columns a query reads
    return {"header": "true", **(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE, "columnPruning": "false"}


def _marked(df: DataFrame, schema: StructType) -> DataFrame:
    # always true, but reads a column: Spark refuses a scan of nothing but the line as written
    reads = F.length(F.coalesce(c(schema.fields[0].name).cast("string"), F.lit(""))) >= 0
    bad = F.col(LINE).isNotNull() & reads
    # values of a rejected line are not trusted: only the line as written is kept
    own = [F.when(~bad, c(f.name)).alias(f.name) for f in schema.fields]
    return df.select(*own, LINE, F.when(bad, F.col("_metadata.file_name")).alias(FILE), bad.alias(REJECTED))


@dataclass(frozen=True)
class Checked:
    """Lines that fit the schema, and the others as ``_line`` with ``_file``."""

    kept: DataFrame
    rejected: DataFrame


def _split(marked: DataFrame, schema: StructType) -> Checked:
    return Checked(
        marked.where(~F.col(REJECTED)).select(*[c(f.name) for f in schema.fields]), marked.where(F.col(REJECTED)).select(LINE, FILE)
    )


def read_checked_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, options: Mapping[str, str] | None = None) -> Checked:
    """Batch CSV scan with malformed lines kept apart (S1). Both frames read the files; lines are judged by all columns of the schema."""
    df = spark.read.schema(_checked(schema)).options(**_options(options)).csv(path)
    return _split(_marked(df, schema), schema)


def read_checked_sink(spark: SparkSession, sink: str, schema: StructType) -> Checked:
    """The two parts of a sink that was filled with ``rejects=True``; each scan reads its own part only."""
    stored = StructType([*schema.fields, StructField(LINE, StringType(), True), StructField(FILE, StringType(), True), StructField(REJECTED, BooleanType(), True)])
    return _split(spark.read.schema(stored).parquet(sink) if exists(spark, sink) else spark.createDataFrame([], stored), schema)


@dataclass(frozen=True)
class Intake:
    """One source: a landing folder whose new CSV files go to a parquet sink. ``schema=None`` infers it from the folder."""

    name: str
    folder: str
    sink: str
    schema: StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    rejects: bool = False
    max_files_per_trigger: int | None = None


@dataclass(frozen=True)
class Outcome:
    """Rows the sink gained in this call (``rejected`` of them malformed lines), or the error."""

    name: str
    mode: str
    rows: int = 0
    rejected: int = 0
    error: str | None = None


class IntakeError(RuntimeError):
    """Sources that failed, with their messages; ``outcomes`` has those of all sources."""

    def __init__(self, outcomes: Sequence[Outcome]):
        super().__init__("Intake failed for: " + "; ".join(f"{o.name}: {o.error}" for o in outcomes if o.error is not None))
        self.outcomes = list(outcomes)


def _message(exc: BaseException) -> str:
    return f"{type(exc).__name__}: {(str(exc).splitlines() or [''])[0][:300]}"


def _inferred(spark: SparkSession, job: Intake) -> StructType:
    return job.schema or spark.read.options(**{"header": "true", **job.options, "inferSchema": "true"}).csv(job.folder).schema


def _counts(spark: SparkSession, job: Intake) -> tuple[int, int]:
    """Committed rows of a sink and the rejected ones among them (footers and partition names only)."""
    if not exists(spark, job.sink):
        return 0, 0
    stored = spark.read.schema(f"{REJECTED} boolean").parquet(job.sink) if job.rejects else None
    if stored is None:
        return spark.read.schema(StructType([])).parquet(job.sink).count(), 0
    found = {r[REJECTED]: r["n"] for r in stored.groupBy(REJECTED).agg(F.count(F.lit(1)).alias("n")).collect()}
    return sum(found.values()), found.get(True, 0)


def _frame(spark: SparkSession, job: Intake, schema: StructType, streaming: bool) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(_checked(schema) if job.rejects else schema)
    reader = reader.options(**(_options(job.options) if job.rejects else {"header": "true", **job.options}))
    if streaming and job.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", job.max_files_per_trigger)
    df = reader.csv(job.folder)
    return _marked(df, schema) if job.rejects else df.select(*[c(f.name) for f in schema.fields])


def _start(spark: SparkSession, job: Intake, schema: StructType):
    writer = _frame(spark, job, schema, True).writeStream.format("parquet").option("checkpointLocation", job.sink.rstrip("/") + "/_checkpoint").option("compression", "zstd")
    if job.rejects:
        writer = writer.partitionBy(REJECTED)
    return writer.trigger(availableNow=True).queryName(f"intake-{job.name}").start(job.sink)


def run_streams(spark: SparkSession, jobs: Sequence[Intake], strict: bool = False) -> list[Outcome]:
    """Run all intakes at once; one outcome each, in the order given. Running again on unchanged folders adds 0 rows.

    ``strict=True`` raises ``IntakeError`` if a source failed, after all others have ended. What their sinks gained stays
    there, and the next run takes in what is missing.
    """
    running: list[tuple] = []
    for job in jobs:
        try:
            schema = _inferred(spark, job)
            before = _counts(spark, job)
            running.append((job, before, _start(spark, job, schema), None))
        except Exception as exc:  # reported; the other sources go on
            running.append((job, (0, 0), None, _message(exc)))
    done = []
    for job, before, query, error in running:
        if query is not None:
            try:
                query.awaitTermination()
                failure = query.exception()
                error = None if failure is None else _message(failure)
            except Exception as exc:
                error = _message(exc)
        rows, rejected = _counts(spark, job) if query is not None else before
        done.append(Outcome(job.name, "streaming", rows - before[0], rejected - before[1], error))
    if strict and any(o.error is not None for o in done):
        raise IntakeError(done)
    return done


def run_batches(spark: SparkSession, jobs: Sequence[Intake]) -> list[Outcome]:
    """The same sources read in full; each sink is overwritten and reports its rows."""
    done = []
    for job in jobs:
        try:
            writer = _frame(spark, job, _inferred(spark, job), False).write.mode("overwrite")
            (writer.partitionBy(REJECTED) if job.rejects else writer).parquet(job.sink)
            done.append(Outcome(job.name, "batch", *_counts(spark, job)))
        except Exception as exc:
            done.append(Outcome(job.name, "batch", error=_message(exc)))
    return done


def ingest_to_sinks(spark: SparkSession, jobs: Sequence[Intake], mode: str = "batch", stream_sources: Sequence[str] = ()) -> list[Outcome]:
    """The mode switch (S12), ending in sinks either way.

    ``mode="streaming"`` takes the ``stream_sources`` as file streams, all at once, and the rest as batch;
    ``mode="batch"`` everything as batch; any other mode is an error before anything runs.
    """
    if mode not in ("batch", "streaming"):
        raise ValueError(f"Unknown ingestion mode: {mode}")
    chosen = {s.lower() for s in stream_sources} if mode == "streaming" else set()
    streamed = run_streams(spark, [j for j in jobs if j.name.lower() in chosen])
    rest = run_batches(spark, [j for j in jobs if j.name.lower() not in chosen])
    by_name = {o.name: o for o in [*streamed, *rest]}
    return [by_name[j.name] for j in jobs]


def outcome_rows(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """One row a source: its name, mode, rows, rejected lines and whether it failed."""
    return spark.createDataFrame(
        [(o.name, o.mode, o.rows, o.rejected, o.error) for o in outcomes], "source string, mode string, rows bigint, rejected bigint, error string"
    )
