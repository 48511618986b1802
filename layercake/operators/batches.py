"""Distributed global numbering and batch cuts.

A window without ``partitionBy`` would pull every row into one task. Here the
rows are range-partitioned on a *total* order, sorted inside each partition,
and numbered locally with ``monotonically_increasing_id`` (whose low 33 bits
are the position inside the partition once the partition is sorted). Each
partition's starting offset comes from a per-partition row count: a table
with one row per partition, so its size is bounded by the partition count,
not by the data, and broadcasting it is safe.

Range bounds are sampled per execution, so the locally numbered rows are
written once as a table under the session's ``spark.checkpoint.dir`` and
read back: the counts and the rows then come from the same files, and a lost
executor cannot change the numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns
from layercake.session import materialize

ROW_NUMBER = "row_number"
BATCH_ID = "batch_id"
_PID = "__pid"
_LOCAL = "__local"
_OFFSET = "__offset"
_LOW_BITS = (1 << 33) - 1


def global_row_number(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = ROW_NUMBER,
    partitions: int | None = None,
) -> DataFrame:
    """1-based position of every row in ``order_cols`` order.

    ``order_cols`` must be a total order (add a unique key as the last column);
    ties would otherwise be numbered in an arbitrary but fixed way.
    """
    order_cols = list(order_cols)
    require_columns(df, order_cols, "Ordering columns")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordering = [c(o).asc_nulls_last() for o in order_cols]
    ranged = (
        df.repartitionByRange(n, *ordering)
        .sortWithinPartitions(*ordering)
        .select(
            *[c(x) for x in df.columns],
            F.spark_partition_id().alias(_PID),
            (F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))).alias(_LOCAL),
        )
    )
    ranged = materialize(ranged, "numbered")
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # exclusive running sum over at most `n` rows (one per partition)
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias(_OFFSET),
    )
    numbered = ranged.join(F.broadcast(offsets), _PID, "inner")
    return numbered.select(
        *[c(x) for x in df.columns], (F.col(_OFFSET) + F.col(_LOCAL) + F.lit(1)).alias(name)
    )


#: Splits whose starting positions may be broadcast (a path and two numbers each).
_BROADCAST_SPLITS = 200_000


def file_row_number(read: DataFrame, name: str = ROW_NUMBER) -> DataFrame:
    """1-based position of every row of files as they lie: by path, then place in the file.

    ``read`` is a plain scan (``spark.read...load(path)``). Nothing is sorted, shuffled or copied: a row's place in its split comes from the
    scan itself, and the splits' starts are running sums over one row a split, counted by a scan that reads no
    column (footers only for parquet). Splits depend on the files and the session's settings only, so a lost task finds its rows again.
    """
    split = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at")]
    counts = read.select(*split).groupBy("__path", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    counts = materialize(counts, "split-counts")
    running = Window.orderBy("__path", "__block").rowsBetween(Window.unboundedPreceding, 0)  # one row a split
    starts = counts.select(F.col("__path").alias("__p"), F.col("__block").alias("__b"), (F.sum("__n").over(running) - F.col("__n") - F.col("__first")).alias("__shift"))
    if counts.count() <= _BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    rows = read.select(*[c(x) for x in read.columns], *split).join(starts, (F.col("__path") == F.col("__p")) & (F.col("__block") == F.col("__b")))
    return rows.select(*[c(x) for x in read.columns], (F.col("__at") + F.col("__shift") + 1).alias(name))


def _by_cuts(numbered: DataFrame, cuts: Sequence[int], name: str, keep_row_number: bool) -> DataFrame:
    cuts = sorted(int(x) for x in cuts)
    batch = F.lit(len(cuts) + 1)
    for i, cut in reversed(list(enumerate(cuts))):
        batch = F.when(F.col(ROW_NUMBER) <= cut, F.lit(i + 1)).otherwise(batch)
    out = numbered.withColumn(name, batch.cast("int"))
    return out if keep_row_number else out.drop(ROW_NUMBER)


def assign_file_batches(read: DataFrame, cuts: Sequence[int], name: str = BATCH_ID, keep_row_number: bool = False) -> DataFrame:
    """``batch_id`` by position in the files (F3), see ``file_row_number``; cuts as in ``assign_batches``."""
    return _by_cuts(file_row_number(read), cuts, name, keep_row_number)


def assign_batches(
    df: DataFrame,
    order_cols: Sequence[str],
    cuts: Sequence[int],
    name: str = BATCH_ID,
    keep_row_number: bool = False,
) -> DataFrame:
    """``batch_id`` 1..len(cuts)+1 by global position; a cut point belongs to
    the batch on its left (``<= a``, ``(a, b]``, ``> b``).
    """
    return _by_cuts(global_row_number(df, order_cols), cuts, name, keep_row_number)


def unreleased_batches(batches: DataFrame, released: DataFrame, name: str = BATCH_ID) -> DataFrame:
    """Rows of batches not yet released (M4: releasing twice is refused).
    An anti join ignores duplicates on its right side, so the release log is
    not de-duplicated (that would only add a shuffle)."""
    return batches.join(released.select(name), name, "left_anti")


