"""Layer profile reports (Q1 raw layer, Q2 cleaned layer).

Each table contributes one aggregation (rows + NULLs per column, plus the
distinct-row count for the cleaned layer) and, for Q2, one grouped count on
the dedupe keys and one count of the source. The per-table rows are unioned
into a single lazy DataFrame ordered by table name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators.profile import (
    DISTINCT,
    ROWS,
    completeness_columns,
    grouping_metrics,
    merge_rows,
    null_details_json,
    table_metrics,
)

PROFILE_COLUMNS = (
    "table_name", "row_count", "column_count", "total_null_values", "columns_with_nulls", "completeness_percentage",
    "null_details",
)
LAYER_COLUMNS = (
    "table_name", "source_table", "source_row_count", "row_count", "rows_removed", "column_count",
    "total_null_values", "columns_with_nulls", "completeness_percentage", "exact_duplicate_rows",
    "duplicate_key_groups", "duplicate_key_rows", "dedupe_keys", "null_details",
)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_profile(
    df: DataFrame, table_name: str, digits: int = 4, empty: float = 100.0, details: str = "counts"
) -> DataFrame:
    """One raw-layer profile row (A1 + A3 + A4)."""
    m = table_metrics(df)
    return m.select(
        F.lit(table_name).alias("table_name"),
        *completeness_columns(df.columns, digits, empty),
        null_details_json(df.columns, details).alias("null_details"),
    )


def error_profile(spark, table_name: str, message: str) -> DataFrame:
    """Profile row of a table that could not be analysed: NULL metrics and
    the error text in ``null_details``."""
    return spark.range(1).select(
        F.lit(table_name).alias("table_name"),
        *[F.lit(None).cast("long").alias(n) for n in
          ("row_count", "column_count", "total_null_values", "columns_with_nulls")],
        F.lit(None).cast("double").alias("completeness_percentage"),
        F.lit(f"Error: {message}").alias("null_details"),
    )


def profile_report(
    tables: Mapping[str, DataFrame | None],
    prefix: str | None = None,
    digits: int = 4,
    empty: float = 100.0,
    details: str = "counts",
    spark=None,
) -> DataFrame:
    """Raw-layer report (Q1): one row per table whose name starts with
    ``prefix`` (a literal prefix, not a LIKE pattern). A table given as
    ``None`` or failing analysis yields an error row instead of stopping the
    report. ``digits=2, empty=0.0, details="repr"`` gives the hybrid variant.
    """
    from pyspark.sql import SparkSession

    names = sorted(n for n in tables if prefix is None or n.startswith(prefix))
    if not names:
        raise ValueError("No tables to profile")
    present = [t for t in tables.values() if t is not None]
    session = spark or (present[0].sparkSession if present else SparkSession.getActiveSession())
    rows = []
    for n in names:
        df = tables[n]
        if df is None:
            rows.append(error_profile(session, n, "table not found"))
            continue
        try:
            rows.append(table_profile(df, n, digits, empty, details))
        except Exception as exc:  # analysis error: reported as a row, the report goes on
            rows.append(error_profile(session, n, str(exc).splitlines()[0]))
    return _union(rows).orderBy("table_name")


@dataclass(frozen=True)
class LayerPair:
    source_table: str
    source: DataFrame
    table_name: str
    target: DataFrame
    dedupe_keys: Sequence[str] = ()


def layer_row(pair: LayerPair) -> DataFrame:
    """One cleaned-layer row (A1, A3-A8): source count, target profile with
    exact duplicates, and duplicate groups/rows on the (renamed) dedupe keys."""
    target = pair.target
    cols = target.columns
    keys = list(pair.dedupe_keys)
    grouped = grouping_metrics(target, [keys] if keys else [])
    repeats = [F.col("_groups_0"), F.col("_extra_0")] if keys else [F.lit(0).cast("long")] * 2
    grouped = grouped.select(DISTINCT, repeats[0].alias("duplicate_key_groups"), repeats[1].alias("duplicate_key_rows"))
    base = merge_rows([table_metrics(target), grouped, pair.source.agg(F.count(F.lit(1)).alias("source_row_count"))])
    metrics = base.select(
        "source_row_count", "duplicate_key_groups", "duplicate_key_rows",
        *completeness_columns(cols),
        (F.col(ROWS) - F.col(DISTINCT)).alias("exact_duplicate_rows"),
        null_details_json(cols, "shares").alias("null_details"),
    )
    return metrics.select(
        F.lit(pair.table_name).alias("table_name"),
        F.lit(pair.source_table).alias("source_table"),
        "source_row_count",
        "row_count",
        (F.col("source_row_count") - F.col("row_count")).alias("rows_removed"),
        "column_count",
        "total_null_values",
        "columns_with_nulls",
        "completeness_percentage",
        "exact_duplicate_rows",
        "duplicate_key_groups",
        "duplicate_key_rows",
        F.lit(json.dumps(keys)).alias("dedupe_keys"),
        "null_details",
    )


def layer_report(pairs: Sequence[LayerPair]) -> DataFrame:
    """Cleaned-layer report (Q2), 14 columns, ordered by table name."""
    return _union([layer_row(p) for p in pairs]).orderBy("table_name")


def profile_catalog(spark, prefix: str, database: str | None = None, exclude=(), **options) -> DataFrame:
    """Raw-layer report over catalog tables: discover tables whose name starts
    with ``prefix`` (minus ``exclude``, e.g. the report table itself), load
    them and profile them (Q1 with S6/S5)."""
    from layercake.sources.csv import discover_tables
    from layercake.sources.tables import load_tables

    names = discover_tables(spark, prefix, database, exclude)
    return profile_report(load_tables(spark, names, database), spark=spark, **options)


def layer_catalog(spark, database: str | None = None, specs=None) -> DataFrame:
    """Cleaned-layer report over catalog tables: each raw table is paired with
    its cleaned target through the specs (Q2 with S5/S7); a missing table
    raises, since the report would be meaningless without it."""
    from layercake.plans.catalog import SPECS, raw_table_name
    from layercake.sources.tables import load_tables

    specs = SPECS if specs is None else specs
    names = [n for s, spec in specs.items() for n in (raw_table_name(s), spec.target)]
    tables = load_tables(spark, names, database)
    missing = [n for n, df in tables.items() if df is None]
    if missing:
        raise RuntimeError(f"Missing tables for the cleaned-layer report: {missing}")
    pairs = [
        LayerPair(raw_table_name(s), tables[raw_table_name(s)], spec.target, tables[spec.target], spec.renamed_keys())
        for s, spec in specs.items()
    ]
    return layer_report(pairs)
