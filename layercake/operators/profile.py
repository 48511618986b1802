"""Profiling metrics.

Every metric of a table comes from **one** aggregation over it: row count,
a NULL count per column, optionally the exact distinct-row count (a single
``count(DISTINCT struct(*))``, which Spark plans with map-side partial
aggregation and no Expand) and rule violation counts. Results stay lazy
DataFrames; one-row aggregates are combined by union + aggregate, never by
collecting to the driver or cross joining.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns

ROWS = "_rows"
DISTINCT = "_distinct"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_alias(i: int) -> str:
    return f"_null_{i}"


def rule_alias(i: int) -> str:
    return f"_rule_{i}"


def table_metrics(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    rules: Mapping[str, Column] | None = None,
    distinct: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One-row aggregate: rows, NULLs per column, distinct rows, rule hits
    (plus any ``extra`` aggregate expressions, in the same pass).

    ``count_if`` over zero rows is 0 (not NULL), so empty inputs need no repair.
    A rule whose predicate is NULL counts as passing.
    """
    columns = list(df.columns if columns is None else columns)
    require_columns(df, columns, "Profiled columns")
    # plain SQL text keeps plan building to a few gateway calls on wide tables
    sql = [f"count(1) AS {ROWS}"]
    sql += [f"count_if({_q(n)} IS NULL) AS {null_alias(i)}" for i, n in enumerate(columns)]
    if distinct:
        inner = ", ".join(_q(n) for n in df.columns)
        sql.append(f"count(DISTINCT struct({inner})) AS {DISTINCT}" if df.columns else f"CAST(0 AS BIGINT) AS {DISTINCT}")
    exprs = [F.expr(x) for x in sql]
    for j, cond in enumerate((rules or {}).values()):
        exprs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(rule_alias(j)))
    return df.agg(*exprs, *extra)


def merge_rows(frames: Iterable[DataFrame]) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row.

    Union with missing columns as NULL, then ``max`` per column; this keeps
    the plan a plain union + tiny aggregate instead of a cross join.
    """
    frames = list(frames)
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f, allowMissingColumns=True)
    names: list[str] = []
    for f in frames:
        names += [n for n in f.columns if n not in names]
    q = [f"`{n.replace('`', '``')}`" for n in names]
    return merged.agg(*[F.expr(f"max({x}) AS {x}") for x in q])


def _pct(part: Column, whole: Column, digits: int, empty: float) -> Column:
    return (
        F.when(whole == 0, F.lit(float(empty)))
        .otherwise(F.round(F.lit(100.0) * part.cast("double") / whole.cast("double"), digits))
        .cast("double")
    )


def null_profile(df: DataFrame, table_name: str, digits: int = 4) -> DataFrame:
    """Long form: one row per column with its NULL count and share (A1)."""
    columns = df.columns
    m = table_metrics(df, columns)
    entries = ", ".join(
        f"named_struct('ordinal_position', {i + 1}, 'column_name', {_s(n)}, 'null_count', {null_alias(i)})"
        for i, n in enumerate(columns)
    )
    return m.selectExpr(f"{ROWS} AS row_count", f"inline(array({entries}))").select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "ordinal_position",
        "row_count",
        "null_count",
        _pct(F.col("null_count"), F.col("row_count"), digits, 0.0).alias("null_percentage"),
    )


def _sum_cols(cols: list[Column]) -> Column:
    total = F.lit(0).cast("long")
    for col in cols:
        total = total + col
    return total


def completeness_columns(columns: Sequence[str], digits: int = 4, empty: float = 100.0) -> list[Column]:
    """Table-level columns computed from a ``table_metrics`` row (A3)."""
    nulls = [F.col(null_alias(i)) for i in range(len(columns))]
    total_nulls = _sum_cols(nulls)
    with_nulls = _sum_cols([F.when(n > 0, 1).otherwise(0).cast("long") for n in nulls])
    cells = F.col(ROWS).cast("long") * F.lit(len(columns)).cast("long")
    return [
        F.col(ROWS).cast("long").alias("row_count"),
        F.lit(len(columns)).cast("long").alias("column_count"),
        total_nulls.alias("total_null_values"),
        with_nulls.alias("columns_with_nulls"),
        _pct(cells - total_nulls, cells, digits, empty).alias("completeness_percentage"),
    ]


def completeness(df: DataFrame, table_name: str, digits: int = 4, empty: float = 100.0) -> DataFrame:
    """One row: rows, columns, total NULLs, columns with NULLs, completeness %."""
    m = table_metrics(df)
    return m.select(F.lit(table_name).alias("table_name"), *completeness_columns(df.columns, digits, empty))


def null_details_json(columns: Sequence[str], style: str = "counts", digits: int = 4) -> Column:
    """JSON text of the columns that have NULLs, keys sorted, Python spacing.

    ``counts``: ``{"col": n}``; ``shares``: ``{"col": {"null_count": n,
    "null_percentage": p}}``; ``repr``: every column in table order as a
    Python dict repr (``{'col': n, ...}``). Built from literals +
    ``array_join`` (NULL elements are skipped), so it stays a JVM expression.
    """
    if style == "repr":
        items = [F.concat(F.lit(repr(name) + ": "), F.col(null_alias(i)).cast("string")) for i, name in enumerate(columns)]
        return F.concat(F.lit("{"), F.array_join(F.array(*items), ", "), F.lit("}")) if items else F.lit("{}")
    parts = []
    for i, name in sorted(enumerate(columns), key=lambda t: t[1]):
        n = F.col(null_alias(i))
        key = F.lit(json.dumps(name) + ": ")
        if style == "counts":
            value = n.cast("string")
        else:
            pct = _pct(n, F.col(ROWS), digits, 0.0)
            value = F.concat(
                F.lit('{"null_count": '), n.cast("string"), F.lit(', "null_percentage": '), pct.cast("string"), F.lit("}")
            )
        parts.append(F.when(n > 0, F.concat(key, value)))
    if not parts:
        return F.lit("{}")
    return F.concat(F.lit("{"), F.array_join(F.array(*parts), ", "), F.lit("}"))


def distinct_metrics(df: DataFrame) -> DataFrame:
    """One lazy row (``_rows``, ``_distinct``): NULLs compare equal (A5).

    One grouping by a 64-bit hash of the row (partial counts before the
    shuffle, so copies collapse there); a hash seen once proves its row unique.
    Only rows whose hash repeats are compared in full, found by a semi join that
    adaptive execution plans. Collisions merely add rows to compare, so the
    result is exact whatever the share of repeated rows.
    """
    if not df.columns:
        return table_metrics(df, columns=[], distinct=True)
    cols = [c(n) for n in df.columns]
    row = F.struct(*cols)
    fp = F.xxhash64(*[F.struct(F.lit(i), x.isNull(), x) for i, x in enumerate(cols)]).alias("__fp")
    groups = df.select(fp).groupBy("__fp").agg(F.count(F.lit(1)).alias("__n"))
    once = groups.agg(F.sum("__n").alias("__r"), F.count_if(F.col("__n") == 1).alias("__d"))
    repeated = groups.filter(F.col("__n") > 1).select("__fp")
    compared = df.select(row.alias("__row"), fp).join(repeated, "__fp", "left_semi").groupBy("__fp", "__row").agg(F.lit(1).alias("__one"))
    again = compared.agg(F.lit(0).cast("bigint").alias("__r"), F.count(F.lit(1)).alias("__d"))
    total = once.unionByName(again).agg(F.sum("__r"), F.sum("__d")).toDF("__r", "__d")
    return total.select(F.coalesce("__r", F.lit(0)).cast("long").alias(ROWS), F.coalesce("__d", F.lit(0)).cast("long").alias(DISTINCT))


def grouping_metrics(df: DataFrame, key_sets: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One lazy row for A5 and all A6 key sets of a table: ``_rows``, ``_distinct``, and for each key set i
    ``_groups_<i>`` (keys that occur more than once) and ``_extra_<i>`` (rows beyond the first).

    The table is read once and expanded by key set; copies are counted before
    the one shuffle that all groupings share, so hot keys collapse there. Keys are compared
    as they are, NULLs equal. Whole rows are compared by a 128-bit hash (two 64-bit hashes of different
    beginnings): among 10^12 rows one wrong match has a chance of about 10^-15; ``distinct_metrics`` compares the rows themselves.
    """
    key_sets = [list(k) for k in key_sets]
    for keys in key_sets:
        require_columns(df, keys, "Key columns")
    row = [F.struct(F.lit(i), c(n).isNull(), c(n)) for i, n in enumerate(df.columns)]
    names = sorted({k for keys in key_sets for k in keys})
    hashes = [F.xxhash64(F.lit(seed), *row).alias(f"__h{seed}") for seed in (1, 2)]
    sources = df.select(*hashes, *[c(n).alias(f"__k{i}") for i, n in enumerate(names)])
    columns = sources.columns
    sets = [["__h1", "__h2"], *[[f"__k{names.index(k)}" for k in dict.fromkeys(keys)] for keys in key_sets]]

    def number(wanted: list[str]) -> int:
        return sum(1 << (len(columns) - 1 - i) for i, n in enumerate(columns) if n not in wanted)

    counted = sources.groupingSets(list({number(x): x for x in sets}.values()), *columns).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set")
    )
    zero = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    mine = F.col("__set") == number(sets[0])
    out = [zero(F.when(mine, F.col("__n"))).alias(ROWS), F.count_if(mine).alias(DISTINCT)]
    for i, wanted in enumerate(sets[1:]):
        again = (F.col("__set") == number(wanted)) & (F.col("__n") > 1)
        out += [F.count_if(again).alias(f"_groups_{i}"), zero(F.when(again, F.col("__n") - 1)).alias(f"_extra_{i}")]
    return counted.agg(*out)


def exact_duplicates(df: DataFrame, table_name: str) -> DataFrame:
    """Rows minus distinct rows; NULLs compare equal (A5), see ``distinct_metrics``."""
    return distinct_metrics(df).select(
        F.lit(table_name).alias("table_name"),
        F.col(ROWS).alias("total_rows"),
        F.col(DISTINCT).alias("distinct_rows"),
        (F.col(ROWS) - F.col(DISTINCT)).alias("exact_duplicate_rows"),
    )


def key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row aggregate over ``groupBy(keys).count()``: total rows, groups with
    more than one row, extra rows. The grouping has map-side partial counts,
    so a hot key collapses before the shuffle. NULL keys group together.
    """
    keys = list(keys)
    if not keys:
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.lit(0).cast("long").alias("duplicate_key_groups"),
            F.lit(0).cast("long").alias("duplicate_key_rows"),
        )
    require_columns(df, keys, "Key columns")
    counts = df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_key_groups"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("long").alias("duplicate_key_rows"),
    )


def key_duplicates(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """Key duplicate groups and extra rows (A6); no keys -> (0, 0)."""
    return key_groups(df, keys).select(
        F.lit(table_name).alias("table_name"),
        F.lit(json.dumps(list(keys))).alias("keys"),
        "total_rows",
        "duplicate_key_groups",
        "duplicate_key_rows",
    )


def reconcile(source: DataFrame, target: DataFrame, table_name: str) -> DataFrame:
    """Source rows, target rows and rows removed between two layers."""
    merged = merge_rows(
        [
            source.agg(F.count(F.lit(1)).alias("source_row_count")),
            target.agg(F.count(F.lit(1)).alias("row_count")),
        ]
    )
    return merged.select(
        F.lit(table_name).alias("table_name"),
        "source_row_count",
        "row_count",
        (F.col("source_row_count") - F.col("row_count")).alias("rows_removed"),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column], table_name: str) -> DataFrame:
    """Per rule: rows checked and rows where the predicate is true."""
    names = list(rules)
    m = table_metrics(df, columns=[], rules=rules)
    entries = F.array(
        *[F.struct(F.lit(n).alias("rule_name"), F.col(rule_alias(j)).alias("failed_rows")) for j, n in enumerate(names)]
    )
    return m.select(F.col(ROWS).alias("total_rows"), F.inline(entries)).select(
        F.lit(table_name).alias("table_name"), "rule_name", "total_rows", "failed_rows"
    )
