"""Row-wise cleaning rules. Each is DataFrame -> DataFrame and adds exactly one
``select`` (or ``filter``) to the plan; column contracts are checked eagerly
on the driver (analysis only, no job).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from layercake.functions import columns as fx
from layercake.functions.columns import c


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "Required columns") -> None:
    """Raise ``ValueError`` naming every missing column."""
    present = set(df.columns)
    missing = [name for name in columns if name not in present]
    if missing:
        raise ValueError(f"{what} missing: {missing}")


def _replace(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place, order kept."""
    if not exprs:
        return df
    return df.select(*[exprs[n].alias(n) if n in exprs else c(n) for n in df.columns])


def trim_nullify(df: DataFrame, nullify: bool = True) -> DataFrame:
    """Trim every string column; blanks become NULL unless ``nullify=False``."""
    exprs = {
        f.name: (fx.trim_nullify(c(f.name)) if nullify else F.trim(c(f.name)))
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
    }
    return _replace(df, exprs)


def regex_rules(df: DataFrame, rules: Mapping[str, Iterable[tuple[str, str]]]) -> DataFrame:
    """Ordered regex replacements per column."""
    require_columns(df, rules.keys(), "Regex rule references missing column(s)")
    return _replace(df, {name: fx.regex_chain(c(name), reps) for name, reps in rules.items()})


def value_map(df: DataFrame, maps: Mapping[str, Mapping]) -> DataFrame:
    """Categorical maps compared case- and space-insensitively."""
    require_columns(df, maps.keys(), "Value map references missing column(s)")
    return _replace(df, {name: fx.value_map(c(name), m) for name, m in maps.items()})


def safe_cast(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Error-free casts; bad values become NULL."""
    require_columns(df, casts.keys(), "Cast configuration references missing column(s)")
    return _replace(df, {name: fx.safe_cast(c(name), t) for name, t in casts.items()})


def safe_date(df: DataFrame, dates: Mapping[str, str | None]) -> DataFrame:
    """Error-free date parsing with optional pattern per column."""
    require_columns(df, dates.keys(), "Date configuration references missing column(s)")
    return _replace(df, {name: fx.safe_date(c(name), fmt) for name, fmt in dates.items()})


def date_default_format(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    fmt: str | None = None,
    default: str = "2000-01-01",
    out_fmt: str = "dd/MM/yyyy",
) -> DataFrame:
    """Legacy date rule (P9): columns whose name contains ``date``/``dt`` (or the
    given ones) are parsed, bad/NULL -> ``default``, rendered as ``out_fmt`` text.
    """
    if columns is None:
        columns = [n for n in df.columns if "date" in n.lower() or "dt" in n.lower()]
    columns = list(columns)
    require_columns(df, columns, "Date columns")
    return _replace(df, {n: fx.date_or_default(c(n), fmt, default, out_fmt) for n in columns})


def split_key(df: DataFrame, key: str, category: str = "category_id") -> DataFrame:
    """Composite key ``XX-YY-rest``: ``category`` = ``XX_YY`` (or NULL), key = rest."""
    require_columns(df, [key], "split_key key column")
    cols = [fx.key_remainder(c(key)).alias(key) if n == key else c(n) for n in df.columns if n != category]
    return df.select(*cols, fx.key_category(c(key)).alias(category))


def null_future_dates(df: DataFrame, columns: Iterable[str], as_of=None) -> DataFrame:
    """Dates later than ``as_of`` (default: today) become NULL."""
    columns = list(columns)
    require_columns(df, columns, "Date columns")
    return _replace(df, {n: fx.null_if_future(c(n), as_of) for n in columns})


def _fill_value(dtype, value):
    """The fill literal for a column type, or None when the types do not fit."""
    from pyspark.sql.types import BooleanType, NumericType

    if isinstance(value, bool):
        return F.lit(value) if isinstance(dtype, BooleanType) else None
    if isinstance(value, (int, float)):
        return F.lit(value).cast(dtype) if isinstance(dtype, NumericType) else None
    if isinstance(value, str):
        return F.lit(value) if isinstance(dtype, StringType) else None
    return None


def fill_nulls(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Per-column NULL fill (P13). Absent columns are ignored, and so is a
    value whose type does not fit the column (text for a number column and
    vice versa), as the source pipeline's ``fillna`` did; numbers are cast to
    the column's numeric type."""
    exprs = {}
    for f in df.schema.fields:
        if f.name in fill:
            lit = _fill_value(f.dataType, fill[f.name])
            if lit is not None:
                exprs[f.name] = F.coalesce(c(f.name), lit)
    return _replace(df, exprs)


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL; empty list = identity (F1)."""
    columns = list(columns)
    if not columns:
        return df
    require_columns(df, columns, "Required columns")
    cond = None
    for n in columns:
        cond = c(n).isNotNull() if cond is None else cond & c(n).isNotNull()
    return df.filter(cond)


def rename_strict(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Ordered rename that keeps column positions; a missing source raises."""
    if not renames:
        return df
    require_columns(df, renames.keys(), "Rename rule references missing column(s)")
    return df.select(*[c(n).alias(renames.get(n, n)) for n in df.columns])
