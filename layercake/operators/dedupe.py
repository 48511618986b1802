"""Deterministic deduplication.

Keep one row per key: the first in the requested order (NULLs last either
way), with every remaining column as an ascending tie-break so the survivor
never depends on partitioning. The filter ``row_number() == 1`` sits directly
on the window, so Spark plans a partial ``WindowGroupLimit`` *before* the
shuffle: each map task ships at most one row per key, and a hot key cannot
flood a single reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns

_RN = "__layercake_rn"


def order_expr(name: str, direction: str = "asc") -> Column:
    """``desc…`` -> descending, anything else ascending; NULLs last both ways."""
    if str(direction).lower().startswith("desc"):
        return c(name).desc_nulls_last()
    return c(name).asc_nulls_last()


def _orderable(df: DataFrame, name: str) -> bool:
    # map columns cannot be compared; everything in the reference is primitive
    return not df.schema[name].dataType.typeName() == "map"


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Iterable[tuple[str, str]] = (),
    tie_break: bool = True,
) -> DataFrame:
    """Newest/first row per key (W1); with no ``order_by`` a deterministic
    arbitrary survivor (W2). Empty ``keys`` = identity.
    """
    keys = list(keys)
    if not keys:
        return df
    require_columns(df, keys, "Dedupe keys")
    order_by = list(order_by)
    require_columns(df, [n for n, _ in order_by], "Dedupe order columns")
    ordering = [order_expr(n, d) for n, d in order_by]
    if tie_break:
        used = set(keys) | {n for n, _ in order_by}
        ordering += [c(n).asc_nulls_last() for n in df.columns if n not in used and _orderable(df, n)]
    if not ordering:
        ordering = [F.lit(0)]
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_latest(df: DataFrame, keys: Sequence[str], by: str, tie: Iterable[str] = ()) -> DataFrame:
    """Convenience: newest ``by`` per key, then ``tie`` columns ascending."""
    return dedupe(df, keys, [(by, "desc"), *[(t, "asc") for t in tie]])
