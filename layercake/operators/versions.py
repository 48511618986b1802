"""Versioned rows: derive validity ends (W3), find overlapping periods (W4) and
facts that hit no active version (J4).

Periods are closed ``[start, end]``; an open end is NULL. Every window gets a
total order (start, then the caller's tie-break columns) so results never
depend on partition layout. The per-key windows are segmented: a hot key is
split into start-value buckets and stitched back (``segments``), so one key
holding a third of the table does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns
from layercake.operators.segments import Skew, with_next, with_previous, with_prior_max

_FLAG = "__overlap"


def _as_list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _ordering(start: str, tie: Iterable[str]):
    return [c(start).asc_nulls_last(), *[c(t).asc_nulls_last() for t in tie]]


def derive_end_date(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    end: str,
    tie: Iterable[str] = (),
    skew: Skew = Skew(),
) -> DataFrame:
    """``end`` = next start of the same key minus one day; the last version is
    open (NULL). Any supplied end is overwritten; a missing ``end`` is appended.
    Hot keys are split into start-value buckets (see ``segments``).
    """
    keys = _as_list(key)
    require_columns(df, [*keys, start], "derive_end_date columns")
    t = with_next(df, keys, start, list(tie), "__next_start", skew)
    nxt = F.col("__next_start")
    derived = F.when(nxt.isNotNull(), F.date_sub(nxt, 1)).otherwise(F.lit(None).cast("date"))
    if end in df.columns:
        return t.select(*[derived.alias(end) if n == end else c(n) for n in df.columns])
    return t.select(*[c(n) for n in df.columns], derived.alias(end))


OVERLAP_FLAG = "overlaps_previous"


def flag_overlaps(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    end: str,
    mode: str = "previous",
    tie: Iterable[str] = (),
    flag: str = OVERLAP_FLAG,
    skew: Skew = Skew(),
) -> DataFrame:
    """Every row plus a boolean ``flag``: its period overlaps an earlier one of
    the same key (ordered by start, NULLs last, then ``tie``).

    ``mode="previous"`` compares with the immediate predecessor only (it exists
    and its end is open or ``start <= previous end``). ``mode="any"`` compares
    with every predecessor through a running maximum of ends (open end =
    +infinity), which also catches a long early period hiding a later one.
    """
    keys = _as_list(key)
    require_columns(df, [*keys, start, end], "overlap columns")
    tie = list(tie)
    if mode == "previous":
        t = with_previous(df, keys, start, tie, [start, end], "__p_", skew)
        prev_start, prev_end = c(f"__p_{start}"), c(f"__p_{end}")
        cond = prev_start.isNotNull() & (prev_end.isNull() | (c(start) <= prev_end))
    elif mode == "any":
        dated = c(start).isNotNull()
        t = with_prior_max(df, keys, start, tie, {
            "__open_before": F.when(dated & c(end).isNull(), F.lit(1)).otherwise(F.lit(0)),
            "__max_end_before": F.when(dated, c(end)),
        }, skew)
        cond = (F.col("__open_before") == 1) | (c(start) <= F.col("__max_end_before"))
    else:
        raise ValueError(f"Unknown overlap mode: {mode}")
    return t.select(*[c(n) for n in df.columns], F.coalesce(cond, F.lit(False)).alias(flag))


def overlapping_versions(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    end: str,
    mode: str = "previous",
    tie: Iterable[str] = (),
    skew: Skew = Skew(),
) -> DataFrame:
    """Rows whose period overlaps an earlier one of the same key."""
    return flag_overlaps(df, key, start, end, mode, tie, _FLAG, skew).filter(F.col(_FLAG)).drop(_FLAG)


def _common_type(spark, *types: str) -> str:
    """The type that Spark compares the given types in."""
    nulls = ", ".join(f"CAST(NULL AS {t})" for t in types)
    return spark.range(0).selectExpr(f"coalesce({nulls}) AS x").schema[0].dataType.simpleString()


def version_misses(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
    version_key: str | None = None,
    skew: Skew = Skew(),
) -> DataFrame:
    """Fact rows with a non-NULL ``date`` and no version where the key matches
    and ``start <= date`` and (``end`` is NULL or ``date <= end``) (J4).

    One rule for types: keys are compared in the common type of both keys,
    ``date`` and the bounds in the common type of all three (a date against
    timestamps is its midnight); a value that cannot be converted matches
    nothing. A NULL key never matches.

    Facts are first grouped to distinct ``(key, date)`` pairs (partial counts
    before the shuffle, so a hot pair collapses). Pairs and versions are
    ordered per key by date, versions first on equal dates; a pair is covered
    exactly when a version before it is open or the running maximum of their
    ends reaches its date. Uncovered pairs are joined back to the fact rows.
    Linear in the input; no fact is ever paired with the versions of its key.
    """
    version_key = version_key or key
    require_columns(fact, [key, date], "version_misses fact columns")
    require_columns(versions, [version_key, start, end], "version_misses version columns")
    f_types, v_types = dict(fact.dtypes), dict(versions.dtypes)
    key_type = _common_type(fact.sparkSession, f_types[key], v_types[version_key])
    date_type = _common_type(fact.sparkSession, f_types[date], v_types[start], v_types[end])
    k, d = F.col("__k"), F.col("__d")
    dated = fact.filter(c(date).isNotNull()).select(
        *[c(n) for n in fact.columns], c(key).try_cast(key_type).alias("__k"), c(date).try_cast(date_type).alias("__d")
    )
    pairs = dated.filter(k.isNotNull() & d.isNotNull()).groupBy("__k", "__d").agg(F.count(F.lit(1)).alias("__n"))
    facts = pairs.select(k, d, F.lit(1).alias("__kind"), F.lit(None).cast(date_type).alias("__end"), F.lit(0).alias("__open"))
    end_value = c(end).try_cast(date_type)
    vers = versions.select(
        c(version_key).try_cast(key_type).alias("__k"), c(start).try_cast(date_type).alias("__d"), F.lit(0).alias("__kind"),
        end_value.alias("__end"), c(end).isNull().cast("int").alias("__open"),
    ).filter(k.isNotNull() & d.isNotNull())
    both = facts.unionByName(vers)
    reached = with_prior_max(both, ["__k"], "__d", ["__kind"], {"__reach": F.col("__end"), "__opened": F.col("__open")}, skew)
    covered = F.coalesce((F.col("__opened") == 1) | (F.col("__reach") >= d), F.lit(False))
    missed = reached.filter((F.col("__kind") == 1) & ~covered).select("__k", "__d")
    out = [c(n) for n in fact.columns]
    unmatched = dated.filter(k.isNull() | d.isNull()).select(*out)
    return dated.join(missed, ["__k", "__d"], "left_semi").select(*out).unionByName(unmatched)
