"""Skew-safe ordered windows per key ("segmented" windows).

A window partitioned by key sends every row of a key to one task, so a key
holding a third of the table becomes a straggler. Here the rows of *hot*
keys are cut into value-range buckets of the ordering column and the window
runs per ``(key, bucket)``; the few values that cross a bucket boundary are
repaired from a per-bucket summary.

Sizes are bounded by construction, which makes the broadcasts safe:

* hot keys = the largest keys with more than ``hot_rows`` rows, as many as
  there are shuffle partitions (a top-k over per-key counts of a seeded
  sample): any key beyond those holds less than one partition's share;
* bucket bounds = one row per hot key (``buckets - 1`` quantiles of its
  sampled rows; approximate percentiles for numbers and times, ranks for
  any other orderable type);
* bucket summaries = at most ``partitions * (buckets + 1)`` rows.

Hot keys and bounds are resolved eagerly (two small jobs; bounded results)
and enter the plan as literal broadcast tables. With no hot key the operator
is exactly the plain window; otherwise the big side is still shuffled once
(by the window) and ordinary keys keep a single bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    BinaryType,
    DateType,
    IntegerType,
    MapType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from layercake.functions.columns import c

HOT = "__seg_hot"
BUCKET = "__seg_bucket"


@dataclass(frozen=True)
class Skew:
    """Hot-key splitting parameters; ``enabled=False`` gives the plain window."""

    enabled: bool = True
    hot_rows: int = 1_000_000
    buckets: int = 32
    accuracy: int = 10_000
    # hot keys are found on a seeded sample (None = exact counts): a key with
    # a large share of the rows cannot hide, and a missed borderline key only
    # costs speed, never correctness
    sample_fraction: float | None = 0.01
    seed: int = 17


PLAIN = Skew(enabled=False)


def _has_percentiles(df: DataFrame, order: str) -> bool:
    t = df.schema[order].dataType
    return isinstance(t, (NumericType, DateType, TimestampType, TimestampNTZType))


def _splittable(df: DataFrame, order: str) -> bool:
    t = df.schema[order].dataType
    return isinstance(t, AtomicType) and not isinstance(t, BinaryType)


def _quantiles(rows: DataFrame, keys: list[Column], column: str, skew: Skew, name: str) -> DataFrame:
    """Per key (aliased columns ``keys``), an array of ``buckets - 1`` quantiles of ``column``, NULLs left out."""
    if _has_percentiles(rows, column):
        probs = [i / skew.buckets for i in range(1, skew.buckets)]
        return rows.groupBy(*keys).agg(F.percentile_approx(c(column), probs, skew.accuracy).alias(name))
    flat = rows.select(*keys, c(column).alias("__q")).where("__q IS NOT NULL")
    names = [n for n in flat.columns if n != "__q"]
    by_key = Window.partitionBy(*names)
    ranked = flat.select("*", F.row_number().over(by_key.orderBy("__q")).alias("__i"), F.count(F.lit(1)).over(by_key).alias("__m"))
    # the i-th quantile is the row of rank ceil(i * m / buckets); a row may be several of them
    grid = F.explode(F.sequence(F.lit(1), F.lit(skew.buckets - 1)))
    picked = ranked.where(F.floor(F.col("__i") * skew.buckets / F.col("__m")) > F.floor((F.col("__i") - 1) * skew.buckets / F.col("__m")))
    picked = picked.select("*", grid.alias("__b")).where(F.col("__i") == F.ceil(F.col("__b") * F.col("__m") / skew.buckets))
    return picked.groupBy(*names).agg(F.transform(F.sort_array(F.collect_list(F.struct("__b", "__q"))), lambda x: x["__q"]).alias(name))


def _key_aliases(keys: Sequence[str], tag: str) -> list[str]:
    return [f"__{tag}{i}" for i in range(len(keys))]


def _on(keys: Sequence[str], aliases: Sequence[str], extra: list[Column] | None = None) -> Column:
    conds = [c(k).eqNullSafe(F.col(a)) for k, a in zip(keys, aliases)] + (extra or [])
    return reduce(lambda a, b: a & b, conds)


def _sampled(df: DataFrame, skew: Skew) -> tuple[DataFrame, float]:
    if skew.sample_fraction is not None and skew.sample_fraction < 1.0:
        return df.sample(fraction=skew.sample_fraction, seed=skew.seed), skew.hot_rows * skew.sample_fraction
    return df, float(skew.hot_rows)


def hot_bounds(
    df: DataFrame, keys: Sequence[str], order: str, skew: Skew, tie: str | None = None
) -> DataFrame | None:
    """Bucket bounds of the hot keys as a small literal DataFrame (columns
    ``__bk<i>``, ``__bounds`` and ``__heavy``), or None when no key is hot.

    Small jobs on the seeded sample: a top-k of per-key counts (one row for
    each shuffle partition at most reaches the driver) and, only if some key is hot,
    per-key quantiles of its sampled rows. A start value repeated ``m``
    times among a key's bounds holds a large share of that key; its rows are
    split again by ``m`` quantiles of the first tie-break column (one more
    job, only when such values exist), kept in ``__heavy`` (value -> tie
    bounds). All results are bounded, so they are safe to collect and to
    broadcast, and later branches of the plan reuse them.
    """
    keys = list(keys)
    if not skew.enabled or not _splittable(df, order):
        return None
    counted, threshold = _sampled(df, skew)
    al = _key_aliases(keys, "hk")
    hot_rows = (
        counted.groupBy(*[c(k).alias(a) for k, a in zip(keys, al)])
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > threshold)
        .orderBy(F.col("__n").desc())
        .limit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        .drop("__n")
        .collect()
    )
    if not hot_rows:
        return None
    spark = df.sparkSession
    key_schema = StructType([StructField(a, df.schema[k].dataType, True) for k, a in zip(keys, al)])
    hot = spark.createDataFrame(hot_rows, key_schema)
    bl = _key_aliases(keys, "bk")
    of_hot = counted.join(F.broadcast(hot), _on(keys, al), "left_semi")
    bound_rows = _quantiles(of_hot, [c(k).alias(b) for k, b in zip(keys, bl)], order, skew, "__bounds").collect()
    heavy: dict = {}
    if tie is not None and _splittable(df, tie):
        pairs = []
        for r in bound_rows:
            values = [v for v in (r["__bounds"] or []) if v is not None]
            for v in sorted(set(values)):
                if values.count(v) > 1:
                    pairs.append((*[r[b] for b in bl], v, values.count(v)))
        if pairs:
            pair_schema = StructType(
                [StructField(a, df.schema[k].dataType, True) for k, a in zip(keys, al)]
                + [StructField("__v", df.schema[order].dataType, True), StructField("__m", IntegerType(), False)]
            )
            pair_df = spark.createDataFrame(pairs, pair_schema)
            of_pair = counted.join(F.broadcast(pair_df), _on(keys, al, [c(order) == F.col("__v")]), "left_semi")
            ties = _quantiles(of_pair, [*[c(k).alias(b) for k, b in zip(keys, bl)], c(order).alias("__v")], tie, skew, "__tb").collect()
            repeats = {(*p[:-2], p[-2]): p[-1] for p in pairs}
            for r in ties:
                key = tuple(r[b] for b in bl)
                m = repeats[(*key, r["__v"])]
                grid = r["__tb"] or []
                if grid:
                    picks = [grid[min(len(grid) - 1, round(j * len(grid) / (m + 1)))] for j in range(1, m + 1)]
                    heavy.setdefault(key, {})[r["__v"]] = picks
    tie_type = df.schema[tie].dataType if tie is not None and tie in df.columns else df.schema[order].dataType
    bounds_schema = StructType(
        [StructField(b, df.schema[k].dataType, True) for k, b in zip(keys, bl)]
        + [
            StructField("__bounds", ArrayType(df.schema[order].dataType), True),
            StructField("__heavy", MapType(df.schema[order].dataType, ArrayType(tie_type)), True),
        ]
    )
    rows = [(*[r[b] for b in bl], r["__bounds"], heavy.get(tuple(r[b] for b in bl))) for r in bound_rows]
    return spark.createDataFrame(rows, bounds_schema)


def tag_buckets(
    df: DataFrame, keys: Sequence[str], order: str, skew: Skew, bounds: DataFrame | None = None, tie: str | None = None
) -> DataFrame:
    """``df`` plus ``HOT`` (bool) and ``BUCKET`` (int, monotone in
    ``(order, tie)`` within a key; NULL order values go to the last bucket)."""
    keys = list(keys)
    cols = [c(n) for n in df.columns]
    if bounds is None:
        return df.select(*cols, F.lit(False).alias(HOT), F.lit(0).alias(BUCKET))
    bl = _key_aliases(keys, "bk")
    tagged = df.join(F.broadcast(bounds), _on(keys, bl), "left")
    is_hot = F.col("__bounds").isNotNull()
    below = F.coalesce(F.size(F.filter(F.col("__bounds"), lambda b: b < c(order))), F.lit(0))
    bucket = F.when(~is_hot, F.lit(0)).when(c(order).isNull(), F.lit(skew.buckets))
    if tie is not None:
        sub = F.try_element_at(F.col("__heavy"), c(order))
        split = F.when(c(tie).isNull(), F.size(sub)).otherwise(F.size(F.filter(sub, lambda b: b < c(tie))))
        bucket = bucket.when(F.coalesce(F.map_contains_key(F.col("__heavy"), c(order)), F.lit(False)), below + split)
    bucket = bucket.otherwise(below).cast("int")
    return tagged.select(*cols, is_hot.alias(HOT), bucket.alias(BUCKET))


def bucket_window(keys: Sequence[str], order: str, tie: Sequence[str]) -> Window:
    return Window.partitionBy(*[c(k) for k in keys], F.col(BUCKET)).orderBy(
        c(order).asc_nulls_last(), *[c(t).asc_nulls_last() for t in tie]
    )


def _join_summary(t: DataFrame, summary: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    sl = _key_aliases(keys, "sk")
    s = summary.select(*[c(k).alias(a) for k, a in zip(keys, sl)], F.col(BUCKET).alias("__sb"), *value_cols)
    joined = t.join(F.broadcast(s), _on(keys, sl, [F.col(BUCKET) == F.col("__sb")]), "left")
    return joined.drop(*sl, "__sb")


def _order_key(order: str, tie: Sequence[str]) -> Column:
    """Struct that sorts like ``order, tie`` ascending with NULLs last."""
    parts = []
    for n in [order, *tie]:
        parts += [c(n).isNull(), c(n)]
    return F.struct(*parts)


def with_next(df, keys, order, tie=(), out="__next", skew: Skew = Skew()) -> DataFrame:
    """``df`` plus ``out``: the ``order`` value of the next row of the same key."""
    keys, tie = list(keys), list(tie)
    first_tie = tie[0] if tie else None
    bounds = hot_bounds(df, keys, order, skew, first_tie)
    t = tag_buckets(df, keys, order, skew, bounds, first_tie)
    w = bucket_window(keys, order, tie)
    t = t.select("*", F.lead(F.lit(1)).over(w).isNotNull().alias("__has_next"), F.lead(c(order)).over(w).alias("__next_in"))
    if bounds is None:  # no hot key: exactly the plain window
        return t.select(*[c(n) for n in df.columns], F.col("__next_in").alias(out))
    # bucket summaries read only hot rows (broadcast filter) and aggregate them
    # per (key, bucket) before shuffling: a filtered scan and a tiny shuffle
    firsts = t.filter(F.col(HOT)).groupBy(*[c(k) for k in keys], F.col(BUCKET)).agg(F.min(c(order)).alias("__first"))
    nxt = firsts.select(
        *[c(k) for k in keys], BUCKET,
        F.lead("__first").over(Window.partitionBy(*[c(k) for k in keys]).orderBy(BUCKET)).alias("__next_bucket"),
    )
    t = _join_summary(t, nxt, keys, ["__next_bucket"])
    value = F.when(F.col("__has_next"), F.col("__next_in")).otherwise(F.col("__next_bucket"))
    return t.select(*[c(n) for n in df.columns], value.alias(out))


def with_previous(df, keys, order, tie=(), cols=(), prefix="__prev_", skew: Skew = Skew()) -> DataFrame:
    """``df`` plus ``<prefix>exists`` and ``<prefix><col>`` for each of ``cols``:
    values of the previous row of the same key."""
    keys, tie, cols = list(keys), list(tie), list(cols)
    first_tie = tie[0] if tie else None
    bounds = hot_bounds(df, keys, order, skew, first_tie)
    t = tag_buckets(df, keys, order, skew, bounds, first_tie)
    w = bucket_window(keys, order, tie)
    t = t.select(
        "*",
        F.lag(F.lit(1)).over(w).isNotNull().alias("__has_prev"),
        *[F.lag(c(n)).over(w).alias(f"__prev_in{i}") for i, n in enumerate(cols)],
    )
    if bounds is None:  # no hot key: exactly the plain window
        return t.select(
            *[c(n) for n in df.columns], F.col("__has_prev").alias(f"{prefix}exists"),
            *[F.col(f"__prev_in{i}").alias(f"{prefix}{n}") for i, n in enumerate(cols)],
        )
    lasts = t.filter(F.col(HOT)).groupBy(*[c(k) for k in keys], F.col(BUCKET)).agg(
        F.max_by(F.struct(*[c(n).alias(f"v{i}") for i, n in enumerate(cols)]), _order_key(order, tie)).alias("__last")
    )
    wb = Window.partitionBy(*[c(k) for k in keys]).orderBy(BUCKET)
    prev = lasts.select(*[c(k) for k in keys], BUCKET, F.lag("__last").over(wb).alias("__prev_bucket"))
    t = _join_summary(t, prev, keys, ["__prev_bucket"])
    has_prev = F.col("__has_prev") | F.col("__prev_bucket").isNotNull()
    out = [has_prev.alias(f"{prefix}exists")]
    for i, n in enumerate(cols):
        out.append(
            F.when(F.col("__has_prev"), F.col(f"__prev_in{i}")).otherwise(F.col(f"__prev_bucket.v{i}")).alias(f"{prefix}{n}")
        )
    return t.select(*[c(n) for n in df.columns], *out)


def with_prior_max(df, keys, order, tie=(), values: dict[str, Column] | None = None, skew: Skew = Skew()) -> DataFrame:
    """``df`` plus, for each ``name: expr``, the maximum of ``expr`` over all
    earlier rows of the same key (NULL when none)."""
    keys, tie = list(keys), list(tie)
    values = dict(values or {})
    names = list(values)
    first_tie = tie[0] if tie else None
    bounds = hot_bounds(df, keys, order, skew, first_tie)
    t = tag_buckets(df, keys, order, skew, bounds, first_tie).select("*", *[e.alias(f"__v{i}") for i, e in enumerate(values.values())])
    w = bucket_window(keys, order, tie).rowsBetween(Window.unboundedPreceding, -1)
    t = t.select("*", *[F.max(f"__v{i}").over(w).alias(f"__in{i}") for i in range(len(names))])
    if bounds is None:  # no hot key: exactly the plain window
        return t.select(*[c(n) for n in df.columns], *[F.col(f"__in{i}").alias(n) for i, n in enumerate(names)])
    maxes = t.filter(F.col(HOT)).groupBy(*[c(k) for k in keys], F.col(BUCKET)).agg(
        *[F.max(f"__v{i}").alias(f"__m{i}") for i in range(len(names))]
    )
    wb = Window.partitionBy(*[c(k) for k in keys]).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = maxes.select(*[c(k) for k in keys], BUCKET, *[F.max(f"__m{i}").over(wb).alias(f"__b{i}") for i in range(len(names))])
    t = _join_summary(t, before, keys, [f"__b{i}" for i in range(len(names))])
    out = [F.greatest(F.col(f"__in{i}"), F.col(f"__b{i}")).alias(n) for i, n in enumerate(names)]
    return t.select(*[c(n) for n in df.columns], *out)
