"""Referential integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators.rules import require_columns
from layercake.operators.versions import _common_type
from layercake.session import materialize

#: Keys that are broadcast at most: some 100 MB of 64-bit keys.
BROADCAST_KEYS = 2_000_000


def orphan_rows(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str | None = None,
    ignore_null_keys: bool = False,
) -> DataFrame:
    """Fact rows whose key has no match in ``dim`` (left anti join).

    A NULL fact key never matches, so it counts as an orphan unless
    ``ignore_null_keys``. The dimension side is neither de-duplicated (an anti
    join is duplicate-insensitive, so ``distinct`` would only add a shuffle)
    nor forced to broadcast: AQE broadcasts it when its measured size is
    small and keeps a shuffled join otherwise.
    """
    dim_key = dim_key or key
    require_columns(fact, [key], "orphan_rows fact key")
    require_columns(dim, [dim_key], "orphan_rows dimension key")
    if ignore_null_keys:
        fact = fact.filter(c(key).isNotNull())
    keys = dim.select(c(dim_key).alias("__dim_key"))
    return fact.join(keys, c(key) == F.col("__dim_key"), "left_anti")


def _bits(key: Column, words: int) -> tuple[Column, Column]:
    """Word of a key in a Bloom filter of 64-bit words, and its four bits there."""
    h = F.xxhash64(F.lit(29), key)
    mask = F.lit(0).cast("long")
    for i in range(4):
        place = F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(F.xxhash64(key), F.lit(words)), mask


def orphan_rows_filtered(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str | None = None,
    ignore_null_keys: bool = False,
    bits_per_key: int = 16,
    max_words: int = BROADCAST_KEYS,
) -> DataFrame:
    """``orphan_rows`` for dimensions too large to broadcast: the fact rows are not shuffled.

    A Bloom filter of the dimension's keys, ``bits_per_key`` bits each, is
    aggregated in Spark and broadcast (at most ``max_words`` words of 64 bits;
    with more keys it lets more rows through, the result is the same). Facts
    that fail it have no match. Only the distinct keys that pass are shuffled
    and compared with the dimension; the keys let through wrongly are stored and
    broadcast if there are at most ``BROADCAST_KEYS`` of them, else joined by key.
    Keys are compared in the common type of both sides, and one that cannot
    be converted matches nothing. NULL keys and tables without rows as in
    ``orphan_rows``. Runs two jobs when called (key count, wrongly passed keys).
    """
    dim_key = dim_key or key
    require_columns(fact, [key], "orphan_rows fact key")
    require_columns(dim, [dim_key], "orphan_rows dimension key")
    if ignore_null_keys:
        fact = fact.filter(c(key).isNotNull())
    kind = _common_type(fact.sparkSession, fact.schema[key].dataType.simpleString(), dim.schema[dim_key].dataType.simpleString())
    keys = dim.select(c(dim_key).try_cast(kind).alias("__key")).where("__key IS NOT NULL")
    n = keys.agg(F.approx_count_distinct("__key")).first()[0]
    words = max(1, min(max_words, n * bits_per_key // 64))
    word, mask = _bits(F.col("__key"), words)
    bloom = keys.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))
    # the rows travel in a struct, so no column name of theirs can clash
    rows = fact.select(F.struct(*[c(x) for x in fact.columns]).alias("__row"), c(key).try_cast(kind).alias("__key"))
    rows = rows.select("__row", "__key", word.alias("__word"), mask.alias("__mask"))
    rows = rows.join(F.broadcast(bloom), "__word", "left")  # at most ``max_words`` rows of two numbers
    passed = F.col("__key").isNotNull() & F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    wrong = materialize(rows.where(passed).select("__key").distinct().join(keys, "__key", "left_anti"), "wrongly-passed")
    few = wrong.count() <= BROADCAST_KEYS
    found = rows.where(passed).join(F.broadcast(wrong) if few else wrong, "__key", "left_semi")
    return rows.where(~passed).select("__row.*").unionByName(found.select("__row.*"))
