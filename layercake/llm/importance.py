"""Quality by importance resampling over hashed n-grams.

Two bag-of-n-gram models over hashed unigrams and bigrams, one of the target
text (documents labelled good) and one of all raw text, give each document the
log-ratio of its probability under them. A Gumbel variable, drawn from a hash
of the document, is added, and the k largest sums are a sample without
replacement in proportion to the ratios.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import labelled_ids, ship, slices, strings
from layercake.llm.tokenize import Memo
from layercake.session import materialize

_PART = re.compile(r"\w+|[^\w\s]+")


def _tokens(word: str) -> tuple[int, ...]:
    """Hashes of the runs of word characters and of other signs in a word."""
    return tuple(zlib.crc32(x.encode()) for x in _PART.findall(word))


def buckets_of(text: str, memo: Memo, buckets: int) -> np.ndarray:
    """Buckets of all unigrams and bigrams of a text, repeats included."""
    one = np.array(list(chain.from_iterable([memo[w] for w in text.split()])), np.uint64)
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(31)
    return np.concatenate([one, two]) % np.uint64(buckets)


def count_buckets(docs: DataFrame, text: str, target: str, buckets: int) -> DataFrame:
    """``(bucket, raw, target)``: n-gram counts over all texts and over those where ``target`` is true; tasks add up their own."""

    def run(batches):
        memo, counts = Memo(_tokens), np.zeros((2, buckets), np.int64)
        for batch in slices(batches, "text"):
            memo.trim()
            for t, good in zip(strings(batch.column("text")), batch.column("target").to_pylist()):
                own = np.bincount(buckets_of(t, memo, buckets).astype(np.int64), minlength=buckets)
                counts[0] += own
                if good:
                    counts[1] += own
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], ["bucket", "raw", "target"])

    rows = docs.select(F.col(text).alias("text"), F.col(target).alias("target")).mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    return rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th largest value, by histograms that narrow down on it; None if there are fewer than ``k`` rows or k < 1.

    A histogram (at most 1024 rows) is all that reaches the driver in a round.
    """
    c = F.col(column)
    low, high, n = df.agg(F.min(c), F.max(c), F.count(c)).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high:
        place = F.least(F.floor((c - F.lit(low)) / F.lit(high - low) * 1024), F.lit(1023)).cast("int")
        bins = df.where(c.between(low, high)).groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["b"]):
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
    return low


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel variable from a hash of ``key``."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


def resample(
    docs: DataFrame, labels: DataFrame, label: str = "quality", share: float | None = None, bound: int = 20_000, buckets: int = 16_384, smooth: float = 1.0,
    seed: int = 13, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_grams, log_weight, sample_key, kept)`` for every row.

    The target model learns from at most ``bound`` labelled documents, the first
    in hash order; the raw model counts all rows. Sampled (``kept``) is the
    ``share`` of rows with the largest keys; by default the share of good
    labels. Rows that tie with the last key are kept too. Null or empty text has
    no n-grams and weight 0. Without good labels all weights are 0 and the
    sample is uniform; without any labels every row is kept.
    """
    ship(docs.sparkSession)
    some = labelled_ids(labels, label, bound, doc_id)
    bad, good = some.agg(F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") != 0, 1))).first()
    targets = some.where("label <> 0").select(F.col("doc_id").alias("__id"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = own.join(F.broadcast(targets), F.col("doc_id") == F.col("__id"), "left").withColumn("target", F.col("__id").isNotNull())
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in count_buckets(marked, "text", "target", buckets).collect():  # at most one row a bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio = np.zeros(buckets)
    if target.any():
        ratio = np.log((target + smooth) / (target.sum() + smooth * buckets)) - np.log((raw + smooth) / (raw.sum() + smooth * buckets))

    def weigh(batches):
        memo = Memo(_tokens)
        for batch in slices(batches, "text"):
            memo.trim()
            n, w = [], []
            for t in strings(batch.column("text")):
                own = buckets_of(t, memo, buckets)
                n.append(len(own))
                w.append(float(ratio[own.astype(np.int64)].sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(w, pa.float64())], ["doc_id", "n_grams", "log_weight"])

    kind = own.schema[0].dataType.simpleString()
    weighed = own.mapInArrow(weigh, f"doc_id {kind}, n_grams bigint, log_weight double")
    keyed = materialize(weighed.withColumn("sample_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "importance")
    n = keyed.count()
    share = (good / (good + bad) if good + bad else 1.0) if share is None else share
    k = min(n, max(0, round(share * n)))
    last = kth_largest(keyed, "sample_key", k)
    return keyed.withColumn("kept", F.lit(False) if last is None else F.col("sample_key") >= F.lit(last))
