"""Exact top-k by integer inner product over a bit-sliced index.

Rows are dealt into blocks; in a block, every attribute (component less the
block's minimum) is cut into bit slices, one bitmap over the block's rows for
each bit. For a query, the slices are added with bitmap arithmetic (a
carry-save tree, weighted by the bits of the query's components; negative
weights take the complement), the lowest ``coarse`` bits of an attribute left out. The
sum's slices then give, from the most significant downward, the value of the
k-th row; rows that the left-out bits could lift to it are the boundary and are
resolved with exact scores. The index lies in the shared checkpoint folder
and is memory-mapped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import open_array, save_array, shared_folder, ship


def quantise(vectors: list) -> np.ndarray:
    """floor(256 * x) of each component; shorter vectors are filled with 0."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(256.0 * np.asarray(v, np.float64))
    return out


def _bitmaps(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as 64-bit words."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    fill = -packed.shape[-1] % 8
    packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], fill), np.uint8)], axis=-1) if fill else packed
    return np.ascontiguousarray(packed).view(np.uint64)


def build_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(slices, low)`` of a block: slices[attribute, bit, word] of values less ``low``, each attribute's minimum."""
    low = values.min(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
    above = (values - low).T
    bits = max(1, int(above.max(initial=0)).bit_length())
    slices = np.stack([_bitmaps((above >> b) & 1 == 1) for b in range(bits)], axis=1) if above.size else np.zeros((values.shape[1], bits, 0), np.uint64)
    return slices, low


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of weighted slices: ``columns[p]`` holds arrays (n, words) of slices worth 2**p; returns the sum's slices, low first."""
    out, p = [], 0
    columns = [list(c) for c in columns]
    while p < len(columns):
        stack = [c for c in columns[p] if len(c)]
        rows = np.concatenate(stack) if stack else None
        while rows is not None and len(rows) > 1:
            if p + 1 == len(columns):
                columns.append([])
            third = len(rows) // 3
            if third:
                a, b, c, rest = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third], rows[3 * third :]
                half = a ^ b
                columns[p + 1].append((a & b) | (c & half))
                rows = np.concatenate([half ^ c, rest])
            else:
                columns[p + 1].append(rows[:1] & rows[1:2])
                rows = rows[:1] ^ rows[1:2]
        out.append(rows[0] if rows is not None else None)
        p += 1
    return out


def _words(n: int) -> np.ndarray:
    return _bitmaps(np.ones((1, n), bool))[0] if n else np.zeros(0, np.uint64)


def kth_value(total: list, rows: np.ndarray, k: int) -> int:
    """Value of the k-th largest sum among ``rows`` (a bitmap), reading slices from the most significant downward."""
    sure, maybe, value = 0, rows, 0
    for p in range(len(total) - 1, -1, -1):
        ones = maybe & total[p] if total[p] is not None else np.zeros_like(maybe)
        n = int(np.bitwise_count(ones).sum())
        if sure + n >= k:
            maybe, value = ones, value | (1 << p)
        else:
            sure, maybe = sure + n, maybe & ~ones
    return value


def at_least(total: list, rows: np.ndarray, floor: int) -> np.ndarray:
    """Bitmap of ``rows`` whose sum is ``floor`` or more."""
    if floor <= 0:
        return rows
    if floor >> len(total):
        return np.zeros_like(rows)
    more, same = np.zeros_like(rows), rows
    for p in range(len(total) - 1, -1, -1):
        ones = total[p] if total[p] is not None else np.zeros_like(rows)
        if (floor >> p) & 1:
            same = same & ones
        else:
            more, same = more | (same & ones), same & ~ones
    return more | same


def top_k(query: np.ndarray, slices: np.ndarray, values: np.ndarray, allowed: np.ndarray, k: int, coarse: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, scores)`` of every row of a block that may be among its k best: the k best and all ties with the last."""
    n_bits = slices.shape[1]
    skip = min(coarse, n_bits - 1)
    weight = np.zeros(slices.shape[0], np.int64)
    weight[: min(len(query), len(weight))] = query[: len(weight)]
    full = _words(len(values))
    columns: list[list[np.ndarray]] = [[] for _ in range(n_bits + max(1, int(np.abs(weight).max(initial=0)).bit_length()))]
    for sign in (1, -1):
        of_sign = np.where(weight * sign > 0, weight * sign, 0)
        for w in range(int(of_sign.max(initial=0)).bit_length()):
            attributes = np.flatnonzero((of_sign >> w) & 1)
            if len(attributes):
                for b in range(skip, n_bits):
                    part = slices[attributes, b]
                    columns[w + b].append(part if sign > 0 else full & ~part)
    total = add_slices(columns)
    k = min(k, int(np.bitwise_count(allowed).sum()))
    if not k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lift = int(np.abs(weight).sum()) * ((1 << skip) - 1)  # most that the left-out bits can add
    boundary = at_least(total, allowed, kth_value(total, allowed, k) - lift)
    rows = np.flatnonzero(np.unpackbits(boundary.view(np.uint8), bitorder="little")[: len(values)])
    scores = values[rows] @ weight
    last = np.partition(scores, len(scores) - k)[len(scores) - k]
    return rows[scores >= last], scores[scores >= last]


def index(vectors: DataFrame, vec_id: str, embedding: str, block_rows: int = 4096) -> tuple[str, int]:
    """Write the index of all valid rows; returns its folder and the number of blocks."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    valid = _valid(vectors, vec_id, embedding)
    blocks = max(1, math.ceil(valid.count() / block_rows))
    folder = shared_folder(spark, "bit-sliced")
    # rows are dealt by place, not by value, so that repeated ids or vectors spread
    dealt = valid.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))

    def write(batches):
        held: list = []
        current = None

        def out():
            values = quantise([v for _, v in held])
            slices, _ = build_block(values)
            save_array(folder, f"slices-{current}", slices)
            save_array(folder, f"values-{current}", values.astype(np.int32) if np.abs(values).max(initial=0) < 2**31 else values)
            save_array(folder, f"ids-{current}", np.array([i for i, _ in held], np.int64))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([len(held)], pa.int64())], ["block", "n"])

        for batch in batches:
            for block, i, v in zip(*(batch.column(c).to_pylist() for c in ("block", "vec_id", "embedding"))):
                if block != current and held:
                    yield out()
                    held = []
                current = block
                held.append((i, v))
        if held:
            yield out()

    written = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(write, "block int, n bigint")
    written.agg(F.sum("n")).collect()
    return folder, blocks


def _valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", block_rows: int = 4096, coarse: int = 2
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the ``k`` other rows of the highest score, ties to the smaller id.

    Null vectors, ids or components and non-finite components take no part.
    Vectors of unequal length are filled with 0. Rows with the query's id are
    its own; a repeated query id is one query (its smallest vector); repeated
    candidates each count. Fewer than ``k`` candidates: all of them.
    """
    folder, blocks = index(vectors, vec_id, embedding, block_rows)
    asked = _valid(queries, vec_id, embedding).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # the stated queries against all rows, in blocks: each query goes to each block once; few bytes but much
    # work, so the number of partitions is given (else adaptive execution would join them by size)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = (
        asked.select(F.col("vec_id").alias("query_id"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        .repartition(parts, "block", F.pmod(F.xxhash64("query_id"), F.lit(16)))
        .sortWithinPartitions("block", "query_id")
    )

    def run(batches):
        current, slices, values, ids = None, None, None, None
        for batch in batches:
            found: list[tuple] = []
            for block, query, v in zip(*(batch.column(c).to_pylist() for c in ("block", "query_id", "embedding"))):
                if block != current:
                    current = block
                    try:
                        ids = open_array(folder, f"ids-{block}")
                    except FileNotFoundError:  # no row was dealt to this block
                        ids = None
                    else:
                        slices, values = np.array(open_array(folder, f"slices-{block}")), open_array(folder, f"values-{block}").astype(np.int64)
                if ids is None:
                    continue
                allowed = _bitmaps((ids != query)[None])[0]
                rows, scores = top_k(quantise([v])[0], slices, values, allowed, k, coarse)
                found += zip([query] * len(rows), ids[rows].tolist(), scores.tolist())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["query_id", "vec_id", "score"])

    best = sent.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
