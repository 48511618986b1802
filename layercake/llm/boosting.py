"""Gradient-boosted trees learnt from every row of a table, however large.

Equal rows of binned features are counted first; the distinct ones lie in shards
in the shared folder, memory-mapped by the workers. For each level of a tree
every shard sends its histograms of gradients, of one size whatever the number of
rows, and the driver adds them in the order of the shards and picks the splits. A worker keeps the
scores of the shards it saw last; without them they follow from the trees.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from layercake.llm.common import open_array, save_array, shared_folder
from layercake.llm.html_trees import Trees
from layercake.session import materialize

#: Most distinct rows of a shard, about, and most shards whose scores a worker keeps.
SHARD_ROWS, KEPT = 250_000, 8


def cuts_of(values: DataFrame, features: int, bins: int = 32) -> list[np.ndarray]:
    """Distinct exact quantiles of every feature, from rows ``(feature, value, n)``."""
    points = F.array(*[F.lit(float(p)) for p in np.linspace(0, 1, bins + 1)[1:-1]])
    one = values.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    found = {r["feature"]: r["at"] for r in one.groupBy("feature").agg(F.percentile("value", points, F.col("n")).alias("at")).collect()}
    return [np.unique(found.get(j, [])) for j in range(features)]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def boost_all(rows: DataFrame, cuts: list[np.ndarray], rounds: int = 40, depth: int = 5, rate: float = 0.25, l2: float = 2.0, shard_rows: int = SHARD_ROWS) -> Trees:
    """``html_trees.boost`` over rows ``(bins binary, y)``, one byte of ``bins`` a feature, all of weight one."""
    spark, wide = rows.sparkSession, max((len(c) for c in cuts), default=0) + 2
    groups = materialize(rows.groupBy("bins").agg(F.sum("y").cast("double").alias("y"), F.count(F.lit(1)).cast("double").alias("n")), "groups")
    total = groups.agg(F.sum("y"), F.sum("n"), F.count(F.lit(1))).first()
    shards = max(1, -(-total[2] // shard_rows))
    folder = shared_folder(spark, "boosting")

    def save(batches):
        held = [b for b in batches if b.num_rows]
        at = TaskContext.get().partitionId()
        data = b"".join(x for b in held for x in b.column("bins").to_pylist())
        save_array(folder, f"bins-{at}", np.frombuffer(data, np.uint8).reshape(-1, len(cuts)))
        for name in ("y", "n"):
            save_array(folder, f"{name}-{at}", np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in held] or [np.zeros(0)]))
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32())], ["shard"])

    groups.repartition(shards, "bins").sortWithinPartitions("bins").mapInArrow(save, "shard int").collect()
    base = min(max(total[0] / total[1], 1e-3), 1 - 1e-3)
    start, inner = math.log(base / (1 - base)), 2**depth - 1
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature and bin of the inner nodes, values of the leaves
    at_shards = spark.sparkContext.parallelize(range(shards), shards)
    for _ in range(rounds):
        f, t = np.zeros(inner, np.int64), np.full(inner, wide)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            done, so_far = list(trees), (f[:first].copy(), t[:first].copy())
            parts = sorted(at_shards.map(lambda s: (s, histograms(folder, s, start, done, so_far, wide))).collect(), key=lambda p: p[0])
            both = np.zeros((2, len(cuts), nodes, wide))
            for _, p in parts:
                both += p
            gs, hs = both.cumsum(axis=3)
            best_gain, left = np.full(nodes, 1e-6), both[:, 0].sum(axis=2)
            whole = left.copy()
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl, hl, gt, ht = gs[j, :, : len(c)], hs[j, :, : len(c)], gs[j, :, -1:], hs[j, :, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                k = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(nodes), k] > best_gain)
                best_gain[better] = gain[better, k[better]]
                f[first + better], t[first + better] = j, k[better]
                left[:, better] = gl[better, k[better]], hl[better, k[better]]
        leaves = np.stack([left, whole - left], axis=2).reshape(2, -1)  # of the last level
        trees.append((f, t, -rate * leaves[0] / (leaves[1] + l2)))
    at = [[cuts[j][k] if k < wide else np.inf for j, k in zip(f, t)] for f, t, _ in trees]
    return Trees(start, np.array([f for f, _, _ in trees]), np.array(at), np.array([v for _, _, v in trees]))


def _nodes(bins: np.ndarray, f: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The node each row has come to in a tree with the given inner nodes."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(int(math.log2(len(f) + 1))):
        node = 2 * node + 1 + (bins[rows, f[node]] > t[node])
    return node


_SCORES: OrderedDict[tuple[str, int], tuple[int, np.ndarray]] = OrderedDict()


def histograms(folder: str, shard: int, start: float, trees: list, so_far: tuple, wide: int) -> np.ndarray:
    """Sums of gradients and of their derivatives by feature, node of the next level and bin."""
    bins, y, n = (open_array(folder, f"{name}-{shard}") for name in ("bins", "y", "n"))
    known, score = _SCORES.pop((folder, shard), (0, None))
    score = np.full(len(y), start) if score is None else score
    for f, t, v in trees[known:]:
        score += v[_nodes(bins, f, t) - len(f)]
    _SCORES[folder, shard] = len(trees), score
    if len(_SCORES) > KEPT:
        _SCORES.popitem(last=False)
    p = 1 / (1 + np.exp(-score))
    g, h = n * p - y, n * p * (1 - p)
    nodes = len(so_far[0]) + 1
    place = (_nodes(bins, *so_far) - (nodes - 1)) * wide
    out = np.empty((2, bins.shape[1], nodes, wide))
    for j in range(bins.shape[1]):
        cell = place + bins[:, j]
        for k, w in enumerate((g, h)):
            out[k, j] = np.bincount(cell, w, nodes * wide).reshape(nodes, wide)
    return out
