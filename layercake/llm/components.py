"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round re-hangs edges on the smallest known neighbour; rounds grow with the
logarithm of the longest chain, edges never multiply, and nothing but one
counter reaches the driver. Every half round is written to the shared checkpoint
folder, so lost executors do not replay earlier rounds. A hub's edges are not
gathered in one task (``meet``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.session import materialize


def meet(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``side``: one row per ``key``, with ``n``, how many of the rows have it. ``total`` is the number of rows, or less.

    A key that holds over a thousandth of ``total`` would gather its rows in one
    task. There are at most ``1000 * rows / total`` such keys, so their side
    is broadcast and their rows stay where they are; the others meet by key.
    """
    few, hot = side.where(F.col("n") * 1000 <= total).drop("n"), side.where(F.col("n") * 1000 > total).drop("n")
    apart = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return apart.join(few, key).unionByName(rows.join(F.broadcast(hot), key))


def with_lowest(rows: DataFrame, key: str, value: str, total: int) -> DataFrame:
    """``rows`` with ``m``, the smallest ``value`` of their ``key`` (added up before the shuffle)."""
    return meet(rows, rows.groupBy(key).agg(F.min(value).alias("m"), F.count(F.lit(1)).alias("n")), key, total)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return with_lowest(both, "a", "b", 2 * n).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return with_lowest(down, "a", "b", n).select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge: ``root`` is the smallest node of its component.

    Self-loops, repeated and mirrored edges are allowed; edges with a null end
    link nothing. An empty table gives an empty result.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    edges, before = materialize(edges, "edges"), None
    n = edges.count()
    while n:
        larger = materialize(_large_star(edges, n), "edges")  # as many rows as there are edges
        edges = materialize(_small_star(larger, n).where("a <> b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, now[0]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
