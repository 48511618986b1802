"""SimHash near-duplicates linked through BK-trees.

Fingerprints are compared only as distinct values. Two fingerprints within
``radius`` bits agree on at least one of ``radius + 1`` blocks of their bits, so
each block value names a shard, and each shard is a BK-tree: children hang on
the edge of their Hamming distance to the parent, and a search follows only
edges within the radius. A shard over ``tile`` fingerprints is dealt into
slices; each pair of slices is a task of its own, one slice as the tree and
the other as its queries, so no shard has to fit one task. The trees travel to
their queries through the shuffle: trees of all fingerprints grow with the
input and have no bound for a broadcast.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import slices
from layercake.llm.components import connected_components, meet, with_lowest
from layercake.session import materialize

_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``sizes`` hashes, the bits set in over half of them; 0 for an empty run."""
    result = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return result
    sizes = sizes[full]
    ends = np.cumsum(sizes)
    blocks = -(-sizes // 255)  # byte counters hold up to 255 rows
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    step = np.arange(blocks.sum()) - np.repeat(first, blocks)
    starts = np.repeat(ends - sizes, blocks) + 255 * step
    rows = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        part = np.add.reduceat(_LANES[rows[:, byte]], starts)
        count = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * count > sizes[:, None]).astype(np.uint64)
        result[full] |= (bits << (np.arange(8, dtype=np.uint64) + np.uint64(8 * byte))).sum(axis=1, dtype=np.uint64)
    return result


def shingle_hashes(text: bytes, words: int, seed: int) -> list[int]:
    """XXH64 of every shingle; A-Z lower-cased, words between ASCII white space."""
    w = text.lower().split()
    if len(w) > words:
        return [xxhash.xxh64_intdigest(s, seed) for s in map(b" ".join, zip(*(w[i:] for i in range(words))))]
    return [xxhash.xxh64_intdigest(b" ".join(w), seed)] if w else []


def fingerprints(docs: DataFrame, key: str, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``(key, fp)``: 64-bit SimHash of each whole text, as a signed long; null or wordless text: 0."""

    def run(batches):
        for batch in slices(batches, "text"):
            runs = [shingle_hashes(x or b"", words, seed) for x in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, runs), np.int64, len(runs))
            flat = np.fromiter(chain.from_iterable(runs), np.uint64, int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(majority(flat, sizes).view(np.int64))], ["key", "fp"])

    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(run, f"key {source.schema[0].dataType.simpleString()}, fp bigint")


# --- BK-trees -----------------------------------------------------------------------------------------------------


def build_forest(fp: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over ``fp``, one per value of ``tree`` (0..k-1), grown a level at a time.

    Returns ``(roots, edge, child)``: the root of each tree (-1: none), and the
    edges as ``parent * 128 + distance``, ascending, with the child of each.
    """
    roots = np.full(int(tree.max(initial=-1)) + 1, -1, np.int64)
    trees, first = np.unique(tree, return_index=True)
    roots[trees] = first
    waiting = np.setdiff1d(np.arange(len(fp)), first, assume_unique=True)
    at = roots[tree[waiting]]
    edges, children = [], []
    while len(waiting):
        want = at * 128 + np.bitwise_count(fp[waiting] ^ fp[at]).astype(np.int64)
        edge, first, which = np.unique(want, return_index=True, return_inverse=True)
        child = waiting[first]
        edges.append(edge)
        children.append(child)
        stay = np.ones(len(waiting), bool)
        stay[first] = False
        waiting, at = waiting[stay], child[which[stay]]
    if not edges:
        return roots, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, child = np.concatenate(edges), np.concatenate(children)
    order = np.argsort(edge)
    return roots, edge[order], child[order]


def search_forest(fp: np.ndarray, forest, queries: np.ndarray, tree: np.ndarray, radius: int):
    """Yields ``(query, node)`` index arrays of all pairs within ``radius``; only edges within the radius are followed."""
    roots, edge, child = forest
    for at in range(0, len(queries), 1024):
        q = np.arange(at, min(at + 1024, len(queries)))
        node = roots[tree[q]]
        q, node = q[node >= 0], node[node >= 0]
        while len(q):
            d = np.bitwise_count(queries[q] ^ fp[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(edge, node * 128 + np.maximum(d - radius, 0))
            n = np.searchsorted(edge, node * 128 + d + radius, side="right") - low
            q = np.repeat(q, n)
            node = child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(q))]


def _spread(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gives the ends of all links one label, their smallest, through chains."""
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        for end in (a, b):
            np.minimum.at(label, label[end], low)
            np.minimum.at(label, end, low)
        while (label != label[label]).any():
            label = label[label]
        if (label == before).all():
            return label


def link_tiles(group: np.ndarray, is_tree: np.ndarray, is_query: np.ndarray, fp: np.ndarray, radius: int):
    """Links within each group, between its tree and its queries, thinned to one edge per fingerprint: ``(fp, smallest linked)`` arrays."""
    _, group = np.unique(group, return_inverse=True)
    nodes, asks = np.flatnonzero(is_tree), np.flatnonzero(is_query)
    if not len(nodes) or not len(asks):
        return fp[:0], fp[:0]
    bits = fp.view(np.uint64)
    roots, edge, child = build_forest(bits[nodes], group[nodes])
    roots = np.concatenate([roots, np.full(int(group.max()) + 1 - len(roots), -1, np.int64)])
    label = np.arange(len(fp))
    for q, node in search_forest(bits[nodes], (roots, edge, child), bits[asks], group[asks], radius):
        a, b = asks[q], nodes[node]
        other = a != b
        if other.any():
            label = _spread(label, a[other], b[other])
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def link_fingerprints(distinct: DataFrame, radius: int = 3, tile: int = 1024) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs of ``distinct.fp`` within ``radius`` bits."""
    blocks = radius + 1
    width = -(-64 // blocks)
    parts = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for i in range(blocks)
    ]
    shards = distinct.select("fp", F.explode(F.array(*parts)).alias("s")).select("fp", "s.block", "s.value")
    large = shards.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
    n_slices = F.coalesce(F.ceil(F.col("n") / tile).cast("int"), F.lit(1))
    tiles = (
        shards.join(large, ["block", "value"], "left")
        .withColumn("k", n_slices)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("block", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
        .repartition("block", "value", "i", "j")
        .sortWithinPartitions("block", "value", "i", "j")
    )

    def run(batches):
        held: list[pa.RecordBatch] = []
        names = ("block", "value", "i", "j")

        def out(rows: pa.Table):
            c = {n: rows.column(n).to_numpy() for n in (*names, "own", "fp")}
            keys = np.stack([c[n].astype(np.int64) for n in names])
            group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
            a, b = link_tiles(group, c["own"] == c["i"], c["own"] == c["j"], np.ascontiguousarray(c["fp"]), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            if rows.num_rows < 20_000:
                continue
            last = [rows.column(n)[-1].as_py() for n in names]  # the last group may go on in the next batch
            same = np.ones(rows.num_rows, bool)
            for n, v in zip(names, last):
                same &= rows.column(n).to_numpy() == v
            cut = int(same.argmax())
            if cut:
                yield out(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield out(pa.Table.from_batches(held))

    return tiles.mapInArrow(run, "a bigint, b bigint").distinct()


def _rooted(fps: DataFrame, radius: int, tile: int) -> DataFrame:
    """``(fp, low, n, root)`` of each distinct fingerprint of ``fps`` (key, fp): its smallest key, its rows and its component's smallest fingerprint."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n")), "fingerprints")
    roots = connected_components(link_fingerprints(distinct.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3, seed: int = 42, tile: int = 1024
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row.

    Components link fingerprints that differ in at most ``radius`` bits, chains
    included. Null or wordless text has fingerprint zero, linked like any
    other. ``component_id`` is the smallest non-null id of the component (null
    if it has none). Repeated rows stay; an empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, doc_id, text, words, seed), "simhash")
    rooted = materialize(_rooted(fps, radius, tile), "components")
    lowest = with_lowest(rooted, "root", "low", rooted.count()).select("fp", "n", F.col("m").alias("low"))
    found = meet(fps, lowest, "fp", fps.count())
    return found.select(
        F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("low").alias("component_id")
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3, seed: int = 42, tile: int = 1024
) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that of the smallest id (nulls last, then by a digest of the row)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    uid = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit("/"), F.hex(F.xxhash64(whole)))
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), uid.alias("uid"))
    fps = materialize(fingerprints(docs.select(key.alias("key"), F.col(text).alias("text")), "key", "text", words, seed), "simhash")
    firsts = _rooted(fps, radius, tile).groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.uid").alias("uid"))
    kept = docs.select(uid.alias("uid"), whole.alias("row")).join(firsts, "uid", "left_semi")
    # rows that are the same throughout share their uid: one of them stays
    return kept.groupBy("uid").agg(F.first("row").alias("row")).select("row.*")
