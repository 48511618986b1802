"""Divergence between the sources of a language over run-length columns.

Every (language, source) group is a column of term counts over the kept
vocabulary of its language. The vocabulary is dealt into blocks of terms of similar frequency
and, inside a block, reordered so that equal counts lie side by side; each
column is run-length encoded there, zeros included. Two columns are compared
by intersecting their run boundaries: on a common run the difference of their
scaled probabilities is one number, taken times the length of the run. Block
sums add up, so any number of tasks shares a pair, and no task holds a whole
vocabulary or all sources of a language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import ship, slices, strings
from layercake.session import materialize

SCALE = 1_000_000_000
#: Added to each count.
ADDED = 5
#: A block holds about so many non-zero counts a column of its language, and at least so many in all; columns of a tile.
COLUMN_COUNTS, BLOCK_COUNTS, TILE = 2_000, 50_000, 128
#: Columns by whose counts the terms of a block are ordered.
_LEADING = 32
#: Upper-case ASCII letters lowered; every ASCII byte that is no letter separates (fixed by the term rule ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``).
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and characters beyond ASCII, only A-Z lower-cased, in UTF-8."""
    return text.encode().translate(_FOLD).split()


def scaled(count: int, total: int, size: int) -> int:
    """p of a count in a column of ``total`` occurrences over ``size`` terms, exact."""
    return 1 + SCALE * (count + ADDED) // (total + ADDED * size)


def _scaled(count: Column, total: Column, size: Column) -> Column:
    wide = (count + ADDED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(18,0)")
    return F.call_function("div", wide, (total + ADDED * size).cast("decimal(38,0)")) + 1


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` counted by tasks, in pieces of bounded size (a term may come in several rows)."""

    def run(batches):
        held: dict[tuple[str, str], tuple[list, list]] = {}
        size = 0

        def out():
            for rows in _pieces(held):
                yield rows
            held.clear()

        for batch in slices(batches, "text"):
            for lang, source, text in zip(*(strings(batch.column(c)) for c in ("lang", "source", "text"))):
                terms = terms_of(text)
                every, each = held.setdefault((lang, source), ([], []))
                every += terms
                each += set(terms)
                size += len(terms)
                if size > 3_000_000:
                    yield from out()
                    size = 0
        yield from out()

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _pieces(held, step: int = 100_000):
    names = list(held)
    of, terms, n, docs = [], [], [], []

    def batch():
        at = pa.array(np.repeat(np.arange(len(of)), [k for _, k in of]), pa.int32())
        columns = [pa.DictionaryArray.from_arrays(at, pa.array([names[i][c] for i, _ in of], pa.string())).cast(pa.string()) for c in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            ["lang", "source", "term", "n", "docs"],
        )

    for i, name in enumerate(names):
        every, each = Counter(held[name][0]), Counter(held[name][1])
        of.append((i, len(every)))
        terms += every
        n += every.values()
        docs += [each[t] for t in every]
        if len(terms) >= step:
            yield batch()
            of, terms, n, docs = [], [], [], []
    if terms:
        yield batch()


def run_lengths(at: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the runs of a column of ``size`` terms that holds ``counts`` at the sorted positions ``at`` and zeros elsewhere."""
    after = at + 1
    start = np.unique(np.concatenate([[0], at, after[after < size]])).astype(np.int64)
    value = np.zeros(len(start), np.int64)
    if len(at):
        near = np.minimum(np.searchsorted(at, start), len(at) - 1)
        value = np.where(at[near] == start, counts[near], 0)
    new = np.concatenate([[True], value[1:] != value[:-1]])
    return start[new], value[new]


def reordered(term: np.ndarray, column: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """New positions of the terms 0..k: ordered by their counts in the heaviest columns, so that equal counts are neighbours."""
    size = int(term.max()) + 1
    weight = np.bincount(column, counts)
    keys = np.zeros((min(_LEADING, len(weight)), size), np.int64)
    for k, c in enumerate(np.argsort(-weight, kind="stable")[: len(keys)]):
        mine = column == c
        keys[k, term[mine]] = counts[mine]
    position = np.empty(size, np.int64)
    position[np.lexsort(keys[::-1])] = np.arange(size)
    return position


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """Sum of abs(p - q) over two columns of (run starts, value of each run): boundaries intersected, value times run length."""
    start = np.union1d(a[0], b[0])
    length = np.diff(start, append=size)
    p, q = (x[1][np.searchsorted(x[0], start, side="right") - 1] for x in (a, b))
    return int((np.abs(p - q) * length).sum())


def _encode_block(table: pa.Table) -> pa.Table:
    source = table.column("source").combine_chunks().dictionary_encode()
    if isinstance(source, pa.ChunkedArray):
        source = source.combine_chunks()
    term = table.column("term").combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    column, code = source.indices.to_numpy(), term.indices.to_numpy()
    counts = table.column("n").to_numpy()
    at = reordered(code, column, counts)[code]
    size = len(term.dictionary)
    order = np.lexsort((at, column))
    cut = np.flatnonzero(np.diff(column[order])) + 1
    rows = []
    for part in np.split(order, cut):
        start, value = run_lengths(at[part], counts[part], size)
        rows.append((source.dictionary[int(column[part[0]])].as_py(), start, value))
    k = len(rows)
    key = [table.column(c)[0].as_py() for c in ("lang", "band", "bucket")]
    return pa.table({
        "lang": pa.array([key[0]] * k, pa.string()), "band": pa.array([key[1]] * k, pa.int32()), "bucket": pa.array([key[2]] * k, pa.int64()),
        "size": pa.array([size] * k, pa.int64()), "source": pa.array([r[0] for r in rows], pa.string()),
        "starts": pa.array([r[1] for r in rows], pa.list_(pa.int64())), "counts": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
    })


def _compare_tiles(table: pa.Table) -> pa.Table:
    size, vocabulary, i, j = (table.column(c)[0].as_py() for c in ("size", "v", "i", "j"))
    columns = []
    for source, tile, total, starts, counts in zip(*(table.column(c).to_pylist() for c in ("source", "tile", "total", "starts", "counts"))):
        value = {c: scaled(c, total, vocabulary) for c in set(counts or (0,))}
        columns.append((source, tile, (np.array(starts or [0], np.int64), np.array([value[c] for c in counts or (0,)], np.int64))))
    columns.sort(key=lambda c: c[0].encode())
    out = []
    for x, (a, tile, runs) in enumerate(columns):
        for b, other, more in columns[x + 1 :]:
            if i == j or tile != other:
                out.append((a, b, difference(runs, more, size)))
    a, b, f = zip(*out) if out else ((), (), ())
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * len(out), pa.string()),
        "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "f": pa.array(f, pa.int64()),
    })


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """``(lang, term, source, n, all_n, lead)`` of the terms in at least ``least`` documents of their language.

    ``all_n``: occurrences in the language; ``lead`` marks one row of each term. One shuffle, by term.
    """
    same = Window.partitionBy("lang", "term")
    counts = count_terms(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    marked = counts.select(
        "lang", "term", "source", "n", F.sum("n").over(same).alias("all_n"), F.sum("docs").over(same).alias("in_docs"),
        (F.min("source").over(same) == F.col("source")).alias("lead"),
    )
    return materialize(marked.where(F.col("in_docs") >= least).drop("in_docs"), "kept-counts")


def pair_values(counts: DataFrame, groups: DataFrame, block: int = BLOCK_COUNTS, tile: int = TILE) -> DataFrame:
    """``(lang, a, b, value)``, a < b: summed differences of all pairs of sources of a language with kept terms.

    ``counts`` from ``kept_counts``; ``groups``: lang, source, total (the column's occurrences), v (kept terms).
    """
    banded = counts.select("lang", "term", "source", "n", F.floor(F.log2("all_n")).cast("int").alias("band"))
    # stored, so that its small size is known when the join is planned and no hot band is shuffled for it
    columns = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("columns"))
    wanted = F.ceil(F.col("counts") / F.greatest(F.lit(block), F.col("columns") * COLUMN_COUNTS))
    sizes = banded.groupBy("lang", "band").agg(F.count(F.lit(1)).alias("counts")).join(columns, "lang").select("lang", "band", wanted.alias("buckets"))
    sizes = materialize(sizes, "band-sizes")
    dealt = banded.join(sizes, ["lang", "band"]).withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")))
    key = ["lang", "band", "bucket"]
    encoded = dealt.groupBy(*key).applyInArrow(
        _encode_block, "lang string, band int, bucket bigint, size bigint, source string, starts array<bigint>, counts array<bigint>"
    )
    encoded = materialize(encoded, "run-lengths")
    tiles = columns.select("lang", F.ceil(F.col("columns") / tile).alias("tiles"))
    tiled = groups.where("v > 0").join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
    blocks = encoded.groupBy(*key).agg(F.first("size").alias("size"))  # one row a block; each meets every column of its language
    whole = blocks.join(tiled, "lang").join(encoded.drop("size"), [*key, "source"], "left")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    both = whole.withColumn("u", other).withColumns({"i": F.least("tile", "u"), "j": F.greatest("tile", "u")}).drop("u", "tiles")
    parts = both.groupBy(*key, "i", "j").applyInArrow(_compare_tiles, "lang string, a string, b string, f bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))


def divergence(
    docs: DataFrame, least: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: every other source of the language and how far the two lie
    apart over all kept terms. Part ``term``: the ``top`` terms that the source uses more than its language.
    Null lang, source and text count as empty; a language without kept terms gives its pairs value 0; an empty table gives no row.
    """
    ship(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(n) for x, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = kept_counts(docs, least)
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("lead").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "v"])
    groups = materialize(groups, "source-groups")

    found = pair_values(counts, groups)
    flat = groups.where("v = 0").select("lang", "source")
    none = flat.join(flat.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    pairs = (
        found.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
        .unionByName(found.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
        .unionByName(none)
    )
    own = counts.join(groups, ["lang", "source"])
    p, q = _scaled(F.col("n"), F.col("total"), F.col("v")), _scaled(F.col("all_n"), F.col("lang_total"), F.col("v"))
    terms = own.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    every = pairs.withColumn("rank", F.row_number().over(ranked))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(every, "pair").unionByName(columns(best, "term"))
