"""SimHash fingerprints, BK-trees and components (op 4) against brute force."""

import numpy as np
import pytest
import xxhash

from layercake.llm import simhash
from layercake.llm.common import table
from layercake.llm.components import connected_components, meet, with_lowest
from layercake.llm.queries import op4_simhash_bk_trees

from .conftest import ROWS


def fingerprint(text, words=3, seed=42):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(r, seed=seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h)) if h else 0


def components(fps, radius=3):
    """Smallest index reachable for each of a list of fingerprints."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_whole_table(spark, sf):
    docs = sorted(tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect())
    fps = [fingerprint(t) for _, t in docs]
    roots = components(fps)
    want = sorted((i, format(f, "016x"), docs[r][0]) for (i, _), f, r in zip(docs, fps, roots))
    assert sorted(tuple(r)[:3] for r in op4_simhash_bk_trees(spark, sf).collect()) == want


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [fingerprint(r[1]) for r in rows]
    want = sorted((str(r[0]), format(f, "016x"), str(rows[c][0])) for r, f, c in zip(rows, fps, components(fps)))
    assert sorted(tuple(map(str, r)) for r in simhash.near_duplicates(odd_docs).collect()) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(rows[i][0]) for i in set(components(fps)))
    assert simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("tile", [4, 64, 4096])
def test_links_of_clustered_fingerprints(spark, tile):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = set(map(int, centres)) | {0, 2**64 - 1}
    for c in centres[:4]:  # dense clusters with chains, sharing most of their bits
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 9)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    got = dict(tuple(r) for r in connected_components(simhash.link_fingerprints(df, 3, tile)).collect())
    roots = components(fps)
    groups = {}
    for s, r in zip(signed, roots):
        groups.setdefault(r, set()).add(s)
    want = {s: min(g) for g in groups.values() if len(g) > 1 for s in g}
    assert got == want


def test_forest_follows_only_edges_within_the_radius():
    rng = np.random.default_rng(5)
    fp = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
    tree = np.arange(len(fp)) % 7
    forest = simhash.build_forest(fp, tree)
    q, n = (np.concatenate(x) for x in zip(*simhash.search_forest(fp, forest, fp, tree, 24)))
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if tree[i] == tree[j] and int(np.bitwise_count(fp[i] ^ fp[j])) <= 24}
    assert set(zip(q.tolist(), n.tolist())) == want
    roots, edge, child = forest
    assert (edge % 128 == np.bitwise_count(fp[edge // 128] ^ fp[child])).all()  # an edge is its distance


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(5, 5), (None, 3), (2, 1), (1, 2)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect())
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 60)}, 1: 1, 2: 1}


def test_hub_rows_are_dealt_evenly(spark):
    """Rows of a hub stay in their tasks; all rows get the minimum of their key."""
    rows = spark.range(0, 60_000, 1, 12).selectExpr("if(id % 3 = 0, 5, id) as a", "id * 7919 % 60013 as b")
    got = with_lowest(rows, "a", "b", 60_000)
    want = rows.join(rows.groupBy("a").agg({"b": "min"}).withColumnRenamed("min(b)", "m"), "a")
    assert got.exceptAll(want).count() == 0 and got.count() == 60_000
    hub = got.where("a = 5").selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert len(hub) >= 12 and max(r["count"] for r in hub) <= 2 * 20_000 / 12
    side = rows.groupBy("a").count().withColumnRenamed("count", "n")
    assert meet(rows.limit(0), side.limit(0), "a", 0).count() == 0


def test_components_of_a_hub(spark):
    """A star of 30,000 edges, spokes with chains of their own, and no edges at all."""
    star = spark.range(10, 30_010).selectExpr("3L as a", "id as b").union(spark.range(10, 1_010).selectExpr("id as a", "id + 100000 as b"))
    got = connected_components(star)
    assert got.where("root <> 3").count() == 0 and got.count() == got.select("node").distinct().count() == 31_001
    assert connected_components(star.limit(0)).count() == 0
