"""Prefix trie and source divergence against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from layercake.llm import prefix_trie, run_lengths
from layercake.llm.common import table
from layercake.llm.queries import op11_run_length_divergence, op13_adaptive_radix_trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def trie_by_hand(rows):
    """Nodes of (conv_id, turn, role, text) rows; ties are ordered by the turn's id, as stated."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), mark, role, text))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20
        built[c] = ts if c == base else turns.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in sorted(built.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, cs in members.items():
        own_saved = (len(cs) - 1) * len(WORDS.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own_saved
            leaves[k[:d]] += not kids[k]
    out = set()
    for k, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(built[c]) == len(k))
        out.add((cs[0], len(k), members[k[:-1]][0] if k else None, len(cs), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_trie_of_whole_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in op13_adaptive_radix_trie(spark, sf).select(COLUMNS).collect()]
    assert len(got) == len(set(got)) and set(got) == trie_by_hand(rows)


@pytest.mark.parametrize("block,salted", [(50_000, False), (3, False), (1, True)])
def test_trie_over_many_blocks(spark, monkeypatch, block, salted):
    """Groups of copies, conversations that are prefixes of others, turnless ones and one long one, cut into tiny trees."""
    pick = random.Random(block)
    rows = []
    for c in range(400):
        if c % 20 == 0 and c % 3:
            continue  # some bases are absent, so some conversations have no turn left
        kind = pick.random()
        texts = ["common first"] if kind < 0.6 else []
        texts += [f"w{pick.randrange(3)} x y"[: pick.choice([2, 4, 9])] for _ in range(pick.randrange(1, 6))]
        if kind < 0.3:
            texts = ["common first", "same", "copy  of words"]
        rows += [(c, t, pick.choice(["user", "user", None]), text) for t, text in enumerate(texts)]
    rows += [(1001, t, "user", "long") for t in range(700)] + [(1003, t, "user", "long") for t in range(700)]
    monkeypatch.setattr(prefix_trie, "BLOCK_KEYS", block)
    if salted:
        monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    keys = prefix_trie.rebuilt_nodes(spark.createDataFrame(rows, TURNS).repartition(3))
    got = [tuple(r) for r in keys.select(COLUMNS).collect()]
    assert len(got) == len(set(got)) and set(got) == trie_by_hand(rows)


def test_trie_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", ""), (0, 1, "user", ""), (0, 1, "a", "tie"), (1, 0, "user", "x" * 300_000), (None, 0, "user", "lost"),
        (2, 5, None, "a b"), (21, 0, "user", "only"), (45, 0, "user", "one"), (45, 1, "user", "two"),
    ]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS + ", key int, words int, depth int")
    assert {tuple(r) for r in prefix_trie.rebuilt_nodes(frame).select(COLUMNS).collect()} == trie_by_hand(rows)
    assert prefix_trie.rebuilt_nodes(spark.createDataFrame([], TURNS)).collect() == []


def test_radix_layouts_grow():
    """Nodes go through all four layouts, and every key is found again."""
    tree = prefix_trie.AdaptiveRadixTree()
    keys = [bytes([a, b]) * 8 for a in range(256) for b in (1, 7)]
    seen = set()
    for row, key in enumerate(keys):
        tree.insert(key, row)
        seen.add((type(tree.root.kids).__name__, getattr(tree.root.kids, "limit", 0)))
    assert seen == {("_Small", 4), ("_Small", 16), ("_Indexed", 0), ("_Full", 0)}
    for row, key in enumerate(keys):
        node, at = tree.root, 0
        while at < len(key):
            node, at = node.kids.get(key[at]), at + 1
            assert key.startswith(node.prefix, at)
            at += len(node.prefix)
        assert node.rows == [row]


def divergence_by_hand(rows, least=30, top=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))) for lang, source, text in rows]
    docs, counts = Counter(), defaultdict(Counter)
    for lang, source, terms in found:
        docs.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {k[0] for k in counts}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        columns = {s: c for (x, s), c in counts.items() if x == lang}

        def p(column):
            total = sum(column[t] for t in kept)
            return {t: 1 + 10**9 * (column[t] + 5) // (total + 5 * len(kept)) for t in kept}

        every = p(sum(columns.values(), Counter()))
        scaled = {s: p(c) for s, c in columns.items()}
        for s in columns:
            pairs = [(sum(abs(scaled[s][t] - scaled[o][t]) for t in kept), o) for o in columns if o != s]
            terms = [(scaled[s][t] - every[t], t) for t in kept if columns[s][t] and scaled[s][t] > every[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])}
    return out


DIVERGENCE = ["lang", "source", "part", "item", "value", "rank"]


def test_divergence_of_whole_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("lang", "source", "text").collect()]
    got = [tuple(r) for r in op11_run_length_divergence(spark, sf).select(DIVERGENCE).collect()]
    assert len(got) == len(set(got)) and set(got) == divergence_by_hand(rows)


def test_divergence_in_small_blocks_and_tiles(spark, sf, monkeypatch):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("lang", "source", "text").collect()]
    docs = table(spark, sf, "documents")
    pairs = run_lengths.pair_values
    monkeypatch.setattr(run_lengths, "COLUMN_COUNTS", 1)
    monkeypatch.setattr(run_lengths, "pair_values", lambda counts, groups: pairs(counts, groups, 40, 3))
    got = {tuple(r) for r in run_lengths.divergence(docs, least=3).select(DIVERGENCE).collect()}
    assert got == divergence_by_hand(rows, 3)


def test_divergence_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("lang", "source", "text").collect()]
    for least in (1, 2, 1000):
        assert {tuple(r) for r in run_lengths.divergence(odd_docs, least).select(DIVERGENCE).collect()} == divergence_by_hand(rows, least)
    assert run_lengths.divergence(no_docs).collect() == []


def test_scaled_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    cases = [(10**13 + k, 3 * 10**13 + 7 * k, 10**6 + k) for k in range(50)] + [(0, 0, 1), (0, 10**12, 3)]
    frame = spark.createDataFrame(cases, "n bigint, total bigint, v bigint").select("n", "total", "v", run_lengths._scaled(*map(F.col, ("n", "total", "v"))).alias("p"))
    assert all(r["p"] == run_lengths.scaled(r["n"], r["total"], r["v"]) for r in frame.collect())
