"""Tokenising (op 2) and packing (op 5) against the tokenizers library, on whole tables and odd rows."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from layercake.llm import packing, tokenize
from layercake.llm.common import table
from layercake.llm.queries import BPE, op2_bpe_transducer, op5_vector_packing

from .conftest import ROWS

LIBRARY = Tokenizer.from_file(BPE)
LIBRARY.no_truncation()
LIBRARY.no_padding()


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    return sorted(
        ((str(i), len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids, skip_special_tokens=False))) for i, ids in ((r[0], ids_of(r[1])) for r in rows))
    )


def test_digests_equal_the_library(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted((str(r[0]), *r[1:4]) for r in op2_bpe_transducer(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == expected(docs)


@pytest.mark.parametrize("size", [0, 5, 1000])
def test_odd_rows_whatever_the_lexicon(spark, odd_docs, size):
    folder = tokenize.compile_lexicon(odd_docs, BPE, size)
    got = sorted((str(r[0]), *r[1:4]) for r in tokenize.encode_digests(odd_docs, folder, BPE).collect())
    assert got == expected(ROWS)
    whole = tokenize.encode_decode(odd_docs, folder, BPE)
    assert sorted(r["decoded"] for r in whole.collect()) == sorted(r[1] or "" for r in ROWS)
    assert sorted(r["text"] for r in tokenize.decode_ids(whole, BPE).collect()) == sorted(r[1] or "" for r in ROWS)


def test_frequent_chunks_keep_to_their_bound(spark):
    """Counts far apart, over 16 bits and tied; where ties of a count would pass the size, none of that count."""
    text = lambda n, *words: [(f" {w}" * n).strip() for w in words]
    rows = [(i, t) for i, t in enumerate(text(70_000, "a", "b") + text(66_000, "c") + text(9, "d", "e", "f") + text(2, "g") + text(1, "h"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = tokenize.count_chunks(docs).collect()
    for size in range(len(seen) + 3):
        counts = sorted((r["n"] for r in seen if r["n"] > 1), reverse=True)
        floor = counts[size - 1] if 0 < size <= len(counts) else 2 if size else None
        while floor is not None and sum(n >= floor for n in counts) > size:
            floor += 1
        assert sorted(tokenize.frequent_chunks(docs, size)) == sorted(r["chunk"] for r in seen if floor and r["n"] >= floor)


def test_empty_table(spark, no_docs):
    folder = tokenize.compile_lexicon(no_docs, BPE)
    assert tokenize.encode_digests(no_docs, folder, BPE).count() == 0
    assert packing.pack_documents(no_docs, BPE).count() == 0


def test_transducer_shares_suffixes_and_ranks_keys():
    words = [b"walking", b"talking", b"walk", b"talk", b"stalking", b"\xff\x00", b"x"]
    t = tokenize.build_transducer({w: [i, i + 1] for i, w in enumerate(words)})
    assert len(t["final"]) < len({w[:i] for w in words for i in range(len(w) + 1)})  # fewer states than a trie
    asked = words + [b"wal", b"walkings", b"", b"zzz"]
    ranks = tokenize.walk(t, asked)
    assert [sorted(words).index(w) if w in words else -1 for w in asked] == ranks.tolist()
    for i, w in enumerate(words):
        r = ranks[i]
        assert t["ids"][t["id_at"][r] : t["id_at"][r + 1]].tolist() == [i, i + 1]


def check_pieces(rows, texts):
    """texts: list of (doc_id, text). Pieces tile every document; sequences are gapless, within limits, and padded little."""
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(ids_of(t) + [0])
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0  # powers of two are not padded
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for i, docs in want.items():
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, docs))
        pieces = by_doc[i]
        for r in pieces:
            assert any(len(d) == r["doc_tokens"] and crc(d[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for d in docs)
    assert set(by_doc) == set(want)


def test_pieces_of_whole_table(spark, sf):
    texts = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    check_pieces(op5_vector_packing(spark, sf).collect(), texts)


def test_pieces_of_odd_rows(spark, odd_docs):
    check_pieces(packing.pack_documents(odd_docs, BPE).collect(), [(r[0], r[1]) for r in ROWS])


@pytest.mark.parametrize("limits", [packing.Limits(1024, 256, 10_000, 64), packing.Limits(100_000, 6, 100_000, 64), packing.Limits(100_000, 10_000, 300, 64)])
def test_conversations_keep_to_each_limit(spark, sf, limits):
    """Whole conversations of the whole table; the assistant's tokens bear loss. Each limit binds in one of the cases."""
    turns = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "role", "text").collect()]
    tokens, loss = defaultdict(int), defaultdict(int)
    for conv, role, text in turns:
        n = len((text or "").split()) + 1
        tokens[conv] += n
        loss[conv] += n if role == "assistant" else 0
    assert sum(loss.values()) and sum(loss.values()) < sum(tokens.values())
    df = spark.createDataFrame([(c, tokens[c], loss[c]) for c in tokens], "id bigint, t int, l int").coalesce(2)
    got = packing.pack_examples(df, "id", "t", "l", limits).collect()
    assert sorted((r["example_id"], r["n_tokens"], r["n_loss"]) for r in got) == sorted((c, tokens[c], loss[c]) for c in tokens)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append(r)
    for s in sequences.values():
        alone = len(s) == 1 and (s[0]["n_tokens"] > limits.tokens or s[0]["n_loss"] > limits.loss)
        assert alone or (sum(r["n_tokens"] for r in s) <= limits.tokens and len(s) <= limits.segments and sum(r["n_loss"] for r in s) <= limits.loss)
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["n_tokens"]
    within = [c for c in tokens if tokens[c] <= limits.tokens and loss[c] <= limits.loss]  # the others stand alone
    lower = max(sum(tokens[c] for c in within) / limits.tokens, sum(loss[c] for c in within) / limits.loss, len(within) / limits.segments)
    assert lower <= len(sequences) <= 1.35 * lower + 8 + len(tokens) - len(within)


def test_examples_keep_to_all_three_limits(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(rng.integers(0, 600, 800), rng.integers(0, 300, 800)))]
    rows += [(900, None, None), (None, 10, 5), (901, 5000, 10), (902, -3, 2)]
    df = spark.createDataFrame(rows, "id int, t int, l int").coalesce(2)
    limits = packing.Limits(tokens=1024, segments=6, loss=400, window=64)
    got = packing.pack_examples(df, "id", "t", "l", limits).collect()
    assert sorted(str(r["example_id"]) for r in got) == sorted(str(r[0]) for r in rows)  # every example once
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append(r)
    for s in sequences.values():
        if len(s) > 1 or s[0]["n_tokens"] <= 1024:
            assert sum(r["n_tokens"] for r in s) <= 1024 and len(s) <= 6 and sum(r["n_loss"] for r in s) <= 400
    lower = max(sum(r[1] or 0 for r in rows[:800]) / 1024, sum(r[2] for r in rows[:800]) / 400, 800 / 6)
    assert len(sequences) <= 1.25 * lower + 8
