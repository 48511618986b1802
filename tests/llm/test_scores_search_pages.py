"""LM scores (op 10), exact top-k (op 7), HTML extraction (op 3) and the pipeline."""

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from layercake.llm import bitsliced, decision_list, html_trees, kneser_ney, toxicity
from layercake.llm.common import fold, table
from layercake.llm.queries import op3_html_boosted_trees, op7_bit_sliced_topk, op10_kneser_ney

from .conftest import ROWS
from .test_rules_toxicity import base
from .test_simhash import components, fingerprint
from .test_tokenize_pack import check_pieces

END = ("end",)


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


class BruteForce:
    """Modified Kneser-Ney from plain dictionaries."""

    def __init__(self, texts):
        self.pairs, self.count = Counter(), Counter()
        for t in map(tokens, texts):
            self.count.update(t)
            self.pairs.update(zip([END, *t], t))
        self.contexts = Counter(w for _, w in self.pairs)
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.d2, self.d1 = self._discounts(self.pairs), self._discounts(self.contexts)
        self.total, self.left = Counter(), Counter()
        for (u, _), n in self.pairs.items():
            self.total[u] += n
            self.left[u] += self.d2[min(n, 3)]
        self.back = sum(self.d1[min(n, 3)] for n in self.contexts.values()) / len(self.pairs) if self.pairs else 1.0

    @staticmethod
    def _discounts(counts):
        return (0.0, *kneser_ney.discounts(*(sum(n == k for n in counts.values()) for k in (1, 2, 3, 4))))

    def word(self, w):
        c = self.contexts[w]
        return max(c - self.d1[min(c, 3)], 0) / max(1, len(self.pairs)) + self.back / (self.v + 1)

    def p(self, u, w):
        if not self.total[u]:
            return self.word(w)
        n = self.pairs[u, w]
        return max(n - self.d2[min(n, 3)], 0) / self.total[u] + self.left[u] / self.total[u] * self.word(w)

    def row(self, i, text):
        t = tokens(text)
        base_score = sum(math.log10((self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        score = sum(math.log10(self.p(u, w)) for u, w in zip([END, *t], t))
        return i, len(t), sum(self.count[w] > 0 for w in t), self.n, pytest.approx(base_score, rel=1e-9), pytest.approx(score, rel=1e-9)


def compare(got, rows):
    trained = BruteForce([t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1])
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    key = lambda r: (str(r[0]), r[1], r[2])
    got, want = sorted((tuple(r[c] for c in columns) for r in got), key=key), sorted((trained.row(i, t) for i, t in rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g == w
    return trained


def test_scores_of_whole_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    model = compare(op10_kneser_ney(spark, sf).collect(), rows)
    for u in ("the", END, "nowhere"):  # a distribution over all words and one unknown
        assert sum(model.p(u, w) for w in model.count) + model.p(u, "never seen") == pytest.approx(1)


class BruteForceN:
    """Modified Kneser-Ney of any order from plain dictionaries, by recursion."""

    def __init__(self, texts, order):
        self.order = order
        top, self.count = Counter(), Counter()
        for t in map(tokens, texts):
            self.count.update(t)
            padded = [END] * (order - 1) + t
            top.update(tuple(padded[i : i + order]) for i in range(len(t)))
        self.grams = {order: top}
        for k in range(order - 1, 0, -1):  # distinct words before each shorter n-gram
            self.grams[k] = Counter(g[1:] for g in self.grams[k + 1])
        self.d = {k: (0.0, *kneser_ney.discounts(*(sum(n == i for n in g.values()) for i in (1, 2, 3, 4)))) for k, g in self.grams.items()}
        self.total, self.left = Counter(), Counter()
        for k, g in self.grams.items():
            for x, n in g.items():
                self.total[k, x[:-1]] += n
                self.left[k, x[:-1]] += self.d[k][min(n, 3)]

    def p(self, h, w):
        k = len(h) + 1
        lower = self.p(h[1:], w) if h else 1 / (len(self.count) + 1)
        total = self.total[k, h]
        if not total:
            return lower
        n = self.grams[k][*h, w]
        return max(n - self.d[k][min(n, 3)], 0) / total + self.left[k, h] / total * lower

    def score(self, text):
        t = tokens(text)
        padded = [END] * (self.order - 1) + t
        return sum(math.log10(self.p(tuple(padded[i : i + self.order - 1]), w)) for i, w in enumerate(t))


@pytest.mark.parametrize("order, wide", [(2, True), (3, False), (3, True), (4, False)])
def test_scores_of_longer_n_grams(spark, sf, order, wide):
    docs = table(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    trained = BruteForceN([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1], order)
    model = kneser_ney.train(docs.where(fold(kneser_ney.F.col("doc_id")) != 1), order=order, wide=wide, shard_bytes=1 << 17)
    assert model.shards > 1
    got = {r["doc_id"]: r["score"] for r in kneser_ney.score(docs, model).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, text in rows:
        assert got[i] == pytest.approx(trained.score(text), rel=1e-9)


def test_odd_rows_at_order_three(spark, odd_docs, no_docs):
    model = kneser_ney.train(odd_docs, order=3, shards=3)
    trained = BruteForceN([r[1] for r in ROWS], 3)
    got = sorted(r["score"] for r in kneser_ney.score(odd_docs, model).collect())
    assert got == pytest.approx(sorted(trained.score(r[1]) for r in ROWS), rel=1e-9)
    assert kneser_ney.score(no_docs, kneser_ney.train(no_docs, order=3)).count() == 0


def test_counts_beyond_32_bits_are_kept():
    keys, counts = np.array([5, 1 << 40], np.uint64), np.array([7, 1 << 33], np.int64)
    halves, back = kneser_ney._unpack(kneser_ney._pack(kneser_ney._halves(keys), counts), 2)
    assert kneser_ney._joined(halves).tolist() == keys.tolist() and back.tolist() == counts.tolist()
    assert kneser_ney._stored(counts).tolist() == counts.tolist() and kneser_ney._stored(counts[:1]).itemsize == 4


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    trained = kneser_ney.train(odd_docs.where(fold(kneser_ney.F.col("doc_id")) != 1), shards=3)
    compare(kneser_ney.score(odd_docs, trained).collect(), [(r[0], r[1]) for r in ROWS])
    empty = kneser_ney.train(no_docs)
    assert kneser_ney.score(no_docs, empty).count() == 0
    unknown = kneser_ney.score(odd_docs, empty).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in unknown)


# --- exact top-k --------------------------------------------------------------------------------------------------


def brute_top(rows, k, every):
    rows = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in rows), default=0)
    q = [(i, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, v in rows]
    out = []
    for i in sorted({i for i, _ in q if i % every == 0}):
        query = min((v, e) for (j, e), (_, v) in zip(q, rows) if j == i)[1]
        scores = sorted((-sum(a * b for a, b in zip(query, e)), j) for j, e in q if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return out


def test_top_k_of_whole_table(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, sf, "embeddings").collect()]
    assert sorted(tuple(r) for r in op7_bit_sliced_topk(spark, sf).collect()) == brute_top(rows, 5, 50)


@pytest.mark.parametrize("coarse", [0, 2, 6])
def test_top_k_of_odd_vectors(spark, coarse):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    rows += [(i, [1.0, -2.0, 0.5, 0.0, 0.0, 3.0]) for i in range(60, 90)] * 2  # ties and repeated rows
    rows += [(100, None), (101, [None] * 6), (102, [float("nan")] * 6), (103, [float("inf"), *[0.0] * 5]), (None, [1.0] * 6), (104, [2.0]), (105, []), (110, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as score", "2 as block", "3 as rank")
    rows = [(r[0], r[1]) for r in df.collect()]
    got = bitsliced.search(df, df.where("vec_id % 10 = 0"), 5, block_rows=40, coarse=coarse)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5, 10)
    few = df.where("vec_id in (0, 3)")
    assert [tuple(r)[:3] for r in bitsliced.search(few, few.where("vec_id = 0"), 5).collect()] == [(0, 1, 3)]
    assert bitsliced.search(df.limit(0), df.limit(0)).count() == 0


# --- pages --------------------------------------------------------------------------------------------------------


def article(page):
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)\b[^>]*(?:>|\Z)", m[1]) if m else []
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", x)).split()) for x in parts)
    return "\n".join(x for x in texts if x)


def test_main_text_of_whole_table(spark, sf):
    pages = {r["page_id"]: r["html"] for r in table(spark, sf, "pages").collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op3_html_boosted_trees(spark, sf).collect()}
    assert got == {i: (article(h), len(article(h))) for i, h in pages.items()}


def test_unmarked_pages_and_odd_rows(spark, sf):
    trees = html_trees.fit(table(spark, sf, "pages"))
    page = (
        '<html><body><div class="top-menu"><a href=x>Home</a> <a href=y>News</a></div><div id="wrap"><div class="left"><h1>My &amp; title</h1>'
        "<p>This is a long paragraph of the text, with several words.\n It goes on and on.</p><div class='cookie-notice'>We use cookies here.</div>"
        "<p>Second paragraph&nbsp;of the text, which is fine too, and long <b>enough.</p></div><div class=sidebar><p>Other stuff to read here.</p><a href=z>more</a></div>"
        '<div class="comments"><p>First! I totally agree with this text, thanks.</p></div></div><div class="footer">Copyright 2020</div></body></html>'
    )
    want = "My & title\nThis is a long paragraph of the text, with several words. It goes on and on.\nSecond paragraph of the text, which is fine too, and long enough."
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    odd = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "no tags at all"), (4, "w", "<p>&am"), (5, "w", "<"), (6, "w", "<a href='x"), (7, "w", deep), (8, "w", "<script>if (a<b)"), (9, "w", "</div></p><!-- x")]
    df = spark.createDataFrame(odd, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = html_trees.extract(df, trees).collect()
    assert len(got) == len(odd) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 1] == [want, want]
    assert html_trees.extract(df.limit(0), trees).count() == 0
    assert all(r["text"] == "" for r in html_trees.extract(df, html_trees.fit(df.limit(0))).collect())


def test_decoding_never_contradicts_itself():
    rng = np.random.default_rng(9)
    for _ in range(50):
        nodes = [html_trees.Node("div", -1, 0, frozenset(), 0)]
        for i in range(1, 40):
            nodes.append(html_trees.Node("div", int(rng.integers(i)), 0, frozenset(), 0, own=int(rng.integers(200))))
        inside = html_trees.decode(nodes, rng.normal(scale=4, size=40))
        state = []
        for i, x in enumerate(nodes):  # outside, then inside, then cut: never back
            above = state[x.parent] if i else 0
            state.append(1 if inside[i] else 2 if above else 0)
            assert not (above == 2 and inside[i])


# --- pipeline -----------------------------------------------------------------------------------------------------


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "near_duplicates", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "packing":
            assert out.columns == docs.columns
            left = {r["doc_id"]: r["text"] for r in out.collect()}
            assert left.items() <= rows.items()
        if name == "quality_rules":
            verdicts = {r["doc_id"]: r["kept"] for r in decision_list.judge(docs, decision_list.fit(docs, labels)).collect()}
            assert set(left) == {i for i in rows if verdicts[i]} and not any(base(rows[i])[5] for i in left)
        elif name == "toxicity":
            scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
            assert set(left) == {i for i in rows if scores[i] < 0.5}
        elif name == "near_duplicates":
            ids = sorted(rows)
            assert set(left) == {ids[c] for c in components([fingerprint(rows[i]) for i in ids])}
        else:
            check_pieces(out.collect(), list(rows.items()))
        docs = out


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs_out = stage(spark, docs, sf)
            assert docs_out.columns == docs.columns
            docs_out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).count()
