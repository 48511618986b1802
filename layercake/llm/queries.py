"""The operators of this package bound to the given tables, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import bitsliced, decision_list, html_trees, importance, kneser_ney, licenses, packing, personal_data, prefix_trie, run_lengths, simhash, tokenize, toxicity
from layercake.llm.common import fold, table

BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weight of every document and whether it is sampled."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the compiled lexicon."""
    docs = table(spark, sf_dir, "documents")
    return tokenize.encode_digests(docs, tokenize.compile_lexicon(docs, BPE), BPE)


def op3_html_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_trees.extract(pages, html_trees.fit(pages))


def op4_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), BPE)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice that a document holds."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.template_rows(spark))


def op7_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the learned decision list over every document."""
    docs = table(spark, sf_dir, "documents")
    return decision_list.judge(docs, decision_list.fit(docs, table(spark, sf_dir, "labels")))


def op9_toxicity_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a model of the training fold."""
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.score(docs, kneser_ney.train(docs.where(fold(F.col("doc_id")) != 1)))


def op11_run_length_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms each uses more than its language."""
    return run_lengths.divergence(table(spark, sf_dir, "documents"))


def op12_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return personal_data.find(docs, personal_data.fit(docs)).drop("found")


def op13_adaptive_radix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.rebuilt_nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_importance_resampling, op2_bpe_transducer, op3_html_boosted_trees, op4_simhash_bk_trees, op5_vector_packing, op6_license_scan,
        op7_bit_sliced_topk, op8_decision_list, op9_toxicity_viterbi, op10_kneser_ney, op11_run_length_divergence, op12_boosted_candidates,
        op13_adaptive_radix_trie,
    )
}


def _license_sql() -> str:
    """The license scan by comparing every window with every template of its class."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    words = lambda x: (
        f"list_filter(string_split_regex(translate(lower({x}), {quote(licenses._SIGNS)}, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"
    )
    shingles = lambda w, a, b: f"list_transform(range({a}, least({b}, len({w}) - 4)), lambda i: array_to_string({w}[i + 1 : i + 5], ' '))"
    rows = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in sorted(licenses.TEMPLATES.items()))
    return f"""
        WITH v AS (SELECT license, {words("wording")} AS w FROM (VALUES {rows}) v(license, wording)),
        t AS (SELECT license, list_distinct({shingles("w", 0, "len(w)")}) AS s FROM v WHERE len(w) >= 5),
        c AS (SELECT license, s, CAST(pow(2, ceil(log2(len(s)))) AS BIGINT) AS c FROM t),
        d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
        k AS (SELECT doc_id, w, c, unnest(range(0, greatest(len(w) - 4, 0), c)) AS start FROM d, (SELECT DISTINCT c FROM c)),
        x AS (SELECT doc_id, c, start, {shingles("w", "start", "start + 2 * c")} AS h FROM k),
        m AS (
            SELECT doc_id, license, len(list_intersect(h, s)) / len(s) AS share, start
            FROM x JOIN c USING (c) WHERE len(list_intersect(h, s)) / len(s) >= 0.8
        ), b AS (SELECT license, w AS own FROM v WHERE len(w) BETWEEN 1 AND 4),
        y AS (SELECT doc_id, w, license, own, unnest(range(0, greatest(len(w) - len(own) + 1, 0))) AS i FROM d, b),
        z AS (SELECT doc_id, license, 1.0::DOUBLE AS share, greatest(i - 1, 0) AS start FROM y WHERE w[i + 1 : i + len(own)] = own)
        SELECT doc_id, license, max(share) AS containment, CAST(min(start) AS INTEGER) AS first_word
        FROM (SELECT * FROM m UNION ALL SELECT * FROM z) GROUP BY doc_id, license
    """


def _divergence_sql() -> str:
    """Counts of every kept term in every group, and all pairs of groups over all kept terms."""
    return r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents
        ), o AS (SELECT row_number() OVER () AS doc, lang, source, t FROM d),
        u AS (SELECT doc, lang, source, unnest(t) AS term FROM o),
        k AS (SELECT lang, term FROM u GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
        g AS (SELECT DISTINCT lang, source FROM o),
        n AS (SELECT lang, source, term, count(*) AS n FROM u SEMI JOIN k USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
        a AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term),
        gt AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN n USING (lang, source) GROUP BY lang, source),
        lt AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
        p AS (
            SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
                   CAST(1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 5)) // (gt.total + 5 * v.v) AS BIGINT) AS p,
                   CAST(1 + (1000000000::HUGEINT * (a.n + 5)) // (lt.total + 5 * v.v) AS BIGINT) AS q
            FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN lt USING (lang) JOIN gt USING (lang, source) JOIN a USING (lang, term)
            LEFT JOIN n USING (lang, source, term)
        ), x AS (
            SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        ), terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
    """


def _trie_sql() -> str:
    """Every prefix of every rebuilt conversation as a list of turns; subtrees by the prefixes of a node's list."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), "
        "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
    )
    words = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"
    return f"""
        WITH c AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS t
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), h AS (SELECT conv_id, t, conv_id - conv_id % 20 AS base, {crc.format("conv_id")} % 4 AS h FROM c),
        r AS (
            SELECT h.conv_id, CASE WHEN h.conv_id = h.base THEN h.t ELSE list_concat(coalesce(b.t, [])[1:h.h], h.t[h.h + 1:]) END AS t
            FROM h LEFT JOIN c b ON b.conv_id = h.base
        ), m AS (SELECT conv_id, len(t) AS size, unnest(range(0, len(t) + 1)) AS depth, t FROM r),
        n AS (
            SELECT t[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
            FROM m GROUP BY t[1:depth], depth
        ), kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        w AS (
            SELECT n.*, coalesce(kids.n_children, 0) AS n_children,
                   CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * {words.format("n.k[n.depth].text")} END AS saved
            FROM n LEFT JOIN kids ON kids.k = n.k
        ), up AS (SELECT k, saved, n_children, unnest(range(0, depth + 1)) AS d FROM w),
        s AS (SELECT k[1:d] AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM up GROUP BY k[1:d])
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, w.ends_sha256
        FROM w JOIN s ON s.k = w.k LEFT JOIN w p ON w.depth > 0 AND p.k = w.k[1:w.depth - 1]
    """


ORACLE_SQL: dict[str, str] = {
    "op11_run_length_divergence": _divergence_sql(),
    "op13_adaptive_radix_trie": _trie_sql(),
    "op6_license_scan": _license_sql(),
    "op7_bit_sliced_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 5
    """,
}
