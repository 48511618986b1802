"""Interpolated modified Kneser-Ney n-gram model, counted in Spark.

Words are numbered by their rank in the sorted array of word hashes; a
bigram is the pair of its words' numbers in one 64-bit key, a longer n-gram
is known by a 64-bit hash of its words' numbers. Tasks count their own
n-grams, sort them and send one packed block to each shard; a shard merges
its blocks into sorted arrays in the shared checkpoint folder. Scoring
workers memory-map the arrays and search them with sorted batches, so neither
the driver nor one task ever holds the model.

For an n-gram w after the words h, with h' for h without its first word:
p(w|h) = max(c(h,w) - D(c(h,w)), 0) / c(h) + g(h) * p(w|h'). The longest
n-grams have counts, all shorter ones continuation counts (how many words were
seen before them); single words are interpolated with the uniform distribution
over the V words and one unknown. Texts begin with as many ends as a context is long.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import blob_batch, blob_schema, fold, open_array, save_array, shared_folder, ship, slices, strings
from layercake.llm.tokenize import Memo

#: Stands for the end of a text as a word and, as a context, for its beginning; no text holds it.
END = ""


def words_of(text: str) -> list[str]:
    """A-Z lower-cased, words between ASCII white space, then the end."""
    return [w.decode() for w in text.encode().lower().split()] + [END]


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def _pack(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Number of rows and bytes of a count, the columns (numbers that compress), the counts (64 bits only where a block needs them)."""
    width = 8 if len(counts) and int(counts.max()) >> 32 else 4
    return b"".join([np.array([len(counts), width], "<u8").tobytes(), *[x.tobytes() for x in columns], counts.astype(f"<u{width}").tobytes()])


def _unpack(block: bytes, columns: int, kind: str = "<u4") -> tuple[list[np.ndarray], np.ndarray]:
    n, width = map(int, np.frombuffer(block, "<u8", 2))
    size = np.dtype(kind).itemsize
    return [np.frombuffer(block, kind, n, 16 + size * n * i) for i in range(columns)], np.frombuffer(block, f"<u{width}", n, 16 + size * n * columns).astype(np.int64)


def _halves(keys: np.ndarray) -> list[np.ndarray]:
    """High and low halves of 64-bit keys."""
    both = keys.view("<u4").reshape(-1, 2)
    return [both[:, 1], both[:, 0]]


def _joined(halves: list[np.ndarray]) -> np.ndarray:
    return (halves[0].astype(np.uint64) << np.uint64(32)) | halves[1].astype(np.uint64)


def _stored(counts: np.ndarray) -> np.ndarray:
    """Counts as 32 bits where all of them fit, else as 64."""
    return counts.astype(np.uint32 if not len(counts) or int(counts.max()) >> 32 == 0 else np.int64)


@dataclass(frozen=True)
class Grams:
    """How n-grams of one length are keyed and sent: pairs of 32-bit numbers are their own keys, all others are hashed."""

    length: int
    wide: bool  # word numbers need 64 bits

    @property
    def exact(self) -> bool:
        return self.length == 2 and not self.wide

    @property
    def kind(self) -> str:
        return "<u8" if self.wide else "<u4"

    def keys(self, columns: list[np.ndarray]) -> np.ndarray:
        if self.exact:
            return _joined(columns)
        key = np.zeros(len(columns[0]), np.uint64)
        for x in columns:
            key = (key ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(29)
        return key

    def summed(self, columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Distinct n-grams in the order of their keys: keys, columns, sums of counts (None: each counts one)."""
        keys = self.keys(columns)
        if self.exact:
            keys, counts = np.unique(keys, return_counts=True) if counts is None else _sum_by_key(keys, counts)
            return keys, _halves(keys), counts
        counts = np.ones(len(keys), np.int64) if counts is None else counts
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = _firsts(keys)
        return keys[first], [x[order[first]] for x in columns], np.add.reduceat(counts, first) if len(first) else counts

    def blocks(self, columns: list[np.ndarray], counts: np.ndarray, shards: int, kind: int = 0):
        """Rows ``(shard, kind, block)``, n-grams by key within a block."""
        keys, columns, counts = self.summed(columns, counts)
        where = _by_mix(keys, shards)
        order = np.argsort(where, kind="stable")
        cut = np.flatnonzero(np.diff(where[order])) + 1
        return [(int(where[p[0]]), kind, _pack([x[p].astype(self.kind) for x in columns], counts[p])) for p in np.split(order, cut) if len(p)]

    def merged(self, blocks: list[tuple[int, bytes]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        parts = [_unpack(b, self.length, self.kind) for _, b in blocks]
        return self.summed([np.concatenate([c[i] for c, _ in parts]) for i in range(self.length)], np.concatenate([n for _, n in parts]))


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = _firsts(keys)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each value of sorted keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _mix(keys: np.ndarray) -> np.ndarray:
    """A spread of 64-bit keys over shards that no one word dominates."""
    x = keys * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def _by_mix(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(keys) % np.uint64(shards)).astype(np.int64)


def _blocks(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, kind: int = 0):
    """Rows ``(shard, kind, block)``, keys sorted within a block."""
    keys, counts = _sum_by_key(keys, counts) if len(keys) else (keys, counts)
    where = shard(keys)
    order = np.argsort(where, kind="stable")
    cut = np.flatnonzero(np.diff(where[order])) + 1
    return [(int(where[part[0]]), kind, _pack(_halves(keys[part]), counts[part])) for part in np.split(order, cut) if len(part)]


def _by_hash(shards: int):
    """Shard = leading part of the hash, so that shards in order are sorted throughout."""
    return lambda keys: ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _merge(blocks: DataFrame, shards: int, write, schema: str) -> DataFrame:
    """One call of ``write(shard, [(kind, block), ...])`` for each shard; its results as rows."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:  # a task is one shard
            for shard, kind, block in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "data"))):
                held.setdefault(shard, []).append((kind, block))
        for shard in sorted(held):
            yield write(shard, held.pop(shard))

    return blocks.repartitionById(shards, F.col("shard")).mapInArrow(run, schema)


def _distinct_sum(blocks: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpack(b, 2) for _, b in blocks]
    return _sum_by_key(np.concatenate([_joined(k) for k, _ in parts]), np.concatenate([c for _, c in parts]))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers the scores need."""

    folder: str
    shards: int
    order: int
    wide: bool
    n_words: int  # V, the end included
    n_tokens: int  # N
    n_pairs: int  # distinct bigrams
    gram_discounts: tuple[tuple[float, float, float], ...]  # of bigrams, trigrams, ...
    word_discounts: tuple[float, float, float]
    word_backoff: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more.

    The usual estimates from counts of counts; where one can't be made or
    leaves its range (0, count), as on very small tables, it is half the count.
    """
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
    return tuple(d if 0 < d < k else k / 2 for d, k in zip(raw, (1, 2, 3)))


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


class Words:
    """Numbers of words: rank of the hash in the sorted shards; -1 for words that were not seen."""

    def __init__(self, folder: str, shards: int, totals: list[int]):
        self.shards = [open_array(folder, f"words-{s}") if n else np.zeros(0, np.uint64) for s, n in enumerate(totals)]
        self.start = np.concatenate([[0], np.cumsum(totals)]).astype(np.int64)
        self.shard = _by_hash(shards)

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        asked = hashes[order]
        where = self.shard(asked)
        for s in np.unique(where):
            low, high = np.searchsorted(where, [s, s + 1])
            have, part = self.shards[s], asked[low:high]
            if len(have):
                at = np.minimum(np.searchsorted(have, part), len(have) - 1)
                out[order[low:high]] = np.where(have[at] == part, self.start[s] + at, -1)
        return out


@lru_cache(maxsize=2)
def _words(folder: str, shards: int) -> Words:
    return Words(folder, shards, open_array(folder, "word-totals").tolist())


def _numbered(texts: list[str], words: Words, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens of the texts, one after another, and how many each text has."""
    memo.trim()
    cut = [words_of(t) for t in texts]
    new = list(set().union(*cut).difference(memo))
    if new:
        memo.update(zip(new, words.ranks(np.fromiter(map(_hash, new), np.uint64, len(new))).tolist()))
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    number = memo.__getitem__
    return np.fromiter((number(w) for c in cut for w in c), np.int64, int(sizes.sum())), sizes


def _before(numbers: np.ndarray, sizes: np.ndarray, end: int, back: int) -> np.ndarray:
    """The word ``back`` places before each token; before the beginning of a text it is ``end``."""
    out = np.full_like(numbers, end)
    out[back:] = numbers[:-back] if back < len(numbers) else numbers[:0]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for i in range(back):
        at = first + i
        out[at[i < sizes]] = end
    return out


def train(docs: DataFrame, text: str = "text", order: int = 2, shards: int | None = None, shard_bytes: int = 1 << 24, wide: bool | None = None) -> Model:
    """Count ``docs`` and store the model, n-grams of up to ``order`` (2 or more) words, in the shared checkpoint folder.

    ``shards``: pieces of the arrays, each one task; by default one for each
    ``shard_bytes`` of text, so a task holds as much on large tables as on small
    ones. ``wide``: word numbers of 64 bits, by default from 2**32 words on. Null
    text is empty: it counts one end. An empty table gives a model without
    words, under which every token is unknown.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark, "kneser-ney")
    source = docs.select(F.col(text).cast("string").alias("text"))
    if shards is None:
        shards = max(1, -(-(source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    by_hash = _by_hash(shards)

    def count_words(batches):
        have: Counter = Counter()

        def out():
            keys = np.fromiter(map(_hash, have), np.uint64, len(have))
            rows = _blocks(keys, np.fromiter(have.values(), np.int64, len(have)), by_hash)
            have.clear()
            return blob_batch(rows)

        for batch in slices(batches, "text"):
            for t in strings(batch.column("text")):
                have.update(words_of(t))
            if len(have) > 500_000:
                yield out()
        if have:
            yield out()

    def write_words(shard, blocks):
        keys, counts = _distinct_sum(blocks)
        save_array(folder, f"words-{shard}", keys)
        save_array(folder, f"counts-{shard}", counts)
        return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["shard", "n", "total"])

    made = _merge(source.mapInArrow(count_words, blob_schema()), shards, write_words, "shard bigint, n bigint, total bigint").collect()
    totals = np.zeros(shards, np.int64)
    for r in made:
        totals[r["shard"]] = r["n"]
    n_words, n_tokens = int(totals.sum()), sum(r["total"] for r in made)
    save_array(folder, "word-totals", totals)
    wide = n_words >> 32 > 0 if wide is None else wide
    levels = {k: Grams(k, wide) for k in range(2, order + 1)}

    def count_grams(batches):
        words, memo, grams = _words(folder, shards), Memo(None), levels[order]
        end = int(words.ranks(np.array([_hash(END)], np.uint64))[0]) if n_words else 0
        held, size = [], 0

        def out():
            columns = [np.concatenate([c[i] for c, _ in held]) for i in range(order)]
            return blob_batch(grams.blocks(columns, np.concatenate([n for _, n in held]), shards))

        for batch in slices(batches, "text"):
            numbers, sizes = _numbered(strings(batch.column("text")), words, memo)
            columns = [_before(numbers, sizes, end, back).astype(grams.kind) for back in range(order - 1, 0, -1)] + [numbers.astype(grams.kind)]
            _, columns, n = grams.summed(columns)
            held.append((columns, n))
            size += len(n)
            if size > 12_000_000 // order:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def write_grams(shard, blocks, grams):
        keys, columns, counts = grams.merged(blocks)
        save_array(folder, f"grams{grams.length}-{shard}", keys)
        save_array(folder, f"counts{grams.length}-{shard}", _stored(counts))
        rows = []
        # of each context: its tokens and how many of its followers were seen once, twice, more often
        context = levels[grams.length - 1].keys(columns[:-1]) if grams.length > 2 else columns[0].astype(np.uint64)
        deal = (lambda k: _by_mix(k, shards)) if grams.length > 2 else (lambda k: _range(k, n_words, shards))
        for kind, n in ((0, counts), (1, (counts == 1).astype(np.int64)), (2, (counts == 2).astype(np.int64)), (3, (counts >= 3).astype(np.int64))):
            rows += _blocks(context[n > 0], n[n > 0], deal, kind)
        # of each shorter n-gram: the words seen before it
        one = np.ones(len(keys), np.int64)
        rows += levels[grams.length - 1].blocks(columns[1:], one, shards, 4) if grams.length > 2 else _blocks(columns[1].astype(np.uint64), one, deal, 4)
        seen = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        rows.append((-1, shard, np.array([len(keys), *seen], "<i8").tobytes()))
        return blob_batch(rows)

    def write_contexts(shard, blocks, length):
        """Sorted keys of the contexts of n-grams of ``length`` words, and their four numbers."""
        of = [[b for b in blocks if b[0] == kind] for kind in range(4)]
        keys, total = _distinct_sum(of[0])
        stats = np.zeros((len(keys), 4), np.int64)
        stats[:, 0] = total
        for kind in (1, 2, 3):
            if of[kind]:
                some, n = _distinct_sum(of[kind])
                stats[np.searchsorted(keys, some), kind] = n
        save_array(folder, f"heads{length}-{shard}", keys)
        save_array(folder, f"contexts{length}-{shard}", stats)
        return pa.RecordBatch.from_arrays([pa.array([len(keys)])], ["n"])

    gram_discounts = []
    blocks = source.mapInArrow(count_grams, blob_schema())
    for length in range(order, 1, -1):
        written = _merge(blocks, shards, lambda shard, held, grams=levels[length]: write_grams(shard, held, grams), blob_schema())
        blobs = shared_folder(spark, "kneser-ney-contexts")
        written.write.parquet(blobs)
        written = spark.read.schema(blob_schema()).parquet(blobs)
        seen = sum((np.frombuffer(r["data"], "<i8") for r in written.where("shard = -1").collect()), np.zeros(5, np.int64))
        gram_discounts.insert(0, discounts(*map(int, seen[1:])))
        if length > 2:
            heads = written.where("shard >= 0 and kind < 4")
            _merge(heads, shards, lambda shard, held, length=length: write_contexts(shard, held, length), "n bigint").agg(F.sum("n")).collect()
            blocks = written.where("shard >= 0 and kind = 4")

    def write_words_seen(shard, blocks):
        low, high = _bounds(shard, n_words, shards)
        stats = np.zeros((5, high - low), np.int64)
        for kind, block in blocks:
            halves, counts = _unpack(block, 2)
            np.add.at(stats[kind], _joined(halves).astype(np.int64) - low, counts)
        save_array(folder, f"contexts-{shard}", np.ascontiguousarray(stats.T))
        c = stats[4]
        return pa.RecordBatch.from_arrays([pa.array([int((c == k).sum())]) for k in (1, 2, 3, 4)] + [pa.array([int((c > 2).sum())])], ["n1", "n2", "n3", "n4", "more"])

    rows = _merge(written.where("shard >= 0"), shards, write_words_seen, "n1 bigint, n2 bigint, n3 bigint, n4 bigint, more bigint").collect()
    n1, n2, n3, n4, more = (sum(r[i] for r in rows) for i in range(5))
    word_discounts = discounts(n1, n2, n3, n4)
    spent = word_discounts[0] * n1 + word_discounts[1] * n2 + word_discounts[2] * more
    return Model(
        folder, shards, order, wide, n_words, n_tokens, int(seen[0]), tuple(gram_discounts), word_discounts, spent / seen[0] if seen[0] else 1.0
    )


def _bounds(shard: int, n: int, shards: int) -> tuple[int, int]:
    step = -(-n // shards) if n else 1
    return min(n, shard * step), min(n, (shard + 1) * step)


def _range(keys: np.ndarray, n: int, shards: int) -> np.ndarray:
    return (keys // np.uint64(-(-n // shards) if n else 1)).astype(np.int64)


class Scorer:
    """Token log-probabilities from the mapped arrays."""

    def __init__(self, model: Model):
        self.m, self.words = model, _words(model.folder, model.shards)
        self.memo = Memo(None)
        self.end = int(self.words.ranks(np.array([_hash(END)], np.uint64))[0]) if model.n_words else -1

    def _gather(self, name: str, numbers: np.ndarray, step: np.ndarray, width: int = 0) -> np.ndarray:
        """Rows of an array kept in pieces, for sorted numbers; ``step``: where each piece begins."""
        out = np.zeros((len(numbers), width) if width else len(numbers), np.int64)
        where = np.searchsorted(step, numbers, side="right") - 1
        for s in np.unique(where):
            low, high = np.searchsorted(where, [s, s + 1])
            out[low:high] = open_array(self.m.folder, f"{name}-{s}")[numbers[low:high] - step[s]]
        return out

    def _found(self, keys_of: str, values_of: str, keys: np.ndarray, width: int = 0) -> np.ndarray:
        """Values stored beside sorted keys in shards, 0 for keys that are not there; ``keys`` may repeat."""
        some, of = np.unique(keys, return_inverse=True)
        out = np.zeros((len(some), width) if width else len(some), np.int64)
        where = _by_mix(some, self.m.shards)
        order = np.argsort(where, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if len(order) else ():
            s = int(where[part[0]])
            have = _piece(self.m.folder, f"{keys_of}-{s}")
            if have is None or not len(have):
                continue
            at = np.minimum(np.searchsorted(have, some[part]), len(have) - 1)
            hit = have[at] == some[part]
            out[part[hit]] = open_array(self.m.folder, f"{values_of}-{s}")[at[hit]]
        return out[of]

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, unigram log10 with half-counts, and the model's log10."""
        m = self.m
        numbers, sizes = _numbered(texts, self.words, self.memo)
        before = {back: _before(numbers, sizes, self.end, back) for back in range(1, m.order)}
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        distinct, back = np.unique(numbers, return_inverse=True)
        known = distinct >= 0
        count = np.zeros(len(distinct), np.int64)
        stats = np.zeros((len(distinct), 5), np.int64)
        if known.any():
            count[known] = self._gather("counts", distinct[known], self.words.start[:-1], 0)
            step = np.array([_bounds(s, m.n_words, m.shards)[0] for s in range(m.shards)])
            stats[known] = self._gather("contexts", distinct[known], step, 5)
        base = np.log10((count + 0.5) / (m.n_tokens + 0.5 * (m.n_words + 1)))
        uniform = 1.0 / (m.n_words + 1)
        cont = stats[:, 4]
        p_word = np.maximum(cont - _discount(cont, m.word_discounts), 0) / max(1, m.n_pairs) + m.word_backoff * uniform
        p, ok = p_word[back], numbers >= 0
        for length in range(2, m.order + 1):
            grams, d = Grams(length, m.wide), m.gram_discounts[length - 2]
            if length == 2:  # contexts: the words themselves and, at the beginning of a text, the end
                at = np.minimum(np.searchsorted(distinct, before[1]), len(distinct) - 1)
                head, known_head = stats[at, :4], before[1] >= 0
            else:
                context = [before[k] for k in range(length - 1, 0, -1)]
                known_head = np.all([x >= 0 for x in context], axis=0)
                head = np.zeros((len(numbers), 4), np.int64)
                head[known_head] = self._found(
                    f"heads{length}", f"contexts{length}", Grams(length - 1, m.wide).keys([x[known_head].astype(grams.kind) for x in context]), 4
                )
            total = head[:, 0]
            backoff = np.where(total > 0, (head[:, 1:] * np.array(d)).sum(axis=1) / np.maximum(total, 1), 1.0)
            some = ok & known_head
            columns = [before[k][some].astype(grams.kind) for k in range(length - 1, 0, -1)] + [numbers[some].astype(grams.kind)]
            c = np.zeros(len(numbers), np.int64)
            c[some] = self._found(f"grams{length}", f"counts{length}", grams.keys(columns))
            p = np.maximum(c - _discount(c, d), 0) / np.maximum(total, 1) + backoff * p
        return sizes, np.add.reduceat((count > 0)[back].astype(np.int64), first), np.add.reduceat(base[back], first), np.add.reduceat(np.log10(p), first)


@lru_cache(maxsize=4096)
def _piece(folder: str, name: str) -> np.ndarray | None:
    """A piece of the model; None where its shard got nothing."""
    try:
        return open_array(folder, name)
    except FileNotFoundError:
        return None


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every whole text.

    Null text is empty: one token, the end. Repeated rows stay.
    """

    def run(batches):
        scorer = Scorer(model)
        for batch in slices(batches, "text"):
            n, known, base, own = scorer.score(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n, known, base, own))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
