"""Toxicity scores over text restored by a noisy-channel decoder.

A character trigram model is counted over the corpus. Written text may be
disguised: look-alike signs for letters, letters or pieces of words set apart
by spaces or dots, letters repeated. Every suspicious token, run of single
letters and run of pieces that would make a watched word becomes a lattice
(for each written character the letters it may stand for, or nothing, for each
separator nothing or the end of a word), and Viterbi takes the path that is likeliest under the character model and the channel's prices. A
token that can only be read one way is its own reading, so only suspicious
tokens are decoded. Restored words are scored by learned evidence (whole words
and their beginnings) under a logistic model of a few document totals.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from layercake.llm.common import fold, labelled_ids, open_array, save_array, shared_folder, ship, slices, strings
from layercake.llm.tokenize import Memo
from layercake.session import materialize

#: What a written sign may stand for (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "h",
}
#: Signs that may stand between letters and mean nothing (fixed values).
FILLERS = ".-_*~'’"
#: Fillers and signs that may stand for the end of a word (fixed values).
JOINERS = ".-_~"
_REOPENED = re.compile(r"[.\-_~\s]")
PRICE_LOOKALIKE, PRICE_KEPT_SIGN, PRICE_FILLER, PRICE_REPEAT, PRICE_DOUBLE = -0.7, -6.0, -0.4, -0.3, -0.1

_DOUBLED = re.compile(r"([^\W\d_])\1")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_SUSPICIOUS = re.compile(r"[0-9@$!|+€£(*#]|(.)\1\1|[^\W\d_][._~’\-][^\W\d_]")
_UNIT = r"(?:[^\W_]|[@$!|+€£(*#])"
#: Single letters or look-alikes set apart; signs and punctuation may stand before and after.
_SPACED = re.compile(rf"(?<![\w@$|+€£*#]){_UNIT}(?:[ \t.\-_*~]{{1,2}}{_UNIT}){{2,}}(?![@$!|+€£*#]*\w)")
_EDGES = " \t\n\r\x0b\x0c.,;:?\"'`´()[]{}<>«»“”„‘’…-–—_~/\\=&%^"
_SIGNS = "@$!|+*#"


# --- character model ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Characters:
    """Where the character counts are: sorted hashes of grams and their counts, in pieces by hash; ``total`` letters."""

    folder: str = ""
    shards: int = 0
    total: int = 0

    def get(self, key: str, default: int = 0) -> int:
        if not self.shards:
            return default
        h = int(np.uint64(xxhash.xxh64_intdigest(key.encode(), 42)).astype(np.int64))
        keys, counts = _piece(self.folder, h % self.shards)
        at = int(np.searchsorted(keys, h))
        return int(counts[at]) if at < len(keys) and keys[at] == h else default


@lru_cache(maxsize=4096)
def _piece(folder: str, shard: int) -> tuple[np.ndarray, np.ndarray]:
    try:
        return open_array(folder, f"keys-{shard}"), open_array(folder, f"counts-{shard}")
    except FileNotFoundError:  # no gram has this remainder
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def count_characters(docs: DataFrame, text: str = "text") -> Characters:
    """Character trigram counts over the lower-cased words of all texts, words set in '^' and '$', for letters of every script.

    Tasks add up their own counts; the sums lie in the shared checkpoint folder, sorted, and workers map them.
    """

    def run(batches):
        words: Counter = Counter()

        def out():
            grams: dict[str, int] = {}
            for word, n in words.items():
                word = word.strip(_EDGES + _SIGNS)
                if word.isalpha():
                    word = f"^^{word}$"
                    for i in range(len(word) - 2):
                        g = word[i : i + 3]
                        grams[g] = grams.get(g, 0) + n
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(grams.keys(), pa.string()), pa.array(grams.values(), pa.int64())], ["g", "n"])

        for batch in slices(batches, "text"):
            words.update(" ".join(strings(batch.column("text"))).lower().split())
            if len(words) > 1_000_000:
                yield out()
        if words:
            yield out()

    spark = docs.sparkSession
    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "g string, n bigint").groupBy("g").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "character-counts")
    folder, shards = shared_folder(spark, "characters"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = lambda kind, at, n: F.concat(F.lit(kind), F.substring("g", at, n))
    kinds = F.explode(F.array(cut("3", 1, 3), cut("b", 2, 2), cut("u", 3, 1), cut("2", 1, 2), cut("1", 2, 1)))
    sums = counts.select(kinds.alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    keyed = sums.select(F.xxhash64("gram").alias("key"), "n").withColumn("shard", F.pmod("key", F.lit(shards)))

    def write(batches):
        held = [(b.column("shard").to_numpy(), b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
        if held:
            shard, key, n = (np.concatenate(x) for x in zip(*held))
            for k in np.unique(shard):
                save_array(folder, f"keys-{k}", key[shard == k])
                save_array(folder, f"counts-{k}", n[shard == k])
            yield pa.RecordBatch.from_arrays([pa.array([len(key)], pa.int64())], ["n"])

    keyed.repartition(shards, "shard").sortWithinPartitions("key").mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return Characters(folder, shards, counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).first()[0])


class CharacterModel:
    """Interpolated trigram log-probabilities of a letter after two others, from ``Characters`` or a dictionary of trigram counts."""

    def __init__(self, counts: Characters | dict[str, int]):
        self.seen: dict[str, float] = {}
        if isinstance(counts, Characters):
            self.count, self.total = Memo(counts.get), counts.total
            return
        own: Counter = Counter()
        for g, n in counts.items():
            for key in ("3" + g, "b" + g[1:], "u" + g[2], "2" + g[:2], "1" + g[1]):
                own[key] += n
        self.count, self.total = own, sum(counts.values())

    def __call__(self, history: str, letter: str) -> float:
        """``history``: the two letters before."""
        g = history + letter
        value = self.seen.get(g)
        if value is None:
            n = self.count.__getitem__
            p = (n("u" + letter) + 0.1) / (self.total + 10)
            p = (n("b" + g[1:]) + 4 * p) / (n("1" + history[1]) + 4)
            p = (n("3" + g) + 4 * p) / (n("2" + history) + 4)
            if len(self.seen) > 1_000_000:
                self.seen.clear()
                self.count.clear() if isinstance(self.count, Memo) else None
            value = self.seen[g] = math.log(p)
        return value


class WordBonus:
    """The log-odds that complete words get, as an automaton that the lattice carries along.

    States are the beginnings of weighted words and features; a word that leaves them keeps the sum it has
    gathered, so two paths in the same state get the same bonus whatever follows, and Viterbi stays exact.
    """

    def __init__(self, weight: dict[str, float]):
        starts = {""} | {w[:k] for f in weight for w in [f.removeprefix("=")] for k in range(1, len(w) + 1)}
        number = {w: i for i, w in enumerate(sorted(starts))}
        sums = {w: sum(weight.get(w[:k], 0.0) for k in range(3, min(8, len(w)) + 1)) for w in number}
        off = {v: len(number) + i for i, v in enumerate(sorted(set(sums.values())))}
        self.step = {(number[w[:-1]], w[-1]): i for w, i in number.items() if w}
        self.left = {number[w]: off[v] for w, v in sums.items()} | {i: i for i in off.values()}
        clip = lambda x: max(0.0, min(6.0, 2.0 * x))
        self.value = {number[w]: clip(v + weight.get("=" + w, 0.0)) for w, v in sums.items()} | {i: clip(v) for v, i in off.items()}
        self.start = number[""]

    def after(self, state: int, letter: str) -> int:
        to = self.step.get((state, letter))
        return self.left[state] if to is None else to


class NoBonus:
    start, value = 0, {0: 0.0}

    def after(self, state: int, letter: str) -> int:
        return 0


def _written(path: tuple) -> str:
    """A path (the path before, last letter) as text."""
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def decode_token(written: str, model: CharacterModel, bonus: WordBonus | None = None) -> str:
    """Viterbi reading of written tokens (lower case): words set apart by single spaces; ties go to the reading that sorts first.

    States are the last two letters read, the last letter written and the word bonus's state. Each written character may be
    itself, a letter it looks like, nothing (fillers), or a repetition of the
    letter before (once more for a double letter, else nothing). A space or a joining
    filler may also end a word and begin the next; spaces vanish at no price, and so do repetitions of a sign that vanished. ``bonus``
    gives a log-odds for a complete word, such as a word known to be one.
    """
    bonus = bonus or NoBonus()

    def closed(history, state, score):
        return score + model(history, "$") + bonus.value[state]

    best: dict[tuple[str, str, int], tuple[float, tuple]] = {("^^", "", bonus.start): (0.0, ())}  # state -> score, path
    for ch in written:
        space = ch.isspace()
        options = [] if space else [(x, PRICE_LOOKALIKE) for x in LOOKALIKES.get(ch, "")]
        if space:
            options.append(("", 0.0))
        else:
            options.append((ch, 0.0 if ch.isalpha() else PRICE_KEPT_SIGN))
            if ch in FILLERS or ch in _SIGNS:
                options.append(("", PRICE_FILLER if ch in FILLERS else -1.5))
        new: dict[tuple[str, str, int], tuple[float, tuple]] = {}
        for (history, before, state), (score, path) in best.items():
            for letter, price in options:
                if letter == "":
                    if ch in _SIGNS and before == ch * 2:  # a run of one sign is one ornament
                        price = 0.0
                    steps = [(history, before if space else ch * 2, state, score + price, path)]
                    if (space or ch in JOINERS) and history != "^^":
                        steps.append(("^^", "", bonus.start, closed(history, state, score + price), (path, " ")))
                elif before == ch and history[1] == letter:
                    steps = [(history, ch, state, score + PRICE_REPEAT, path)]
                    if history != letter * 2:
                        steps.append((history[1] + letter, ch, bonus.after(state, letter), score + price + PRICE_DOUBLE + model(history, letter), (path, letter)))
                else:
                    steps = [(history[1] + letter, ch, bonus.after(state, letter), score + price + model(history, letter), (path, letter))]
                for to, last, at, value, way in steps:
                    key = (to, last, at)
                    old = new.get(key)
                    if old is None or value > old[0] or (value == old[0] and way is not old[1] and _written(way) < _written(old[1])):
                        new[key] = (value, way)
        best = new
    ends = [(v[0] if k[0] == "^^" else closed(k[0], k[2], v[0]), _written(v[1]).strip()) for k, v in best.items()]
    return min(ends, key=lambda x: (-x[0], x[1]))[1] if ends else ""


class Reach:
    """What the lattice can read at all, without prices: which features, and which words set apart into pieces."""

    def __init__(self, features: set[str], whole: set[str]):
        self.kids: list[dict[str, int]] = [{}]
        self.hit, self.end = {0: False}, {0: False}
        for f in features:
            self.hit[self._add(f.removeprefix("="))] = True
        for w in whole:
            self.end[self._add(w)] = True
        self.first = {f.removeprefix("=")[:3] for f in features}
        # how written words of letters alone can begin: the next letter, or the first one once more
        begin = lambda of: {x for w in of for x in (w[:1], w[:2], w[:1] * 2)}
        self.begin, self.begin_whole = begin({f.removeprefix("=") for f in features}), begin(whole)
        self.starts = Memo(lambda token: self.through(frozenset([0]), token if token[0].isalpha() else token.strip(_EDGES)))
        self.more = Memo(lambda pair: self.through(*pair))
        # sets of states by number, and the moves between them as they are met
        self.sets, self.number, self.moves = [frozenset(), frozenset([0])], {frozenset(): 0, frozenset([0]): 1}, {}

    def _add(self, word: str) -> int:
        at = 0
        for c in word:
            if c not in self.kids[at]:
                self.kids[at][c] = len(self.kids)
                self.kids.append({})
                self.hit[len(self.kids) - 1] = self.end[len(self.kids) - 1] = False
            at = self.kids[at][c]
        return at

    def _letters(self, at, ch: str, last: str) -> set[int]:
        new = set()
        for letter in (ch, *LOOKALIKES.get(ch, "")):
            new |= {self.kids[i][letter] for i in at if letter in self.kids[i]}
        if ch == last or ch in FILLERS or ch in _SIGNS:
            new |= at
        return new

    def _move(self, state: int, ch: str, again: bool) -> int:
        """The next set of states; -1 if a feature is reached."""
        at = self.sets[state]
        if ch.isspace():
            at = at | {0}
        else:
            at = frozenset(self._letters(at, ch, ch if again else ""))
            if any(self.hit[i] for i in at):
                return -1
            if ch in JOINERS:
                at = at | {0}
        if at not in self.number:
            self.number[at] = len(self.sets)
            self.sets.append(at)
        return self.number[at]

    def any_feature(self, written: str) -> bool:
        """Whether some reading has a feature at the beginning of one of its words."""
        state, last, moves = 1, "", self.moves
        for i, ch in enumerate(written):
            key = (state, ch, ch == last)
            state = moves.get(key)
            if state is None:
                state = moves[key] = self._move(*key)
            if state < 0:
                return True
            if not state and not _REOPENED.search(written, i):
                return False
            if not ch.isspace():
                last = ch
        return False

    def through(self, at: frozenset, token: str) -> frozenset:
        """States of words that are not over yet, after one more piece."""
        last = ""
        for ch in token:
            at = self._letters(at, ch, last)
            last = ch
            if not at:
                break
        return frozenset(at - {0})

    def trim(self) -> None:
        self.starts.trim()
        self.more.trim()
        if len(self.moves) > 500_000:
            self.moves.clear()


def readings(word: str, model: CharacterModel, bonus=None, within=None) -> str:
    """A lower-case token as it is read: its edges stripped and, if suspicious, decoded.

    Letters in a row are first cut to two, which leaves the lattice's choice as it
    is: each further one adds the same price to every path. A plain word whose only
    suspicion is a doubled letter is decoded if ``within`` says that one of its readings may matter.
    """
    core = word.strip(_EDGES)
    if not any(x.isalpha() for x in core):
        return core.strip(_SIGNS)
    if core.isalpha() and not _STRETCHED.search(core):
        if not _DOUBLED.search(core) or (within and not within(core)):
            return core
    elif not _SUSPICIOUS.search(core):
        return core.strip(_SIGNS) if not _DOUBLED.search(core) else decode_token(core, model, bonus)
    return decode_token(_STRETCHED.sub(r"\1\1", core), model, bonus)


def spaced_runs(text: str) -> list[str]:
    """Letters set apart by single separators, joined: 'x y z' is read as 'xyz'."""
    return [re.sub(r"[ \t.\-_~]", "", m.group()) for m in _SPACED.finditer(text)]


def spaced_texts(text: str) -> list[str]:
    """The runs as written, for the lattice; its separators may vanish or end words."""
    return [" ".join(run) for run in (m.group().split() for m in _SPACED.finditer(text)) if len(run) > 1 and any(x.isalpha() for y in run for x in y)]


# --- evidence -----------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """``weight``: of a feature, a whole word ('=word') or the beginning of one, for each of up to ``MOST`` words that have it."""

    characters: Characters = field(compare=False)
    weight: dict[str, float] = field(default_factory=dict)
    constant: float = 0.0


#: One feature counts at most so many distinct words of a text.
MOST = 4


def word_features(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in range(3, 9) if len(word) >= k)] if word else []


class Scorer:
    """Features and scores of texts; words are read once and remembered within a bound."""

    def __init__(self, model: Model, watched: set[str] | None = None):
        self.model, self.characters = model, CharacterModel(model.characters)
        self.watched = model.weight if watched is None else watched
        self.known = Memo(self._known)
        self.whole = {f[1:] for f in self.watched if f[0] == "=" and (not model.weight or model.weight.get(f, 0.0) > 0)}
        self.reach = Reach(set(self.watched), self.whole)
        self.bonus = WordBonus(model.weight) if model.weight else None

    def read(self, word: str) -> str:
        """The words a token or a run of pieces is read as, set apart by spaces."""
        return decode_token(word, self.characters, self.bonus) if " " in word else readings(word, self.characters, self.bonus, self.reach.any_feature if self.watched else None)

    def _known(self, word: str) -> list[tuple[str, list[str]]]:
        # a token none of whose readings has a watched feature needs no decoding: its best reading has none
        if not self.reach.any_feature(word.strip(_EDGES)):
            return []
        found = [(w, [f for f in word_features(w) if f in self.watched]) for w in self.read(word).split(" ")]
        return [x for x in found if x[1]]

    def pieces(self, tokens: list[str]) -> list[str]:
        """Neighbouring tokens, disguised or not, that can be read as one watched word, for the lattice to join or not."""
        found: list[str] = []
        if not self.whole:
            return found
        starts, more, end = self.reach.starts, self.reach.more, self.reach.end
        begin = self.reach.begin_whole
        for i in [i for i, token in enumerate(tokens) if (token[:2] in begin or not token[:2].isalpha()) and starts[token]]:
            first = tokens[i]
            at, run = starts[first], [first if first[0].isalpha() else first.strip(_EDGES)]
            for token in tokens[i + 1 :]:
                piece = token.strip(_EDGES)
                at = more[at, piece]
                if not at:
                    break
                run.append(piece)
                if any(end[k] for k in at):
                    found.append(" ".join(run))
                if piece != token:
                    break
        return found

    def words(self, text: str) -> set[str]:
        lower = text.lower()
        tokens = lower.split()
        return {*tokens, *spaced_texts(lower), *self.pieces(tokens)}

    def features(self, text: str) -> dict[str, int]:
        """For each watched feature, how many distinct words as read have it, at most ``MOST``."""
        self.known.trim()
        self.reach.trim()
        count: dict[str, int] = {}
        # a plain word without doubled letters is its own reading
        first, begin = self.reach.first, self.reach.begin
        words = [w for w in self.words(text) if w[:3] in first or not w.isalpha() or (w[:2] in begin and _DOUBLED.search(w))]
        for features in {w: x for found in map(self.known.__getitem__, words) for w, x in found}.values():
            for f in features:
                count[f] = min(MOST, count.get(f, 0) + 1)
        return count

    def score(self, text: str) -> float:
        z = self.model.constant + sum(self.model.weight[f] * n for f, n in sorted(self.features(text).items()))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def fit_sparse_logistic(x: np.ndarray, y: np.ndarray, price: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 ``price`` per row (accelerated proximal gradient); the constant is free."""
    n = len(x)
    z = x[: min(n, 512)]
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # largest eigenvalue of the second moments, for the step
        v = z.T @ (z @ v)
        v /= max(float(np.linalg.norm(v)), 1e-12)
    step = 1.0 / (0.25 * (2.0 * float(np.linalg.norm(z @ v)) ** 2 / max(1, len(z)) + 1.0))
    w, b = np.zeros(x.shape[1], np.float32), math.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    u, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        g = 1 / (1 + np.exp(-np.clip(x @ u + c, -30, 30))) - y
        w_new = u - step * (x.T @ g.astype(np.float32)) / n
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * price, 0).astype(np.float32)
        b_new = c - step * float(g.mean())
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        u, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 12_000, n_features: int = 1500, price: float = 0.022,
    doc_id: str = "doc_id", text: str = "text",
) -> Model:
    """Learn from labels of rows outside fold 0 (crc32 of the id, modulo 5) only.

    The character model counts every document outside fold 0. The evidence is
    a sparse logistic model on at most ``bound`` labelled documents, the first
    in hash order, over the ``n_features`` features that tell their two kinds
    apart best; the L1 price falls with the square root of the rows. Without labels of both kinds the score is the share of toxic labels.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ship(docs.sparkSession)
    characters = count_characters(docs.where(fold(F.col("doc_id")) != 0), "text")
    some = labelled_ids(labels.where(fold(F.col(doc_id)) != 0), label, bound, doc_id).withColumnRenamed("doc_id", "__id")
    own = materialize(docs.join(F.broadcast(some), F.col("doc_id") == F.col("__id")).select("doc_id", "label", "text"), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_good = (sum(n for k, n in sizes.items() if bool(k) == kind) for kind in (True, False))
    if not n_bad or not n_good:
        return Model(characters, {}, 30.0 if n_bad else -30.0)

    def count(batches):
        scorer = Scorer(Model(characters))
        bad, good = Counter(), Counter()
        for batch in slices(batches, "text"):
            scorer.known.trim()
            for t, kind in zip(strings(batch.column("text")), batch.column("label").to_pylist()):
                (bad if kind else good).update({f for w in {x for w in scorer.words(t) for x in scorer.read(w).split(" ")} for f in word_features(w)})
        every = sorted(bad.keys() | good.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([bad[f] for f in every], pa.int64()), pa.array([good[f] for f in every], pa.int64())], ["f", "bad", "good"]
        )

    counts = own.mapInArrow(count, "f string, bad bigint, good bigint").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    share = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    telling = counts.where("bad >= 4").withColumn("worth", (share - 1 / F.sqrt("bad")) * F.sqrt("bad")).where(share > 0.7)
    chosen = sorted(r["f"] for r in telling.orderBy(F.desc("worth"), "f").limit(n_features).collect())
    index = {f: i for i, f in enumerate(chosen)}

    def extract(batches):
        scorer = Scorer(Model(characters), set(index))
        for batch in slices(batches, "text"):
            found = [scorer.features(t) for t in strings(batch.column("text"))]
            at, n = [[index[f] for f in x] for x in found], [list(x.values()) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))], ["label", "at", "n"])

    rows = own.mapInArrow(extract, "label int, at array<int>, n array<int>").collect()
    rows.sort(key=lambda r: (r["label"], r["at"], r["n"]))
    x, y = np.zeros((len(rows), max(1, len(chosen))), np.float32), np.array([float(bool(r["label"])) for r in rows])
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["n"]
    w, b = fit_sparse_logistic(x, y, price / math.sqrt(len(rows)))
    return Model(characters, {f: float(w[i]) for f, i in index.items() if w[i]}, float(b))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every whole text; null text counts as empty; repeated rows stay."""

    def run(batches):
        scorer = Scorer(model)
        for batch in slices(batches, "text"):
            values = [scorer.score(t) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"])

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = source.mapInArrow(run, f"doc_id {source.schema[0].dataType.simpleString()}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``limit``."""
    shape = docs.schema

    def run(batches):
        scorer = Scorer(model)
        for batch in slices(batches, "text"):
            clean = [scorer.score(t) < limit for t in strings(batch.column("text"))]
            yield batch.filter(pa.array(clean, pa.bool_())).select(["row"])

    ship(docs.sparkSession)
    # the rows travel in a struct, so no column name of theirs can clash
    whole = docs.select(F.struct(*[F.col(f"`{n.replace('`', '``')}`") for n in docs.columns]).alias("row"), F.col(text).cast("string").alias("text"))
    return whole.mapInArrow(run, StructType([StructField("row", shape)])).select("row.*")
