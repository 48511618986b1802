"""Personal data: overlapping candidate spans, judged by gradient-boosted trees with calibrated thresholds.

Fixed patterns find the base spans (e-mail addresses, IP addresses, card and
phone numbers), which always stay. Generators of high recall propose further,
overlapping spans: every window of neighbouring digit groups, dotted quads,
addresses with letters beyond ASCII or with the signs spelt out. Boosted trees give
the log-odds of a candidate from its format and its context; a threshold
a kind, calibrated on candidates the trees did not see, selects, and of
overlapping candidates of a kind the best one stays.

There are no labels of spans. The trees learn from base spans that stand
alone in the text, from the same spans written in other ways or directly
beside each other (grafts), and, as the other kind, from all other candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.boosting import binned, boost_all, cuts_of
from layercake.llm.common import fold_of, open_array, save_array, shared_folder, ship, slices, strings
from layercake.llm.html_trees import Trees
from layercake.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the base spans; possessive, so that no text makes them slow (the matches are the same).
_DOMAIN = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_REGION = re.compile(r"[0-9][ ().0-9+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(int(c) * 2 - 9 * (c > "4") for c in digits[-2::-2])) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start, then kind as listed."""
    found: list[Span] = []
    if "@" in text:
        end = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append(("email", start, end))
    for region in _REGION.finditer(text):
        low, high = region.span()
        if high - low < 3:
            continue
        piece = region.group()
        if "." in piece:
            found += [("ip", *m.span()) for m in _IP.finditer(text, low, high) if _octets(m.group())]
        if high - low >= 14:
            for m in _CARD.finditer(text, low, high):
                digits = _NO_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if low and text[low - 1] == "+" or "+" in piece:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text, max(0, low - 1), high) if 10 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return _sorted(found)


def _sorted(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- candidates ---------------------------------------------------------------------------------------------------

_GROUP = re.compile(r"[0-9]+")
_CHAIN = re.compile(r"[0-9]+(?:[ ().+/,\[\]-]{1,3}[0-9]+)*")
_SPELT = re.compile(
    r"(?:@|\s?[(\[]at[)\]]\s?|\sat\s(?=[\w-]+\sdot\s))[\w-]{1,63}(?:(?:\.|\s?[(\[]dot[)\]]\s?|\sdot\s)[\w-]{1,63})+", re.IGNORECASE
)
_WIDE_LOCAL = re.compile(r"[\w.%+'-]{1,64}\Z")
#: Most digit groups of one candidate: a phone number has no more.
_GROUPS = 7


def candidates(text: str) -> list[tuple[Span, int, int]]:
    """Spans of every kind that might be personal data, each with the numbers of digits in the groups left and right of it (0: none)."""
    out: list[tuple[Span, int, int]] = []
    low = text.lower() if "dot" in text or "DOT" in text or "Dot" in text else ""
    if "@" in text or "(at)" in text.lower() or "[at]" in text.lower() or " dot " in low:
        for m in _SPELT.finditer(text):
            head = _WIDE_LOCAL.search(text[max(0, m.start() - 64) : m.start()])
            if head:
                out.append((("email", m.start() - len(head.group()), m.end()), 0, 0))
    for chain in _CHAIN.finditer(text):
        if chain.end() - chain.start() < 7:
            continue
        groups = [(m.start() + chain.start(), m.end() + chain.start()) for m in _GROUP.finditer(chain.group())]
        sizes = [b - a for a, b in groups]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, min(len(groups), i + _GROUPS)):
                digits += sizes[j]
                if digits > 19:
                    break
                a, b = groups[i][0], groups[j][1]
                left, right = sizes[i - 1] if i else 0, sizes[j + 1] if j + 1 < len(groups) else 0
                between = [text[groups[k][1] : groups[k + 1][0]] for k in range(i, j)]
                if j - i == 3 and max(sizes[i : j + 1]) <= 3 and all(x in (".", "[.]") for x in between):
                    out.append((("ip", a, b), left, right))
                if 13 <= digits <= 19 and all(x in (" ", "-", ".") for x in between):
                    out.append((("card", a, b), left, right))
                if 7 <= digits <= 15:
                    start = a
                    if start and text[start - 1] == "(" and ")" in text[a:b]:
                        start -= 1
                    if start and text[start - 1] == "+":
                        start -= 1
                    out.append((("phone", start, b), left, right))
    return out


_WORD_BEFORE = re.compile(r"([^\s0-9]{1,24})[\s=:\"'(+]*\Z")


def word_before(text: str, start: int) -> str:
    m = _WORD_BEFORE.search(text[max(0, start - 32) : start])
    return m.group(1).lower() if m else ""


def _class(ch: str) -> int:
    """0 edge or white space, 1 punctuation, 2 quote or sign, 3 letter, 4 digit."""
    return 0 if not ch or ch.isspace() else 4 if ch.isdigit() else 3 if ch.isalpha() or ch == "_" else 1 if ch in ".,;:!?()" else 2


NAMES = (
    *KINDS, "digits", "groups", "first", "last", "largest", "smallest", "luhn", "plus", "parenthesis", "spaces", "dots", "hyphens", "others", "mixed",
    "before", "after", "left", "right", "octets", "too_large", "zero", "lead", "letters_near", "hex_near", "local", "labels", "tld", "spelt", "beyond_ascii", "evidence",
)


def features(text: str, span: Span, left: int, right: int, evidence: float) -> list[float]:
    kind, start, end = span
    piece = text[start:end]
    groups = _GROUP.findall(piece)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    marks = _GROUP.sub("", piece)
    near = text[max(0, start - 8) : start] + text[end : end + 8]
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    attached = re.search(r"\w*\Z", text[max(0, start - 20) : start]).group() + re.match(r"\w*", text[end : end + 20]).group()
    at = max(piece.find("@"), 0)
    host = piece[at:].split(".") if kind == "email" else []
    largest = max((int(g[-6:]) for g in groups), default=0) if kind == "ip" else 0
    return [
        *[float(kind == k) for k in KINDS], sum(sizes), len(groups), sizes[0], sizes[-1], max(sizes), min(sizes), float(kind != "email" and luhn(digits)) if digits else 0.0,
        float("+" in piece), float("(" in piece), piece.count(" "), piece.count("."), piece.count("-"), sum(c not in " .-" for c in marks),
        len(set(marks)), _class(before), _class(after), left, right,
        largest, float(largest > 255), float(any(len(g) > 1 and g[0] == "0" for g in groups)),
        float(digits[:1] or 0), sum(c.isalpha() for c in near), len(attached) and sum(c in "0123456789abcdefABCDEF" for c in attached) / len(attached),
        at, len(host), len(host[-1]) if host else 0, float(kind == "email" and "@" not in piece), float(not piece.isascii()), evidence,
    ]


# --- learning -----------------------------------------------------------------------------------------------------


def _alone(text: str, span: Span) -> bool:
    return _class(text[span[1] - 1 : span[1]] if span[1] else "") < 3 and _class(text[span[2] : span[2] + 1]) < 3


def written_otherwise(kind: str, piece: str) -> list[str]:
    """Other ways to write the same data."""
    if kind == "email":
        local, host = piece.rsplit("@", 1)
        return [f"{local}(at){host}", f"{local} [at] {host}", f"{local} at {host.replace('.', ' dot ')}", f"é{piece}", f"{local}[at]{host.replace('.', '[dot]')}"]
    groups = _GROUP.findall(piece)
    if kind == "ip":
        return ["[.]".join(groups)]
    digits = "".join(groups)
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [digits, " ".join(fours), "-".join(fours), ".".join(fours)]
    own, rest = digits[:-10], digits[-10:]
    parts = [p for p in (own, rest[:3], rest[3:6], rest[6:]) if p]
    return [f"+{digits}", "+" + " ".join(parts), "+" + "-".join(parts), "+" + ".".join(parts), f"00{own} {rest[:3]} {rest[3:6]} {rest[6:]}", f"({rest[:3]}) {rest[3:6]}-{rest[6:]}"]


def spoilt(kind: str, piece: str) -> list[str]:
    """Pieces that look alike and are no personal data."""
    groups = _GROUP.findall(piece)
    if kind == "email":
        return ["there at last dot then"]
    if kind == "ip":
        return [".".join([str(int(groups[0]) + 256), *groups[1:]]), ".".join([*groups, groups[0]]), ".".join([groups[1], *groups])]
    if kind == "card":
        digits = "".join(groups)
        return [digits[:-1] + str((int(digits[-1]) + k) % 10) for k in (1, 4, 7)] + [f"a{digits}", f"{digits}f", f"id{digits}"]
    if kind == "phone":
        digits = "".join(groups)
        return [f"{digits}a", digits[:4] + "." + digits[4:8] + "." + digits[8:], f"x{digits[:7]}", digits[:7], " ".join(digits[i : i + 2] for i in range(0, len(digits), 2))]
    return []


def examples(texts: list[str], held: dict[str, str] | None = None):
    """``(features but the evidence, kind, label, word before)`` of candidates around numbers and addresses of the texts, and of their grafts.

    ``held``: the last span of each kind, to be grafted beside the next ones.
    """
    held = {} if held is None else held
    for text in texts:
        alone = [s for s in base_spans(text) if _alone(text, s)]
        yield from _judged(text, set(alone))
        for kind, start, end in alone:
            head, piece, tail = text[max(0, start - 40) : start], text[start:end], text[end : end + 40]
            head, tail = (re.sub(r"[0-9@]", "x", x) for x in (head, tail))
            for other in written_otherwise(kind, piece):
                yield from _judged(head + other + tail, {(kind, len(head), len(head) + len(other))})
            for other in spoilt(kind, piece):
                yield from _judged(head + other + tail, set())
            for kind_, piece_ in held.items():
                for one, two in (((kind, piece), (kind_, piece_)), ((kind_, piece_), (kind, piece))):
                    at = len(head) + len(one[1]) + 1
                    yield from _judged(f"{head}{one[1]} {two[1]}{tail}", {(one[0], len(head), at - 1), (two[0], at, at + len(two[1]))})
            held[kind] = piece


def _judged(text: str, true: set[Span]):
    for span, left, right in candidates(text):
        yield features(text, span, left, right, 0.0)[:-1], span[0], int(span in true), word_before(text, span[1])


class Evidence:
    """Log-odds of the word before a candidate, in sorted arrays in the shared folder, memory-mapped by the workers."""

    SHARDS = 64

    def __init__(self, folder: str):
        self.folder = folder

    @staticmethod
    def key(word: str) -> int:
        return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")

    def get(self, word: str, default: float = 0.0) -> float:
        found = _looked_up(self.folder, word)
        return default if found is None else found


@lru_cache(maxsize=65536)
def _looked_up(folder: str, word: str) -> float | None:
    key = Evidence.key(word)
    keys = open_array(folder, f"keys-{key % Evidence.SHARDS}")
    at = int(np.searchsorted(keys, np.uint64(key)))
    return float(open_array(folder, f"values-{key % Evidence.SHARDS}")[at]) if at < len(keys) and keys[at] == key else None


@dataclass
class Model:
    trees: Trees | None = None
    evidence: Evidence | dict[str, float] = field(default_factory=dict)
    threshold: dict[str, float] = field(default_factory=dict)


def pooled(rows) -> list[list[float]]:
    """Pooled adjacent violators of ``(sum of labels, rows, score)`` in ascending order of scores; of pooled parts in order, those of the whole."""
    blocks: list[list[float]] = []  # sum of labels, rows, lowest score
    for v, n, s in rows:
        if blocks and blocks[-1][2] == s:
            blocks[-1][0] += v
            blocks[-1][1] += n
        else:
            blocks.append([v, n, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, n, _ = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += n
    return blocks


def calibrated(score: np.ndarray, y: np.ndarray, least: float) -> float:
    """Smallest score from which on the calibrated probability (pooled adjacent violators) reaches ``least``; infinity if none."""
    order = np.argsort(score, kind="stable")
    return _reached(pooled((v, 1, s) for s, v in zip(score[order].tolist(), y[order].tolist())), least)


def _reached(blocks: list[list[float]], least: float) -> float:
    return next((s for total, n, s in blocks if total / (n + 1) >= least), float("inf"))


def thresholds(scored: DataFrame, least: float) -> dict[str, float]:
    """``calibrated`` for every kind of rows ``(kind, score, y)``: each task pools a range of scores, the driver the blocks of all ranges in order."""

    def run(batches):
        rows: dict[str, list] = defaultdict(list)
        for b in batches:
            for kind, s, v, n in zip(*[b.column(x).to_pylist() for x in ("kind", "score", "y", "n")]):
                rows[kind].append((v, n, s))
            for kind in rows:
                rows[kind] = [tuple(x) for x in pooled(rows[kind])]
        for kind, blocks in rows.items():
            y, n, s = (pa.array(x, pa.float64()) for x in zip(*blocks))
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(blocks)), y, n, s], ["kind", "y", "n", "score"])

    one = scored.groupBy("kind", "score").agg(F.sum("y").cast("double").alias("y"), F.count(F.lit(1)).cast("double").alias("n"))
    blocks = one.repartitionByRange("kind", "score").sortWithinPartitions("kind", "score").mapInArrow(run, "kind string, y double, n double, score double")
    found: dict[str, list] = defaultdict(list)
    for r in sorted(blocks.collect(), key=lambda r: r["score"]):
        found[r["kind"]].append((r["y"], r["n"], r["score"]))
    return {k: _reached(pooled(found[k]), least) for k in KINDS}


def _evidence(learn: DataFrame, share: float) -> Evidence:
    """Words before at least 20 candidates, counted over all of them."""
    folder = shared_folder(learn.sparkSession, "evidence")
    counts = learn.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("b")).where("n >= 20")

    def keyed(batches):
        for batch in batches:
            keys = [Evidence.key(w) for w in batch.column("word").to_pylist()]
            n, b = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.float64) for x in ("n", "b"))
            value = np.log((b + 10 * share) / (n - b + 10 * (1 - share))) - np.log(share / (1 - share))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k % Evidence.SHARDS for k in keys], pa.int32()), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(value)], ["shard", "key", "value"]
            )

    def save(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        key, value = (np.concatenate([c.to_numpy() for c in group.column(x).chunks]) for x in ("key", "value"))
        key = key.view(np.uint64)
        order = np.argsort(key)
        save_array(folder, f"keys-{shard}", key[order])
        save_array(folder, f"values-{shard}", value[order])
        return pa.table({"shard": pa.array([shard], pa.int32())})

    rows = counts.mapInArrow(keyed, "shard int, key bigint, value double")
    saved = {r["shard"] for r in rows.groupBy("shard").applyInArrow(save, "shard int").collect()}
    for shard in set(range(Evidence.SHARDS)) - saved:
        save_array(folder, f"keys-{shard}", np.zeros(0, np.uint64))
        save_array(folder, f"values-{shard}", np.zeros(0))
    return Evidence(folder)


def _matrix(batch, evidence: Evidence) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES) - 1).astype(np.float64)
    return np.column_stack([x, [evidence.get(w, 0.0) for w in batch.column("word").to_pylist()]])


def fit(docs: DataFrame, least: float = 0.9, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learn from the distinct candidates of all documents.

    A fifth of the candidates, by the hash of their document, is held back to calibrate the thresholds, at which a candidate is right with
    probability ``least``. Without base spans that stand alone nothing is added to the base.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        beside: dict[str, str] = {}
        for batch in slices(batches, "text", 500_000):
            out = []
            for i, t in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
                if "@" in t or _GROUP.search(t):
                    out += {(fold_of(i) == 0, tuple(x), *rest) for x, *rest in examples([t], beside)}
                if len(out) >= 20_000:
                    yield _example_batch(out)
                    out = []
            if out:
                yield _example_batch(out)

    data = materialize(source.mapInArrow(run, "held boolean, x array<float>, kind string, y int, word string").distinct(), "candidates")
    learn = data.where("NOT held")
    n, positive = learn.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or positive in (0, n):
        return Model()
    evidence = _evidence(learn, positive / n)

    def values(batches):
        for batch in batches:
            if batch.num_rows:
                found = [np.unique(c, return_counts=True) for c in _matrix(batch, evidence).T]
                at = np.repeat(np.arange(len(found)), [len(v) for v, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array(np.concatenate([v for v, _ in found])), pa.array(np.concatenate([c for _, c in found]))], ["feature", "value", "n"]
                )

    cuts = cuts_of(learn.mapInArrow(values, "feature int, value double, n bigint"), len(NAMES))

    def bins(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in binned(_matrix(batch, evidence), cuts)], pa.binary()), batch.column("y")], ["bins", "y"])

    trees = boost_all(learn.mapInArrow(bins, "bins binary, y int"), cuts, rounds=40, depth=5)

    def scores(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(trees.log_odds(_matrix(batch, evidence))), batch.column("y")], ["kind", "score", "y"])

    held = data.where("held")
    return Model(trees, evidence, thresholds((learn if held.isEmpty() else held).mapInArrow(scores, "kind string, score double, y int"), least))


def _example_batch(rows: list) -> pa.RecordBatch:
    held, x, kind, y, word = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(held), pa.array(x, pa.list_(pa.float32())), pa.array(kind), pa.array(y, pa.int32()), pa.array(word)], ["held", "x", "kind", "y", "word"]
    )


# --- use ----------------------------------------------------------------------------------------------------------


def judge(texts: list[str], model: Model) -> list[tuple[list[Span], list[tuple[Span, float]]]]:
    """Per text the base spans and the spans the model adds, with their log-odds.

    Candidates under their kind's threshold go; of overlapping ones of a kind (the base's among them) the
    likelier stays, ties to the first and then the shorter.
    """
    base = [base_spans(t) for t in texts]
    if model.trees is None:
        return [(b, []) for b in base]
    rows, of = [], []
    for i, text in enumerate(texts):
        found = candidates(text)
        if not found or {c[0] for c in found} <= set(base[i]):
            continue
        for span, left, right in found:
            rows.append(features(text, span, left, right, model.evidence.get(word_before(text, span[1]), 0.0)))
            of.append((i, span))
    added: list[list[tuple[Span, float]]] = [[] for _ in texts]
    if rows:
        scores = np.concatenate([model.trees.log_odds(np.array(rows[k : k + 50_000], np.float64)) for k in range(0, len(rows), 50_000)])
        chosen: dict[tuple[int, str], _Taken] = defaultdict(_Taken)
        order = sorted(range(len(rows)), key=lambda k: (-scores[k], of[k][1][1], of[k][1][2]))
        sets = [set(b) for b in base]
        for k in order:
            i, span = of[k]
            if scores[k] >= model.threshold[span[0]] and chosen[i, span[0]].take(span[1], span[2]) and span not in sets[i]:
                added[i].append((span, float(scores[k])))
    return list(zip(base, added))


class _Taken:
    """Disjoint intervals, kept sorted."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def take(self, start: int, end: int) -> bool:
        from bisect import bisect_left, bisect_right

        i = bisect_right(self.ends, start)
        if i != bisect_left(self.starts, end):
            return False
        self.starts.insert(i, start)
        self.ends.insert(i, end)
        return True


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in _sorted(spans))


def find(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, the counts of base spans (``n_email`` ... ), ``base_sha256``, ``spans`` (all, as text) and
    ``found``: an array of (kind, start, end, base, score) with code point offsets. Null text is empty; repeated rows stay."""
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        for batch in slices(batches, "text"):
            rows = []
            for base, added in judge(strings(batch.column("text")), model):
                kinds = [s[0] for s in base]
                score = {s: v for s, v in added}
                every = _sorted([*base, *score])
                known = set(base)
                rows.append((
                    *[kinds.count(k) for k in KINDS], hashlib.sha256(listed(base).encode()).hexdigest(), listed(every),
                    [{"kind": s[0], "start": s[1], "end": s[2], "base": s in known, "score": score.get(s)} for s in every],
                ))
            types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(item)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(zip(*rows), types)]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "found"],
            )

    return source.mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string, "
        "found array<struct<kind: string, start: bigint, end: bigint, base: boolean, score: double>>",
    )


def redacted(text: str, spans) -> str:
    """The text with every span, overlapping ones as one, replaced by the name of the first one's kind in angle brackets."""
    out, at = [], 0
    for kind, start, end in _sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` with all found spans replaced; null text becomes empty."""
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            texts = strings(batch.column("text"))
            done = [redacted(t, [*base, *[s for s, _ in added]]) for t, (base, added) in zip(texts, judge(texts, model))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(done, pa.string())], ["doc_id", "text"])

    return source.mapInArrow(run, f"doc_id {source.schema[0].dataType.simpleString()}, text string")
