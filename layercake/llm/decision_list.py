"""Learned decision lists over text statistics, in DataFrame functions throughout.

Sequential covering: each rule grows one threshold condition at a time by
information gain on two thirds of the labelled rows, is cut back where the
other third says a shorter conjunction separates better, and leaves the rows
it covers out of the search for the next rule. All counting is Spark
aggregation over the labelled rows' binned statistics; what comes to the
driver is a histogram (features x bins x 4). The list becomes one ordered
``when`` expression, so scoring is a single pass inside code generation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import SPACES, keep_where, labelled_ids
from layercake.session import materialize

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Characters counted as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
#: Statistics that rules may test: ratios, so that long and short texts compare.
FEATURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length", "upper_ratio", "bang_ratio", "distinct_ratio", "line_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= cut, else value < cut
    cut: float

    def column(self, p: str = "") -> Column:
        value = F.col(p + self.feature)
        return value >= F.lit(self.cut) if self.above else value < F.lit(self.cut)


Rule = tuple[Condition, ...]


def with_statistics(df: DataFrame, text: str, p: str = "") -> DataFrame:
    """``df`` plus the base statistics, ``base_failed`` and ``FEATURES``, each named with prefix ``p``.

    Null or empty text has no words: all counts 0, ``base_failed`` true. Words
    are runs of non-space characters; three-word windows that the text
    holds twice are found by hash and, where a hash repeats, compared as text.
    """
    trimmed = F.btrim(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))
    lines = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    t = {n: F.col(f"{p}__{n}") for n in ("words", "joined", "lines", "n", "hashes", "windows", "starts")}
    at = F.when(t["n"] >= 3, F.sequence(F.lit(0), t["n"] - 3)).otherwise(F.array().cast("array<int>"))
    word = lambda i: F.get(t["words"], i)
    same = lambda x, i: F.coalesce(x.getField("w") == F.get(t["windows"], i).getField("w"), F.lit(False))
    df = df.withColumns({f"{p}__words": words, f"{p}__lines": lines})
    df = df.withColumns({f"{p}__n": F.size(t["words"]), f"{p}__joined": F.array_join(t["words"], "")})
    df = df.withColumn(f"{p}__hashes", F.transform(at, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    windows = F.sort_array(F.transform(at, lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("w"), i.alias("i"))))
    df = df.withColumn(f"{p}__windows", F.when(F.size(F.array_distinct(t["hashes"])) < F.size(t["hashes"]), windows))
    repeated = F.filter(t["windows"], lambda x, i: same(x, i - 1) | same(x, i + 1))
    df = df.withColumn(f"{p}__starts", F.sort_array(F.transform(repeated, lambda x: x.getField("i"))))
    covered = F.aggregate(
        t["starts"],
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a.getField("n") + F.least(F.lit(3), i - a.getField("last"))).alias("n"), i.alias("last")),
        lambda a: a.getField("n"),
    )
    less = lambda drop: (F.length(t["joined"]) - F.length(F.translate(t["joined"], drop, ""))).cast("bigint")
    df = df.withColumns({
        f"{p}n_words": t["n"].cast("bigint"),
        f"{p}word_chars": F.length(t["joined"]).cast("bigint"),
        f"{p}n_symbols": less(SYMBOLS),
        f"{p}n_dup_lines": (F.size(t["lines"]) - F.size(F.array_distinct(t["lines"]))).cast("bigint"),
        # the always-true condition on the row's place keeps later filters from being pushed below, with ``windows`` written out in each lambda
        f"{p}n_repeat_words": F.when(F.monotonically_increasing_id() >= 0, F.coalesce(covered, F.lit(0).cast("bigint"))),
        f"{p}__bang": less("!?"),
        f"{p}__upper": less("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        f"{p}__n_lines": F.size(t["lines"]),
        f"{p}__n_distinct": F.size(F.array_distinct(t["words"])),
    })
    c = lambda n: F.col(p + n).cast("double")
    over = lambda a, b: a / F.greatest(b, F.lit(1.0))
    df = df.withColumns({
        f"{p}base_failed": (F.col(f"{p}n_words") < 50) | (100 * F.col(f"{p}n_repeat_words") > 50 * F.col(f"{p}n_words")),
        f"{p}symbol_ratio": over(c("n_symbols"), c("word_chars")),
        f"{p}dup_line_ratio": over(c("n_dup_lines"), c("__n_lines")),
        f"{p}repeat_ratio": over(c("n_repeat_words"), c("n_words")),
        f"{p}word_length": over(c("word_chars"), c("n_words")),
        f"{p}upper_ratio": over(c("__upper"), c("word_chars")),
        f"{p}bang_ratio": over(c("__bang"), c("word_chars")),
        f"{p}distinct_ratio": over(c("__n_distinct"), c("n_words")),
        f"{p}line_words": over(c("n_words"), c("__n_lines")),
    })
    return df.drop(*[f"{p}__{n}" for n in ("words", "lines", "n", "joined", "hashes", "windows", "starts", "bang", "upper", "n_lines", "n_distinct")])


def _histogram(rows: DataFrame, rule: list[tuple[int, bool, int]]) -> dict:
    """Counts ``[feature][bin][part, bad]`` of the rows that meet ``rule`` (one job, a bounded result)."""
    for f, above, b in rule:
        value = F.get("bins", F.lit(f))
        rows = rows.where(value >= b if above else value < b)
    flat = rows.select("part", "bad", F.posexplode("bins").alias("f", "b"))
    return {(r["f"], r["b"], r["part"], r["bad"]): r["n"] for r in flat.groupBy("f", "b", "part", "bad").agg(F.count(F.lit(1)).alias("n")).collect()}


def _sides(hist: dict, f: int, n_cuts: int) -> list[tuple[int, bool, dict[int, list[int]]]]:
    """``(cut number, above, {part: [good, bad]})`` for each side of each cut of a feature."""
    at_or_above = {0: [0, 0], 1: [0, 0]}
    whole = {p: [sum(hist.get((f, b, p, y), 0) for b in range(n_cuts + 1)) for y in (0, 1)] for p in (0, 1)}
    out = []
    for b in range(n_cuts, 0, -1):
        for p in (0, 1):
            for y in (0, 1):
                at_or_above[p][y] += hist.get((f, b, p, y), 0)
        out.append((b, True, {p: list(v) for p, v in at_or_above.items()}))
        out.append((b, False, {p: [whole[p][y] - at_or_above[p][y] for y in (0, 1)] for p in (0, 1)}))
    return out[::-1]


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def learn_rules(
    labelled: DataFrame, features: tuple[str, ...] = FEATURES, bad: str = "bad", part: str = "part",
    max_rules: int = 12, max_conditions: int = 4, bins: int = 64, least_precision: float = 0.9, least_support: int = 5,
) -> list[Rule]:
    """Ordered rules that name rows with ``bad = 1``, from ``part = 0`` rows (to grow) and ``part = 1`` rows (to prune).

    A rule is taken only if, over both parts, at least ``least_precision`` of what
    it covers is bad and it covers ``least_support`` bad rows. No labelled
    rows, or none that are bad: no rules. Ties go to the earlier feature and lower cut.
    """
    # half of the cuts are quantiles of the bad rows, which may be few
    q = [i / (bins // 2) for i in range(1, bins // 2)]
    stats = labelled.agg(*[
        F.array(F.percentile_approx(F.when(F.col(bad) == 1, F.col(f)), q, 10_000), F.percentile_approx(F.when(F.col(bad) == 0, F.col(f)), q, 10_000)).alias(f)
        for f in features
    ]).first()
    cuts = [sorted({v for some in (stats[f] or []) for v in (some or [])}) for f in features]
    number = lambda f, cut: F.size(F.filter(F.lit(cut), lambda x: x <= F.col(f))) if cut else F.lit(0)
    binned = F.array(*[number(f, cut) for f, cut in zip(features, cuts)])
    rows = materialize(labelled.select(F.col(bad).alias("bad"), F.col(part).alias("part"), binned.alias("bins")), "labelled-bins")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        conditions: list[tuple[int, bool, int]] = []
        hist = _histogram(rows, conditions)
        covered = [{p: [sum(n for (g, _, q_, y), n in hist.items() if g == 0 and q_ == p and y == k) for k in (0, 1)] for p in (0, 1)}]
        while len(conditions) < max_conditions and covered[-1][0][1] and covered[-1][0][0]:
            good0, bad0 = covered[-1][0]
            best, sides = 1e-9, None
            for f, cut in enumerate(cuts):
                for b, above, counts in _sides(hist, f, len(cut)):
                    gain = _gain(counts[0][1], counts[0][0], bad0, good0)
                    if gain > best + 1e-9:
                        best, sides, condition = gain, counts, (f, above, b)
            if sides is None:
                break
            conditions.append(condition)
            covered.append(sides)
            hist = _histogram(rows, conditions)
        if not conditions:
            break
        worth = lambda c: (c[1][1] - c[1][0]) / max(1, c[1][1] + c[1][0])
        keep = max(range(1, len(covered)), key=lambda i: (worth(covered[i]), -i))
        good_n, bad_n = (sum(covered[keep][p][k] for p in (0, 1)) for k in (0, 1))
        if bad_n < least_support or bad_n < least_precision * (good_n + bad_n):
            break
        conditions = conditions[:keep]
        rules.append(tuple(Condition(features[f], above, float(cuts[f][b - 1])) for f, above, b in conditions))
        met = F.lit(True)
        for f, above, b in conditions:
            value = F.get("bins", F.lit(f))
            met = met & (value >= b if above else value < b)
        rows = rows.where(~met)
    return rules


def verdict(rules: list[Rule], p: str = "") -> Column:
    """The list as one ordered expression: false at the first rule that holds, else true."""
    out = None
    for rule in rules:
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column(p)
        out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> list[Rule]:
    """Rules from at most ``bound`` labelled documents (the first in hash order), those that fail the base rules left out.

    ``label`` 0 marks bad rows. A third of the ids, by hash, prunes.
    """
    some = labelled_ids(labels, label, bound).select(F.col("doc_id").alias("__id"), F.col("label").alias("__label"))
    own = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"))
    own = own.join(F.broadcast(some), F.col("__doc") == F.col("__id"))  # at most ``bound`` rows of two numbers
    rows = keep_where(with_statistics(own, "__text"), ~F.col("base_failed"))
    rows = rows.select((F.col("__label") == 0).cast("int").alias("bad"), (F.pmod(F.xxhash64(F.lit(7), "__id"), F.lit(3)) == 0).cast("int").alias("part"), *FEATURES)
    return learn_rules(materialize(rows, "labelled-statistics"))


def judge(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, base statistics, base_failed, kept)`` of every row; repeated rows and null ids stay."""
    own = with_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")), "__text")
    return own.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))


def keep_clean(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the base rules and the list keep."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = with_statistics(docs.select(whole.alias("__row"), F.col(text).alias("__text")), "__text")
    return keep_where(own, ~F.col("base_failed") & verdict(rules)).select("__row.*")
