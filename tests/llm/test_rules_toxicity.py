"""Quality rules (op 8), toxicity (op 9), importance resampling (op 1) and license scans (op 6)."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from layercake.llm import decision_list as rules
from layercake.llm import importance, licenses, toxicity
from layercake.llm.common import table
from layercake.llm.queries import op1_importance_resampling, op6_license_scan, op8_decision_list, op9_toxicity_viterbi

from .conftest import ROWS


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, seen, duplicate = len(words), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicate += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    count = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for w in words for c in w)
    return n, sum(map(len, words)), symbols, duplicate, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def test_statistics_of_whole_table(spark, sf):
    texts = dict(tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect())
    got = {r[0]: tuple(r)[1:7] for r in op8_decision_list(spark, sf).collect()}
    assert got == {i: base(t) for i, t in texts.items()}


def test_list_agrees_with_labels(spark, sf):
    verdicts = {r["doc_id"]: r["kept"] for r in op8_decision_list(spark, sf).where("not base_failed").collect()}
    held = [(verdicts[r["doc_id"]], r["quality"]) for r in table(spark, sf, "labels").collect() if r["doc_id"] in verdicts]
    assert sum(k == bool(q) for k, q in held) >= 0.95 * len(held)


def test_statistics_of_odd_rows(spark, odd_docs, no_docs, labels, no_labels):
    extra = [(20, "a a a a a a x y z a a a", None, None, 0), (21, "l\nl\n \nl\nm\n\n", None, None, 0), (22, "### $$ <b> &amp; |", None, None, 0)]
    docs = odd_docs.select(*odd_docs.columns[:5]).union(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    for lab in (labels, no_labels):
        got = sorted((str(r[0]), *tuple(r)[1:7]) for r in rules.judge(docs, rules.fit(docs, lab)).collect())
        assert got == sorted((str(r[0]), *base(r[1])) for r in ROWS + extra)
    kept = rules.keep_clean(odd_docs, [])
    assert kept.columns == odd_docs.columns and kept.count() == sum(not base(r[1])[5] for r in ROWS)
    assert rules.judge(no_docs, rules.fit(no_docs, labels)).count() == 0
    assert rules.keep_clean(no_docs, []).count() == 0


def test_learned_rules_find_planted_thresholds(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        a, b = float(rng.random()), float(rng.random())
        rows.append((int(a >= 0.8 or (b < 0.2 and a >= 0.4)), i % 3 // 2, a, b))
    found = rules.learn_rules(spark.createDataFrame(rows, "bad int, part int, a double, b double"), ("a", "b"))
    assert found and all(c.feature in ("a", "b") for r in found for c in r)

    def verdict(a, b):
        value = {"a": a, "b": b}
        return not any(all((value[c.feature] >= c.cut) == c.above for c in r) for r in found)

    assert sum(verdict(a, b) == (not bad) for bad, _, a, b in rows) >= 0.95 * len(rows)
    df = spark.createDataFrame([(a, b) for _, _, a, b in rows], "a double, b double")
    assert [r[0] for r in df.select(rules.verdict(found)).collect()] == [verdict(a, b) for _, _, a, b in rows]


def test_plan_has_no_python(spark, sf):
    docs = table(spark, sf, "documents")
    for df in (rules.judge(docs, []), licenses.scan(docs, licenses.template_rows(spark))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# --- toxicity -----------------------------------------------------------------------------------------------------

WORDS = ("nasty", "rotten", "vile")


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng = np.random.default_rng(4)
    plain = ["the", "table", "window", "river", "nation", "rain", "stone", "letter", "music", "green", "later", "under", "storm"]
    docs, labels = [], []
    for i in range(900):
        words = list(rng.choice(plain, 40))
        bad = int(i % 4 == 0)
        if bad:
            for w in rng.choice(WORDS, 3):
                words[int(rng.integers(40))] = str(w)
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, bad))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        " ".join(plain * 3),
    )


def test_disguised_words_are_restored_and_scored(spark, toxic_corpus):
    docs, labels, plain = toxic_corpus
    model = toxicity.fit(docs, labels)
    scorer = toxicity.Scorer(model)
    for written in ("n4sty", "naaaasty", "N4STY".lower(), "r0tten", "v1le", "n.a.s.t.y", "vvvile!!!"):
        assert scorer.read(written).replace("tt", "t") in ("nasty", "roten", "vile"), written
    assert "nasty" in toxicity.spaced_runs("so n a s t y of them")
    assert scorer.score(plain) < 0.1
    assert scorer.score(plain + " n4sty r0tten") > 0.5
    assert scorer.score(plain + " n a s t y v i l e") > scorer.score(plain)
    got = toxicity.score(docs, model).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_plain_readings_stay(spark, toxic_corpus):
    scorer = toxicity.Scorer(toxicity.fit(*toxic_corpus[:2]))
    for written, read in (("table,", "table"), ("(river)", "river"), ("stone***", "stone"), ("letter", "letter"), ("2024", ""), ("", "")):
        assert scorer.read(written) == read or not any(c.isalpha() for c in written)


def test_held_out_labels_are_never_read(spark, toxic_corpus):
    docs, labels, _ = toxic_corpus
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, labels, no_labels):
    for lab in (labels, no_labels):
        got = toxicity.score(odd_docs, toxicity.fit(odd_docs, lab)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    model = toxicity.fit(no_docs, no_labels)
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.keep_clean(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(ROWS)


def test_toxicity_on_held_out_rows(spark, larger_sf):
    truth = {r["doc_id"]: r["toxic"] for r in table(spark, larger_sf, "labels").collect()}
    got = [r for r in op9_toxicity_viterbi(spark, larger_sf).collect() if r["held_out"] and r["doc_id"] in truth]
    clean, bad = ([r["score"] for r in got if truth[r["doc_id"]] == k] for k in (0, 1))
    assert sum(s >= 0.5 for s in clean) <= 0.05 * len(clean)
    better = sum((b > c) + (b == c) / 2 for b in bad for c in clean) / (len(bad) * len(clean))
    assert better >= 0.8  # area under the curve


def test_spacing_is_part_of_the_lattice(spark, toxic_corpus):
    docs, labels, plain = toxic_corpus
    scorer = toxicity.Scorer(toxicity.fit(docs, labels))
    for written in (
        "v i l e t a b l e", "t h e r i v e r v i l e m u s i c", "a v i l e a", "v i l e.", "r a i n, v i l e,", '"v ! l e"', "v 1 l e!", "vi le", "the vi le, river",
        "v i le", "table_vile", "r.a.i.n v.i.l.e",
    ):
        assert any(w == "vile" for x in scorer.words(written) for w in scorer.read(x).split(" ")), written
    assert "stone" in scorer.read("$ t o n e").split(" ")
    assert scorer.score(plain + " t h e n a s t y r i v e r r o t t e n v i l e") > 0.5
    assert scorer.score(plain + " t h e g r e e n r i v e r") < 0.1


def test_no_gate_before_the_decoder(spark, toxic_corpus):
    scorer = toxicity.Scorer(toxicity.fit(*toxic_corpus[:2]))
    for written, read in (
        ("$tone!", "stone"), ("$t0ne!!!", "stone"), ("mu$ic!", "music"), ("n" + "a" * 60 + "sty", "nasty"), ("table_river_stone_window_music_green_later_under_vile", "vile"),
        ("naassty", "nasty"), ("viile", "vile"), ("vile$$$", "vile"), ("***stone***", "stone"), ("+able!", "table"), ("st**n*", "ston"),
    ):
        assert any(w.startswith(read) for w in scorer.read(written).split(" ")), (written, scorer.read(written))


def test_decoder_is_exact(spark):
    """No path beats Viterbi's on tokens with several open signs (full enumeration of letters and nothing)."""
    from itertools import product

    model = toxicity.CharacterModel({"^^b": 3, "^ba": 3, "bac": 2, "ac$": 2, "bad": 1, "ad$": 1, "^^c": 2, "^ce": 2, "ceb": 1, "eb$": 1})
    for written in ("b*c*d", "*c*b*", "*b*c*d*e*"):
        got = toxicity.decode_token(written, model)
        price, best = {"": toxicity.PRICE_FILLER}, []
        for way in product(*[[*"aeiou", "*", ""] if c == "*" else [c] for c in written]):
            value, history = 0.0, "^^"
            for c, x in zip(written, way):
                value += 0.0 if c == x and c != "*" else price.get(x, toxicity.PRICE_KEPT_SIGN if x == "*" else toxicity.PRICE_LOOKALIKE)
                if x:
                    value += model(history, x)
                    history = history[1] + x
            best.append((-(value + model(history, "$")), "".join(way)))
        low = min(best)[0]
        assert got in {w for v, w in best if v < low + 1e-9}, (written, got)


def all_readings(written, model, weight):
    """``(value, reading)`` of every way through the lattice, by its rules spelt out, the word bonus taken from whole words."""

    def bonus(word):
        return max(0.0, min(6.0, 2.0 * sum(weight.get(f, 0.0) for f in toxicity.word_features(word))))

    def closed(history, word):
        return model(history, "$") + bonus(word)

    ways = [("^^", "", "", "", 0.0)]  # history, last written, finished words, the word, value
    for ch in written:
        new = []
        for history, before, done, word, value in ways:
            options = [(x, toxicity.PRICE_LOOKALIKE) for x in toxicity.LOOKALIKES.get(ch, "")] if ch != " " else [("", 0.0)]
            if ch != " ":
                options.append((ch, 0.0 if ch.isalpha() else toxicity.PRICE_KEPT_SIGN))
                if ch in toxicity.FILLERS or ch in toxicity._SIGNS:
                    options.append(("", toxicity.PRICE_FILLER if ch in toxicity.FILLERS else -1.5))
            for letter, price in options:
                if letter == "":
                    if ch in toxicity._SIGNS and before == ch * 2:
                        price = 0.0
                    new.append((history, before if ch == " " else ch * 2, done, word, value + price))
                    if (ch == " " or ch in toxicity.JOINERS) and word:
                        new.append(("^^", "", done + word + " ", "", value + price + closed(history, word)))
                elif before == ch and history[1] == letter:
                    new.append((history, ch, done, word, value + toxicity.PRICE_REPEAT))
                    if history != letter * 2:
                        new.append((history[1] + letter, ch, done, word + letter, value + price + toxicity.PRICE_DOUBLE + model(history, letter)))
                else:
                    new.append((history[1] + letter, ch, done, word + letter, value + price + model(history, letter)))
        ways = new
    return [(v + (closed(h, w) if w else 0.0), (d + w).strip()) for h, _, d, w, v in ways]


def test_decoder_is_exact_with_bonus_spaces_and_repeats():
    model = toxicity.CharacterModel({"^^v": 3, "^vi": 2, "vil": 2, "ile": 2, "le$": 2, "^vl": 4, "vll": 3, "lle": 2, "^^a": 2, "^ab": 2, "abe": 1, "be$": 1})
    weight = {"=vile": 2.0, "vil": 0.4, "abe": -0.5, "=able": 1.5, "abl": 0.2, "=vi": 0.7}
    bonus = toxicity.WordBonus(weight)
    for written in ("v1le", "v*le", "v1 le", "v.i.l.e", "vv11lle", "a8le", "@b!e", "vi1e_ab|e", "v i l e a", "vile$$", "a--b  le", "v11le"):
        ways = all_readings(written, model, weight)
        top = max(v for v, _ in ways)
        assert toxicity.decode_token(written, model, bonus) in {w for v, w in ways if v > top - 1e-9}, written
    assert toxicity.decode_token("v1le", model, bonus) == "vile"


def test_undecoded_tokens_have_no_watched_feature(spark, toxic_corpus):
    """What is left undecoded because no reading can matter gives the same features when decoded."""
    scorer = toxicity.Scorer(toxicity.fit(*toxic_corpus[:2]))
    pick = random.Random(2)
    for _ in range(3000):
        word = "".join(pick.choice("vilenastyrotten1$@!.*- _0xx") for _ in range(pick.randrange(1, 9))).strip()
        if word:
            found = [(w, [f for f in toxicity.word_features(w) if f in scorer.watched]) for w in scorer.read(word).split(" ")]
            assert scorer._known(word) == [x for x in found if x[1]], word


def test_disguised_pieces_are_joined(spark, toxic_corpus):
    docs, labels, plain = toxic_corpus
    scorer = toxicity.Scorer(toxicity.fit(docs, labels))
    for written in ("v1 le", "n4 sty", "na $ty", "r0t ten", "v! 1e"):
        assert any(w in WORDS for x in scorer.words(written) for w in scorer.read(x).split(" ")), written
        assert scorer.score(plain + " " + written) > scorer.score(plain)


def test_characters_of_every_script_are_counted(spark):
    letters = [chr(0x4E00 + i) for i in range(300)]
    docs = spark.createDataFrame([(a + b,) for a, b in zip(letters, letters[1:])], "text string")
    stored, plain = toxicity.count_characters(docs), toxicity.CharacterModel({f"^{a}{b}": 1 for a, b in zip(letters, letters[1:])})
    assert stored.total == 3 * 299
    for a, b in zip(letters, letters[1:]):
        assert stored.get("3^" + a + b) == 1 == plain.count["3^" + a + b] and stored.get("3" + b + a + "x") == 0


def test_clashing_names_stay(spark, toxic_corpus):
    docs = toxic_corpus[0].limit(40).selectExpr("*", "'mine' as __text", "map(1, 2) as row")
    kept = toxicity.keep_clean(docs, toxicity.fit(*toxic_corpus[:2]))
    assert kept.columns == docs.columns and {r["__text"] for r in kept.collect()} == {"mine"}


# --- importance resampling ----------------------------------------------------------------------------------------


def test_sample_size_weights_and_threshold(spark, larger_sf):
    rows = op1_importance_resampling(spark, larger_sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, larger_sf, "labels").collect()}
    share = sum(labels.values()) / len(labels)
    assert sum(r["kept"] for r in rows) == round(share * len(rows))  # no ties in the keys
    assert min(r["sample_key"] for r in rows if r["kept"]) > max(r["sample_key"] for r in rows if not r["kept"])
    judged = [(r["kept"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]
    assert sum(k for k, q in judged if q) >= 0.9 * sum(q for _, q in judged)
    assert sum(k for k, q in judged if not q) <= 0.2 * sum(not q for _, q in judged)


def test_kth_largest_equals_sorting(spark):
    rng = np.random.default_rng(6)
    values = [float(x) for x in rng.normal(size=400)] + [1.5] * 200 + [-1e12, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 57, 150, 300, len(values)):
        assert importance.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df, "x", 0) is None and importance.kth_largest(df.limit(0), "x", 1) is None


def test_gumbel_sampling_is_in_proportion(spark):
    df = spark.range(40_000).withColumn("w", (importance.F.col("id") % 2).cast("double") * float(np.log(3)))
    keyed = df.withColumn("key", importance.F.col("w") + importance.gumbel(importance.F.col("id"), 5))
    top = keyed.orderBy(importance.F.desc("key")).limit(400)
    assert 0.68 < top.agg(importance.F.avg(importance.F.col("id") % 2)).first()[0] < 0.82  # 3 to 1


def test_importance_of_whole_table(spark, sf):
    """``log_weight`` recomputed in plain Python over the whole table, and the sample from it; only the noise is Spark's."""
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    given = {}
    for i, label in [tuple(r) for r in table(spark, sf, "labels").select("doc_id", "quality").collect()]:
        if i is not None and label is not None:
            given[i] = min(label, given.get(i, label))
    good = {i for i, label in given.items() if label != 0}
    buckets, wrap = 16_384, 2**64 - 1

    def grams(text):
        one = [zlib.crc32(p.encode()) for w in (text or "").split() for p in re.findall(r"\w+|[^\w\s]+", w)]
        two = [(((a * 0x9E3779B97F4A7C15 + b) & wrap) * 0xC2B2AE3D27D4EB4F & wrap) >> 31 for a, b in zip(one, one[1:])]
        return [x % buckets for x in one + two]

    raw, target = Counter(), Counter()
    for i, text in docs:
        raw.update(grams(text))
        if i in good:
            target.update(grams(text))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    ratio = [math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in range(buckets)]
    noise = dict(tuple(r) for r in table(spark, sf, "documents").select("doc_id", importance.gumbel(importance.F.col("doc_id"), 13)).collect())
    got = {r["doc_id"]: r for r in op1_importance_resampling(spark, sf).collect()}
    assert len(got) == len(docs)
    keys = {}
    for i, text in docs:
        own = grams(text)
        weight = sum(ratio[b] for b in own)
        assert got[i]["n_grams"] == len(own) and abs(got[i]["log_weight"] - weight) < 1e-6 * max(1, len(own))
        keys[i] = weight + noise[i]
    k = round(len(good) / len(given) * len(docs))
    assert {i for i, r in got.items() if r["kept"]} == set(sorted(keys, key=keys.get, reverse=True)[:k])


def test_importance_of_odd_rows(spark, odd_docs, no_docs, labels, no_labels):
    got = importance.resample(odd_docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert all(r["log_weight"] == 0 for r in got if not r["n_grams"])
    assert all(r["kept"] for r in importance.resample(odd_docs, no_labels).collect())
    assert importance.resample(no_docs, labels).count() == 0


# --- license scans ------------------------------------------------------------------------------------------------


def bare_words(text):
    return text.lower().translate({ord(c): None for c in licenses._SIGNS}).split()


def shingles(text, n=5):
    words = bare_words(text)
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_notices_of_whole_table(spark, sf):
    want = set()
    for i, text in (tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()):
        for name, wording in licenses.TEMPLATES.items():
            n = min(5, len(bare_words(wording)))  # a brief template is one shingle at its own length
            if len(shingles(text, n) & shingles(wording, n)) >= 0.8 * len(shingles(wording, n)):
                want.add((i, name))
    assert {tuple(r)[:2] for r in op6_license_scan(spark, sf).collect()} == want and want


def test_long_notices_are_found_wherever_they_stand(spark):
    docs, want = [], set()
    for k, (name, wording) in enumerate(sorted(licenses.TEMPLATES.items())):
        for j, before in enumerate((0, 3, 17, 64, 101)):
            i = 10 * k + j
            docs.append((i, "filler words stand here " * before + "\n# " + wording.replace(", ", ",\n# ") + "\n" + "and more text after it " * 5))
            want.add((i, name))
            words = wording.split()
            if len(words) > 60:  # one word changed breaks five shingles: still over 0.8
                words[30] = "changed"
                docs.append((i + 5, " ".join(words)))
                want.add((i + 5, name))
                docs.append((1000 + i, " ".join(words[: len(words) // 2])))  # half a notice is none
    rows = licenses.scan(spark.createDataFrame(docs, "doc_id int, text string"), licenses.template_rows(spark)).collect()
    got = {tuple(r)[:2] for r in rows}
    assert want <= got
    exact = {(i, n) for i, t in docs for n, w in licenses.TEMPLATES.items() if len(shingles(t, k := min(5, len(bare_words(w)))) & shingles(w, k)) >= 0.8 * len(shingles(w, k))}
    assert got <= exact


def test_licenses_of_odd_rows(spark, odd_docs, no_docs):
    templates = licenses.template_rows(spark)
    assert licenses.scan(odd_docs, templates).count() == 0
    assert licenses.scan(no_docs, templates).count() == 0
    assert licenses.scan(odd_docs, templates.limit(0)).count() == 0
    short = spark.createDataFrame([("four", "only four words here"), ("kappa", "beta gamma delta epsilon zeta eta")], "license string, wording string")
    assert sorted(str(r["doc_id"]) for r in licenses.scan(odd_docs, short).collect()) == ["1", "None"]


def test_brief_notices_of_whole_table(spark, sf):
    """Every template at its own shingle length, also those of under five words."""

    def cut(text, n):
        words = text.lower().translate({ord(c): None for c in licenses._SIGNS}).split()
        return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]

    want, brief = set(), {}
    for i, text in (tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()):
        for name, wording in licenses.TEMPLATES.items():
            n = min(licenses.SHINGLE, len(cut(wording, 1)))
            have, need = cut(text or "", n), set(cut(wording, n))
            if len(need & set(have)) >= 0.8 * len(need):
                want.add((i, name))
                if n < licenses.SHINGLE:
                    brief[i, name] = (1.0, max(0, have.index(*need) - 1))
    rows = op6_license_scan(spark, sf).collect()
    assert {tuple(r)[:2] for r in rows} == want
    assert brief and {tuple(r)[:2]: tuple(r)[2:] for r in rows if tuple(r)[:2] in brief} == brief


def test_brief_templates_of_every_length(spark):
    t = [("one", "Proprietary!"), ("two", "all rights"), ("three", "All rights reserved."), ("same", "ALL rights; reserved"), ("four", "no rights are reserved"), ("none", "..."), ("five", "a b c d e")]
    docs = [(1, "All\nRights reserved"), (2, "not all rights, reserved or proprietary"), (3, "all right reserved"), (4, None), (5, "rights reserved all"), (6, "x a b c d e"), (7, "no rights are reserved")]
    docs = spark.createDataFrame(docs, "doc_id int, text string")
    got = sorted(tuple(r) for r in licenses.scan(docs, spark.createDataFrame(t, "license string, wording string")).collect())
    assert got == [
        (1, "same", 1.0, 0), (1, "three", 1.0, 0), (1, "two", 1.0, 0),
        (2, "one", 1.0, 4), (2, "same", 1.0, 0), (2, "three", 1.0, 0), (2, "two", 1.0, 0),
        (6, "five", 1.0, 0), (7, "four", 1.0, 0),
    ]
    with pytest.raises(ValueError):
        licenses.scan(docs, spark.createDataFrame(t[:4], "license string, wording string"), most=3)
