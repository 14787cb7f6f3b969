import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from jobtide.llm import language as L

SYLLABLES = {"aa": ["the", "ing", "er", "on", "an"], "bb": ["sch", "ung", "keit", "ver", "ä"], "cc": ["да", "не", "то", "ра"]}


def text(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)) + "."


def plain_cost(grams, languages, alphabet, lang, word):
    """Interpolated Kneser-Ney by the book, with dictionaries."""
    levels, counts = [], dict(grams[lang])
    for _ in range(L.ORDER):
        n1, n2 = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
        levels.append((counts, n1 / (n1 + 2 * n2) if n1 and n2 else 0.5))
        lower = Counter()
        for g in counts:
            lower[g[1:]] += 1
        counts = lower

    def p(g, level):
        if level == L.ORDER:
            return 1 / (alphabet + 1)
        counts, d = levels[level]
        rows = [(h, n) for h, n in counts.items() if h[:-1] == g[:-1]]
        total = sum(n for _, n in rows)
        rest = p(g[1:], level + 1)
        return max(counts.get(g, 0) - d, 0) / total + d * len(rows) / total * rest if total else rest

    padded = L.START * (L.ORDER - 1) + word + L.END
    return -sum(math.log(p(padded[i : i + L.ORDER], 0)) for i in range(len(padded) - L.ORDER + 1))


def test_costs_equal_the_formula():
    rng = random.Random(1)
    grams = {l: L.gram_counts(Counter(L.words_of(text(l, rng, 60))[0])) for l in ("aa", "bb")}
    model = L.KneserNey(grams)
    alphabet = len({g[-1] for c in grams.values() for g in c})
    words = ["the", "schung", "zzz", "a", "thever"]
    for row, w in zip(model.word_costs(words), words):
        for cost, lang in zip(row, model.languages):
            assert abs(cost - plain_cost(grams, model.languages, alphabet, lang, w)) < 1e-4


def test_held_out_accuracy_rejection_and_edges(spark, docs_frame):
    rng = random.Random(2)
    rows = [(i, text(lang, rng, rng.choice([2, 10, 60])), lang) for i, lang in enumerate(rng.choice(list(SYLLABLES)) for _ in range(600))]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 ² -- !", "bb"), (903, "q" * 50, None), (5, rows[5][1], rows[5][2])]
    docs = docs_frame(rows + odd)
    from jobtide.llm.toxicity import held_out

    learnt = docs.filter(~held_out())
    model = L.load_model(L.train_counts(learnt))
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_documents(docs, model).collect()}
    test = [got[i][0] == lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(test) > 0.98 and all(0 <= s <= 1 for _, s in got.values())
    assert all(got[i] == ("und", 0.0) for i in (900, 901, 902)) and got[903][0] in SYLLABLES
    L.calibrate(model, learnt)
    rejected = {r.doc_id: r.lang_pred for r in L.identify_documents(docs, model, reject=True).collect()}
    assert rejected[903] == "und" and sum(v == "und" for v in rejected.values()) < 20
    clashing = docs.withColumn("rejected", docs.text).withColumn("lang_pred", docs.lang).withColumn("score", docs.text)
    flags = {r.doc_id: r.rejected for r in L.identify_documents(clashing, model).collect()}
    assert {i for i, f in flags.items() if f} == {i for i, v in rejected.items() if v == "und"}
    empty = L.load_model(L.train_counts(docs.limit(0)))
    assert {r.lang_pred for r in L.identify_documents(docs, empty).collect()} == {"und"}
    assert L.identify_documents(docs.limit(0), model).count() == 0


def test_word_memory_is_bounded():
    rng = random.Random(3)
    model = L.KneserNey({"aa": L.gram_counts(Counter(L.words_of(text("aa", rng, 200))[0]))})
    small, large = L.Identifier(model, limit=7), L.Identifier(model)
    for _ in range(20):
        t = text("aa", rng, 15)
        assert np.allclose(small.entropies(t), large.entropies(t))


def test_all_grams_are_kept_whatever_the_number_of_languages_and_models(docs_frame):
    rng = random.Random(4)
    rows = [(i, "ab" * (1 + i % 3), f"l{i:03}") for i in range(300)]
    rows += [(1000 + i, " ".join("".join(chr(97 + rng.randrange(26)) for _ in range(6)) for _ in range(40)), "zz") for i in range(20)]
    docs = docs_frame(rows)
    counts = L.train_counts(docs)
    want = L.gram_counts(Counter(w for _, t, lang in rows if lang == "zz" for w in t.split()))
    assert len(want) > 2000 and {r.gram: r.n for r in counts.filter("lang = 'zz'").collect()} == want
    whole, parts = L.load_model(counts), L.load_model(counts, shard_cells=100_000)
    assert len(parts.models) > 2 and parts.languages == whole.languages
    assert np.allclose(whole.word_costs(["ab", "zq"]), parts.word_costs(["ab", "zq"]))
    odd = docs.unionAll(docs_frame([(5000, None, None), (5001, "1 !", None)]))
    read = lambda m: {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in L.identify_documents(odd, m).collect()}
    assert read(whole) == read(parts)


def test_rejection_bounds_come_from_all_labelled_documents(docs_frame):
    rng = random.Random(6)
    # far more of a language than any sample of some hundreds would hold, and one odd document in each of a hundred
    rows = [(i, text("aa", rng, 6) if i % 100 else "qqqq xxxx zzzz", "aa") for i in range(1500)] + [(2000 + i, text("bb", rng, 6), "bb") for i in range(300)]
    docs = docs_frame(rows + [(9000, "w" * 40, None), (9001, None, "aa"), (9002, text("bb", rng, 5), None)])
    counts = L.train_counts(docs)
    whole, parts = L.load_model(counts), L.load_model(counts, shard_cells=1)
    own = {lang: [whole_costs[whole.languages.index(lang)] for _, t, l in rows if l == lang and (whole_costs := L.Identifier(whole).entropies(t)) is not None] for lang in ("aa", "bb")}
    want = {lang: np.mean(e) + L.SPREAD * np.std(e) for lang, e in own.items()}
    for model in (whole, parts):
        L.calibrate(model, docs)
        assert model.limits.keys() == want.keys() and all(abs(model.limits[k] - want[k]) < 1e-4 for k in want)
        shown = lambda df: {r.doc_id: (r.lang_pred, round(r.score, 6), r.rejected) for r in df.collect()}
        from pyspark.sql import functions as F

        assert shown(L.identify_calibrated(docs, model, F.lit(True))) == shown(L.identify_documents(docs, model))
    assert len(parts.models) == 2
