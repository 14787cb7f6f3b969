"""The n-gram join against all pairs of plain sets, with every way that pairs are met."""

import random
import re

import numpy as np
import pytest

from jobtide.llm import ngram_join as nj


def plain(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def run(docs_frame, rows, **more):
    return sorted((tuple(r) for r in nj.similarity_components(docs_frame(rows).repartition(3), **more).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = text(30), []

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        return words

    for _ in range(30):  # families of few, near the bound
        base = text(rng.randint(20, 90))
        rows += [edited(base, rng.randint(0, 4)) for _ in range(rng.randint(1, 4))]
    base = text(80)
    rows += [edited(base, rng.randint(0, 2)) for _ in range(60)]  # a large family
    chain = text(120)
    for k in range(40):  # each is near the next only
        rows.append(list(chain))
        chain[k * 3] = f"c{k}"
    rows += [passage + text(rng.randint(0, 20)) for _ in range(50)]  # a frequent passage
    rows += [text(n) for n in (1, 2, 3, 3, 4, 5)] + [["a"], ["A"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"]]
    texts = [" ".join(r) for r in rows] + ["", None, " \t\n", "", "long " * 3000, "long " * 3000 + "x"]
    rng.shuffle(texts)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("few, hubs, rows, frequent", [(8, 3, 512, 1 << 21), (2, 1, 7, 1 << 21), (2, 0, 5, 0), (1000, 3, 512, 3)])
def test_equals_all_pairs(spark, docs_frame, monkeypatch, few, hubs, rows, frequent):
    for name, value in (("FEW", few), ("HUBS", hubs), ("BLOCK_ROWS", rows)):
        monkeypatch.setattr(nj, name, value)
    docs = corpus(few + hubs)
    assert run(docs_frame, docs, frequent=frequent) == plain(docs)


def test_rows_without_ids_carry_links(spark, docs_frame, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    middle, end = [*base[:97], "x", "y", "z"], [*base[:94], "u", "v", "w", "x", "y", "z"]
    docs = [(1, " ".join(base)), (None, " ".join(middle)), (3, " ".join(end)), (3, "other words here"), (None, "alone"), (None, None), (5, " ".join(base))]
    monkeypatch.setattr(nj, "BROADCAST_IDS", 0)
    assert run(docs_frame, docs) == plain(docs)


def test_block_product_counts_shared_members(monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_GRAMS", 7)
    rng = np.random.default_rng(1)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype("u8")) for _ in range(n)] for n in (6, 9))
    assert nj.block_product(left, right).tolist() == [[len(np.intersect1d(x, y)) for y in right] for x in left]


def test_empty_tables_and_clashing_names(spark, docs_frame):
    assert run(docs_frame, []) == []
    df = spark.createDataFrame([(1, "a b c d e", 3, "x"), (2, "a b c d e", 4, "y")], "doc_id long, text string, row int, digest string")
    assert [tuple(r) for r in nj.similarity_components(df).orderBy("doc_id").collect()] == [(1, 2, 1), (2, 2, 1)]
