import random
import zlib

import numpy as np

from jobtide.llm import toxicity as T


def test_features_of_a_long_text_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) + rng.choice(["", ",", "."]) for _ in range(800))
    whole = T.feature_set(text, T.WordHashes())
    for size in (50, 333):
        monkeypatch.setattr(T, "_SLICE", size)
        assert np.array_equal(T.feature_set(text, T.WordHashes(limit=10)), whole)
    assert len(T.feature_set(None, T.WordHashes())) == len(T.feature_set(" ,. ", T.WordHashes())) == 0


def test_feature_counts():
    assert len(T.feature_set("a b c d", T.WordHashes())) == 4 + 3 + 2 + 1
    assert len(T.feature_set("a A a", T.WordHashes())) == 1 + 1 + 1


def test_one_class_scores_the_prior():
    slots, weights = T.fit([(0, np.array([1, 2], "u4"))] * 8)
    assert abs(T.Scorer(slots, weights, T.BITS).score("x") - 0.1) < 1e-9
    assert T.Scorer(*T.fit([]), T.BITS).score("") == 0.5


def corpus(n):
    rng = random.Random(3)
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(0, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words) + 1), rng.choice(["idiot", "clown", "scum"]))
        yield i, " ".join(words), int(toxic)


def test_held_out_accuracy_and_edges(spark, docs_frame):
    rows = list(corpus(1500))
    docs = docs_frame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (7, rows[7][1])])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id long, toxic int")
    weights = T.train(docs, labels.filter(~T.held_out()))
    got = T.score_documents(docs, weights).collect()
    assert len(got) == len(rows) + 3
    truth = {i: y for i, _, y in rows}
    test = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(test) > 200 and np.mean(test) > 0.97
    kept = {r.doc_id for r in T.drop_toxic(docs, weights).collect()}
    assert kept == {r.doc_id for r in got if r.score < 0.5} and {5000, 5001} <= kept
    assert T.score_documents(docs.limit(0), weights).count() == 0
    assert 0 <= T.score_documents(docs, T.train(docs, labels.limit(0))).first().score <= 1


def test_learning_step_by_the_book():
    """FTRL-proximal with per-coordinate rates, one coordinate after the other, as the paper writes it."""
    rng = np.random.default_rng(5)
    bits, alpha, beta, l1, l2 = 6, 3.0, 1.0, 0.5, 0.01
    model = T.FtrlProximal(bits, alpha, beta, l1, l2)
    z, n = [0.0] * 65, [0.0] * 65
    for _ in range(300):
        slots, label = np.unique(rng.integers(0, 64, 9)).astype("u4"), int(rng.integers(0, 2))
        w = {}
        for i in [*slots.tolist(), 64]:
            lasso = 0.0 if i == 64 else l1
            sign = 1.0 if z[i] > 0 else -1.0
            w[i] = 0.0 if abs(z[i]) <= lasso else -(z[i] - sign * lasso) / ((beta + n[i] ** 0.5) / alpha + l2)
        p = 1 / (1 + np.exp(-sum(w.values())))
        for i in w:
            g = p - label
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
        model.learn(slots, label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_sample_is_bounded_in_characters(docs_frame, spark):
    rows = [(i, ("bad insult " if i % 2 else "good words ") * 50) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    weights = T.train(docs_frame(rows), labels, train_chars=30_000)
    scores = {r.doc_id: r.score for r in T.score_documents(docs_frame(rows), weights).collect()}
    assert all((s >= 0.5) == bool(i % 2) for i, s in scores.items())


def test_a_worker_that_joined_ngrams_before():
    from jobtide.llm import ngram_join

    list(ngram_join.gram_sets(["one two three"], 2))
    batch = T.pa.record_batch({"doc_id": [1], "toxic": T.pa.array([0], T.pa.int32()), "text": ["one two"]})
    (got,) = T._featurize(T.BITS)([batch])
    assert got.column("slots")[0].as_py() == T.feature_set("one two", T.WordHashes()).tobytes()
