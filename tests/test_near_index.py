"""Leaders by batches and in one run equal the greedy choice over plain sets."""

import random

import pytest

from jobtide.operators import dedup
from jobtide.operators.near_index import NearIndex


def greedy(rows, threshold):
    """rows in order: (id, set or None) -> id: leader"""
    heads, out = [], {}
    for key, s in rows:
        similar = [h for h, t in heads if s is not None and t is not None and (s == t or s and t and len(s & t) >= threshold * len(s | t))]
        out[key] = similar[0] if similar else key
        if not similar:
            heads.append((key, s))
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    bases = [[f"t{rng.randrange(200)}" for _ in range(rng.randint(3, 30))] for _ in range(n // 8)]
    rows = []
    for i in range(n):
        s = set(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            s.discard(rng.choice(sorted(s))) if len(s) > 1 and rng.random() < 0.5 else s.add(f"new{rng.randrange(9)}")
        rows.append((f"{i:04d}", rng.choice([s] * 18 + [set(), None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, None if s is None else sorted(s)) for k, s in rows], "id string, words array<string>")


@pytest.mark.parametrize("threshold", [0.6, 0.95])
def test_one_run_equals_the_greedy_choice(spark, threshold):
    rows = [r for r in corpus(160, 3) if r[1] is not None]
    got = {r.id: r.leader for r in dedup.similar_leaders(frame(spark, rows), "words", threshold).collect()}
    assert got == greedy(rows, threshold)


def test_rows_with_equal_sets_follow_as_one(spark):
    # 4 equals 3, which follows 1; 4 has no link of its own to 1
    rows = [("1", set("abcdefghij")), ("3", set("abcdefghijk")), ("4", set("abcdefghijk")), ("5", set("abcdefghij"))]
    got = {r.id: r.leader for r in dedup.similar_leaders(frame(spark, rows), "words", 0.9).collect()}
    assert got == {"1": "1", "3": "1", "4": "1", "5": "1"}


@pytest.mark.parametrize("known", [0, 60])
def test_batches_equal_one_run(spark, tmp_path, known):
    rng, threshold = random.Random(6), 0.7
    rows = corpus(180, 5)
    batch = {k: rng.randrange(3) for k, _ in rows}
    index = NearIndex.create(spark, str(tmp_path / "index"), frame(spark, rows[:known]).select("words"), "words", threshold=threshold, buckets=2)
    got = {}
    for b in range(3):
        part = [r for r in rows if batch[r[0]] == b]
        got |= {r.id: r.leader for r in index.add(frame(spark, part), "words", batch=b).collect()}
        if b == 1:
            index.log.compact()
    want = greedy(sorted(rows, key=lambda r: (batch[r[0]], r[0])), threshold)
    assert got == want == {r.id: r.leader for r in index.leaders().collect()}
    version = index.log.version()
    again = index.add(frame(spark, [("0000", {"other"}), ("zzzz", {"x"})]), "words", batch=2)
    assert index.log.version() == version and again.count() == sum(b == 2 for b in batch.values())
    late = {r.id: r.leader for r in NearIndex(spark, index.path, threshold).add(frame(spark, [("0000", {"other"}), ("zzzz", {"x"}), ("yyyy", {"x"})]), "words", batch=3).collect()}
    assert late == {"yyyy": "yyyy", "zzzz": "yyyy"} and {r.leader for r in index.leaders().filter("id = '0000'").collect()} == {want["0000"]}


def long_sets(n, seed):
    """Sets of 20 to 120 tokens in clusters, some a few tokens apart."""
    rng = random.Random(seed)
    bases = [[f"t{rng.randrange(3000)}" for _ in range(rng.randint(20, 120))] for _ in range(n // 10)]
    rows = []
    for i in range(n):
        s = set(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 4])):
            s.discard(rng.choice(sorted(s))) if rng.random() < 0.5 else s.add(f"new{rng.randrange(20)}")
        rows.append((f"{i:04d}", s))
    return rows


def test_one_run_over_long_sets_equals_the_greedy_choice_and_stores_no_set(spark, monkeypatch):
    rows, stored, plain = long_sets(160, 4), [], dedup.written
    monkeypatch.setattr(dedup, "written", lambda df: stored.append(df.schema.simpleString()) or plain(df))
    got = {r.id: r.leader for r in dedup.similar_leaders(frame(spark, rows), "words", 0.95).collect()}
    assert got == greedy(rows, 0.95) and sum(k != v for k, v in got.items()) > 20
    assert stored and not any("array<string>" in s for s in stored)


def test_batches_of_long_sets_equal_the_greedy_choice_and_need_no_order(spark, tmp_path):
    rows = [*long_sets(120, 9), ("0990", set()), ("0991", None), ("0992", set())]
    batch = {k: int(k) % 3 for k, _ in rows}
    index = NearIndex.create(spark, str(tmp_path / "index"), frame(spark, []).select("words"), "words", buckets=2)
    for b in range(3):
        part = [r for r in rows if batch[r[0]] == b]
        index.add(frame(spark, part + part[:1]), "words", batch=b)
    want = greedy(sorted(rows, key=lambda r: (batch[r[0]], r[0])), 0.95)
    assert {r.id: r.leader for r in index.leaders().collect()} == want
    assert sorted(p.name for p in (tmp_path / "index").iterdir()) == ["rows", "sets"] and "array<string>" not in index.log.schema().simpleString()
