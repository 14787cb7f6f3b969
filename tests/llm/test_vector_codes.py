"""Vector codes against loops over plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from jobtide.llm import vector_codes as vc


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], l) for i, v, l in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == width * parts]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def find(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cut:
                held[find(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x) // len(own) for x in zip(*own)] if own else e for own, e in zip(held, books[p])]
    found = [[find(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(e for _, e in f) for f in found]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {}
    for (_, _, l), e in zip(kept, errors):
        by_label[l] = by_label.get(l, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for k, _ in f), e, by_label[l], sha) for (i, _, l), f, e in zip(kept, found, errors)), key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vc.encode_vectors(df.repartition(3), **more)
    return sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def rows_of(n, width, rng, values):
    return [(i, [rng.choice(values) for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("values", [[0.0, 0.25, -0.25], [x / 7 for x in range(-20, 20)]])
def test_equals_plain_version(spark, values):
    rng = random.Random(3)
    rows = rows_of(150, 16, rng, values) + [(7, [0.5] * 16, 1), (7, [0.5] * 16, 1), (None, [0.1] * 16, None)]
    rows += [(200, None, 1), (201, [], 1), (202, [None] * 16, 1), (203, [float("nan")] + [0.0] * 15, 1), (204, [float("inf")] + [0.0] * 15, 1), (205, [0.0] * 8, 1)]
    assert run(spark, rows) == plain(rows)


def test_fewer_rows_than_entries(spark):
    rows = rows_of(5, 8, random.Random(1), [0.1, 0.2, -0.3])
    assert run(spark, rows) == plain(rows)


def test_nearest_equals_a_full_search():
    rng = np.random.default_rng(4)
    for spread in (2, 5, 4096):
        entries, points = rng.integers(-spread, spread, (16, 8)), rng.integers(-spread, spread, (500, 8))
        far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        found, best = vc.nearest(vc.build_tree(entries), entries, points)
        assert found.tolist() == far.argmin(axis=1).tolist() and best.tolist() == far.min(axis=1).tolist()
    same = np.zeros((16, 8), "i8")
    assert vc.nearest(vc.build_tree(same), same, same[:3])[0].tolist() == [0, 0, 0]


def test_empty_tables_labels_of_other_types_and_clashing_names(spark):
    df = spark.createDataFrame([(1, [0.5] * 8, "x", 2), (2, [0.5] * 8, None, 3)], "vec_id long, embedding array<float>, label string, code int")
    got = vc.encode_vectors(df).collect()
    assert sorted(r.vec_id for r in got) == [1, 2] and {r.code for r in got} == {"00" * 8} and {r.label_error for r in got} == {0}
    assert vc.encode_vectors(df.limit(0)).collect() == []


def test_shuffled_label_sums_and_refusals(spark, monkeypatch):
    rows = rows_of(40, 8, random.Random(8), [0.1, 0.9, -0.7])
    monkeypatch.setattr(vc, "BROADCAST_LABELS", 0)
    assert run(spark, rows) == plain(rows)
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [0.1] * 9, 1)])
    with pytest.raises(Exception, match="component"):
        run(spark, [(1, [1e6] * 8, 1)])
