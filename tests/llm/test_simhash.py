import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from jobtide.llm import simhash
from jobtide.llm.components import connected_components


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def print_of(text, n=3):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 540)]
    got = {r.a: r.b for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes({x for l in links for x in l}, links)
    assert got == {k: v for k, v in want.items() if k != v}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_are_those_within_two_bits(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base)
    for b in base[:20]:
        for _ in range(8):
            values.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 4))) & (1 << 64) - 1)
    values |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)}  # long posting lists
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    want = classes(range(len(values)), [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 2])
    links = [(r.a, r.b) for r in simhash.fingerprint_links(spark.createDataFrame(signed, "fp long, id long")).collect()]
    assert all(bin(values[a] ^ values[b]).count("1") <= 2 for a, b in links)
    assert classes(range(len(values)), links) == want


def test_components_against_brute_force(docs_frame):
    rng = random.Random(3)
    words = ["Alpha", "beta", "gamma", "délta", "EPS"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, rng.choice([text(rng.randint(1, 6)), text(60), None, "", "one two", "\t x\x0by "])) for i in range(150)]
    long = text(4000)
    rows += [(200 + i, long + f" tail{i}") for i in range(12)] + [(5, rows[5][1]), (None, "one two")]
    prints = [print_of(t) for _, t in rows]
    ids = [k for k, _ in rows]
    want = classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    least = defaultdict(list)
    for i, c in want.items():
        least[c].append(ids[i])
    expect = [(ids[i], f"{prints[i]:016x}", min(x for x in least[want[i]] if x is not None)) for i in range(len(rows))]
    got = [tuple(r) for r in simhash.simhash_components(docs_frame(rows).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)
    assert simhash.simhash_components(docs_frame([])).count() == 0


def test_near_duplicates_by_similarity(docs_frame):
    rng = random.Random(4)
    rows, truth = [], []
    for g in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, " "), (902, "short"), (903, "Short"), (None, "short")]
    sets = [set(shingles(t, 5)) for _, t in rows]
    jaccard = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if None not in (rows[i][0], rows[j][0]) and jaccard(sets[i], sets[j]) >= 0.8]
    want = classes([k for k, _ in rows if k is not None], links)
    sizes = defaultdict(int)
    for c in want.values():
        sizes[c] += 1
    got = {r.doc_id: r.group_id for r in simhash.near_duplicate_groups(docs_frame(rows).repartition(3)).collect()}
    assert got == {k: c for k, c in want.items() if sizes[c] > 1}
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs_frame(rows)).collect()]
    assert sorted(kept, key=str) == sorted([k for k, c in want.items() if k == c] + [None], key=str)
    assert simhash.drop_near_duplicates(docs_frame([])).count() == 0


def test_chained_edits_of_large_families_against_brute_force(docs_frame):
    rng = random.Random(5)
    rows = []
    for family in range(2):
        versions = [[f"f{family}w{rng.randrange(5000)}" for _ in range(200)]]
        while len(versions) < 350:
            copy = list(rng.choice(versions))
            for at in rng.sample(range(200), 3):
                copy[at] = f"x{rng.randrange(10**6)}"
            versions.append(copy)
        rows += [(1000 * family + i, " ".join(v)) for i, v in enumerate(versions)]
    rows += [(5000 + i, rows[i][1].upper()) for i in range(20)]
    sets = [set(shingles(t, 5)) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = classes([k for k, _ in rows], links)
    got = {r.doc_id: r.group_id for r in simhash.near_duplicate_groups(docs_frame(rows).repartition(3)).collect()}
    assert got == {k: c for k, c in want.items() if list(want.values()).count(c) > 1}


def test_blocks_of_a_band_meet_each_other(docs_frame, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_MEMBERS", 7)
    test_chained_edits_of_large_families_against_brute_force(docs_frame)
