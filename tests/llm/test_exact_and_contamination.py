import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from jobtide.llm import decontaminate, exact_dedup
from jobtide.llm.exact_dedup import CountingQuotientFilter


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    for bits in (8, 40, 64):
        parts = [rng.integers(0, 2**bits - 1, n, dtype="u8", endpoint=True) for n in (1, 500, 3000)]
        parts.append(parts[1][:100])
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(p, bits).to_bytes()) for p in parts])
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        got = CountingQuotientFilter.from_bytes(whole.to_bytes()).entries()
        assert np.array_equal(got[0], values) and np.array_equal(got[1], counts.astype("u8"))


def test_exact_duplicates_against_brute_force(docs_frame):
    rng = random.Random(4)
    rows = [(i, rng.choice(["", " ", None, "a b", "ab", "a\tb ", "é", "x" * 5000, "A b", "a b", f"t{i}"])) for i in range(400)]
    rows += [(5, rows[5][1]), (None, "ab")]
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key))
    want = []
    for norm, members in groups.items():
        best = min(members)
        want += [(key, best[2], len(members), (n, no, key) == best, hashlib.sha256(norm.encode()).hexdigest()) for n, no, key in members]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_duplicates(docs_frame(rows).repartition(5)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup.exact_duplicates(docs_frame([])).count() == 0


def test_hot_groups_are_joined_apart(docs_frame, monkeypatch):
    rows = [(i, f"t {i % 9}" if i % 3 else "hot copy") for i in range(200)] + [(900, None), (901, ""), (902, "alone")]
    docs = docs_frame(rows).repartition(3)
    read = lambda: sorted(map(str, exact_dedup.exact_duplicates(docs).collect()))
    kept = lambda: sorted(r.doc_id for r in exact_dedup.drop_exact_duplicates(docs).collect())
    want, stay = read(), kept()
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(exact_dedup, "HOT", 50)
    assert read() == want and kept() == stay and len(stay) == 1 + 6 + 1 + 1
    clashing = docs.withColumn("sha", docs.text).withColumn("norm", docs.text).withColumn("fp", docs.doc_id).withColumn("group_size", docs.text).withColumn("v", docs.text)
    assert sorted(map(str, exact_dedup.exact_duplicates(clashing).collect())) == want
    assert sorted(r.doc_id for r in exact_dedup.drop_exact_duplicates(clashing).collect()) == stay


def brute(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = defaultdict(set)
    for key, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(str(key))
    for key, text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        yield key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_contamination_against_brute_force(spark, docs_frame):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(["a", "b", "C", "é1"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 3, 9, 10, 14, 30]))) for i in range(25)] + [(90, None), (3, "a b c")]
    texts = [(i, text(rng.randint(0, 60)) + ", " + (rng.choice(items)[1] or "") + "; " + text(20)) for i in range(120)] + [(500, None), (501, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 200):
        report = decontaminate.contamination_report(docs_frame(texts), benchmark, block_chars=block)
        got = [tuple(r) for r in decontaminate.contamination_digest(report).collect()]
        assert sorted(got) == sorted(brute(texts, items))


def test_removal_keeps_clean_documents_and_cuts_spans(spark, docs_frame):
    item = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    long = "clean words here and there " * 10
    rows = [(1, long), (2, long + "ONE two, three four five six seven eight nine ten eleven! " + long), (3, item), (4, None), (5, "")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    got = {r.doc_id: r for r in decontaminate.remove_contamination(docs_frame(rows), benchmark).collect()}
    assert set(got) == {1, 2, 4, 5} and got[1].text == long and got[4].text is None
    assert got[2].text == long + "! " + long and got[2].n_chars == len(got[2].text)
    assert decontaminate.remove_contamination(docs_frame(rows), benchmark.limit(0)).count() == 5


def test_results_do_not_depend_on_blocks(spark, docs_frame):
    rng = random.Random(7)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    items = [(i, words(12)) for i in range(12)] + [(3, words(12))]
    rows = [(1, " ".join([items[0][1], words(8), items[1][1], words(8)]))]  # 60 % covered, by two items
    rows += [(2, items[2][1] + " " + words(40)), (2, items[2][1] + " " + words(40)), (3, items[3][1] + " " + items[12][1] + " " + words(90))]
    # the end and the start of an item on both sides of another one: not together before the cut
    rows.append((4, words(90) + " " + " ".join(items[4][1].split()[:6]) + " " + items[5][1] + " " + " ".join(items[4][1].split()[6:]) + " " + words(9)))
    rows += [(5, words(30)), (6, None)]
    docs = docs_frame([(i, t, "en", "s", len(t or "")) for i, t in rows]).repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    report = lambda n: sorted(tuple(r) for r in decontaminate.contamination_digest(decontaminate.contamination_report(docs, benchmark, block_chars=n)).collect())
    clean = lambda n: sorted((r.doc_id, r.text or "", r.n_chars) for r in decontaminate.remove_contamination(docs, benchmark, block_chars=n).collect())
    assert report(60) == report(10**6) and len(report(60)) == len(rows)
    assert clean(60) == clean(10**6) and [r[0] for r in clean(60)] == [2, 2, 3, 4, 5, 6]


def test_a_pass_has_one_automaton(spark, docs_frame, monkeypatch):
    """Several blocks end in written tables: no plan holds two passes, and results are those of one block."""
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(60)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([4, 12, 30])))) for i in range(40)]
    docs = docs_frame([(i, " ".join([*words(30), *rng.choice(items)[1].split(), *words(20)])) for i in range(30)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.contamination_report(docs, benchmark)
    parts = decontaminate.contamination_report(docs, benchmark, block_chars=400)
    assert parts._jdf.queryExecution().toString().count("MapInArrow") <= whole._jdf.queryExecution().toString().count("MapInArrow")
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))
    one, many = (sorted(map(repr, decontaminate.remove_contamination(docs, benchmark, block_chars=b).collect())) for b in (10**6, 400))
    assert one == many
