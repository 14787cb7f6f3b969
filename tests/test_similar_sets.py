import random

from jobtide.operators import analytics, dedup


def test_pairs_of_many_sizes_against_brute_force(spark):
    rng = random.Random(6)
    sets = [set(rng.sample(range(60), rng.randint(1, 40))) for _ in range(60)]
    sets += [set(s) ^ set(rng.sample(range(60), rng.randint(0, 3))) for s in sets for _ in range(2)]
    rows = [(i, [str(x) for x in s]) for i, s in enumerate(sets)] + [(900, []), (901, []), (902, None), (903, None)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    for threshold in (0.5, 0.8, 1.0):
        first = {}
        for i, t in rows:
            if t is not None:
                first.setdefault(frozenset(t), i)
        want = {(first[frozenset(t)], i) for i, t in rows if t is not None and first[frozenset(t)] != i}
        heads = sorted((i, s) for s, i in first.items())
        want |= {(i, j) for i, x in heads for j, y in heads if i < j and x and y and len(x & y) >= threshold * len(x | y)}
        got = [(r.a, r.b) for r in dedup.near_duplicate_pairs(df, "tokens", threshold).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_sketched_quantiles_and_bounded_roles(spark):
    df = spark.createDataFrame([("a", float(i), ["x"]) for i in range(101)] + [("b", 1.0, ["x", "y"])], "g string, v double, s array<string>")
    assert analytics.quantiles_by_group(df, "g", "v", accuracy=10_000).collect()[0][1:] == (101, 50.0, 25.0, 75.0)
    assert [tuple(r) for r in analytics.overlap_matrix(df, "g", "s", n_roles=1).collect()] == [("a", "a", 100.0)]
    casing = spark.createDataFrame([("a", "A")], "key string, canonical string")
    clash = df.withColumn("key", df["v"]).withColumn("canonical", df["v"])
    assert analytics.apply_casing(clash, "g", casing).columns == clash.columns


def test_first_tokens_shuffle_no_tokens_and_keep_one_order(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["c", "a"]), (3, []), (4, ["c"])], "id long, s array<string>")
    counts = dedup.token_counts(df, "s")
    found = dedup.first_tokens(df, "s", counts, 0.5, ["id"])
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    h = dict(spark.sql("SELECT t, xxhash64(t) FROM VALUES ('a'), ('b'), ('c') AS v(t)").collect())
    got = {r.id: (r.n, [tuple(p) for p in r.prefix]) for r in found.collect()}
    assert got == {1: (3, [(h["b"], 3), (h["a"], 2)]), 2: (2, [(h["a"], 2), (h["c"], 1)]), 3: (0, []), 4: (1, [(h["c"], 1)])}


def test_similar_sets_share_a_part_and_others_do_not(spark):
    rng = random.Random(8)
    sets = [rng.sample(range(9000), rng.choice([1, 12, 19, 25, 40, 90, 260])) for _ in range(40)]
    sets += [s[: len(s) - rng.randint(0, len(s) // 20)] + rng.sample(range(9000, 9900), rng.randint(0, len(s) // 25)) for s in sets for _ in range(3)]
    # 30 sets that share their two rarest tokens and a third of the others
    sets += [[9998, 9999, *range(10000, 10040), *range(20000 + 80 * i, 20080 + 80 * i)] for i in range(30)]
    df = spark.createDataFrame([(i, [f"w{x}" for x in s]) for i, s in enumerate(sets)] + [(900, []), (901, None)], "id long, tokens array<string>")
    for threshold in (0.9, 0.95):
        found = {r.id: r.prefix for r in dedup.set_parts(df, "tokens", threshold, ["id"]).collect()}
        assert found[900] == [] and found[901] == []
        sides = {i: ({p.t for p in parts}, {p.t for p in parts if p.left}) for i, parts in found.items()}
        for i, x in enumerate(sets):
            for j in range(i):
                x, y = set(sets[i]), set(sets[j])
                if x != y and len(x & y) >= threshold * len(x | y):
                    assert sides[i][0] & sides[j][1] or sides[i][1] & sides[j][0]
        assert not any(sides[i][0] & sides[j][0] for i in range(160, 190) for j in range(160, i))


def test_a_set_goes_once_to_each_pair_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 4)
    base = [f"w{i}" for i in range(200)]
    sets = {i: [*base, f"own{i}"] if i < 30 else [f"v{i}_{k}" for k in range(5)] for i in range(34)} | {40: [f"u{k}" for k in range(40_000)], 41: [f"u{k}" for k in range(39_000)]}
    df = spark.createDataFrame(list(sets.items()), "id long, tokens array<string>")
    received, plain = [], type(df).distinct

    def kept(self):
        out = plain(self)
        if "of_low" in self.columns:
            received.append(out.count())
        return out

    monkeypatch.setattr(type(df), "distinct", kept)
    got = {(r.a, r.b): r.similarity for r in dedup.near_duplicate_pairs(df, "tokens", 0.95).collect()}
    assert got == {(i, j): 200 / 202 for j in range(30) for i in range(j)} | {(40, 41): 0.975}
    # 30 sets in at most 10 blocks, before: two sets for each of 435 pairs
    assert received and received[0] < 400
