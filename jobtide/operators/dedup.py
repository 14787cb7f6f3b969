"""Duplicate postings: by key, by composite key, by description, and near duplicates by token sets.

Row order matters to "the first": it is a column, given as `order`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import casing_score, description_hash, strip
from ..scratch import written
from ..shipping import ship


def keep_first(df: DataFrame, keys: list, *order) -> DataFrame:
    """The row of each key with the smallest order. NULL keys are equal.

    Tasks keep one row per key before anything is shuffled, so a hot key (NULL included) costs a row per task. Keys are hashed to 128 bits.
    """
    values = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.to_json(F.struct(*[v.cast("string").alias(str(i)) for i, v in enumerate(values)]), {"ignoreNullFields": "false"})
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(str(i)) for i, o in enumerate(order)]))
    return df.groupBy(F.unhex(F.md5(text)).alias("key")).agg(first.alias("row")).select("row.*")


def dedup_urls(df: DataFrame, url: str = "job_url", order: str = "_ord") -> DataFrame:
    return keep_first(df, [url], order)


def dedup_composite(df: DataFrame, title: str = "title", company: str = "company_name", location: str = "location", order: str = "_ord") -> DataFrame:
    """One row per lower-case, stripped title, company and location: the best-cased company, then the first."""
    key = lambda c: F.lower(strip(F.col(c)))
    return keep_first(df, [key(title), key(company), key(location)], -casing_score(F.col(company)), order)


def dedup_rows(df: DataFrame, *, title: str = "title_cleaned", url: str = "job_url", company: str = "company_name", location: str = "location", order: str = "_ord") -> DataFrame:
    return dedup_composite(dedup_urls(df, url, order), title, company, location, order)


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    counts = before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after")))
    return counts.withColumn("removed", F.col("before") - F.col("after")).withColumn("removed_pct", F.coalesce(F.round(F.try_divide(F.col("removed") * 100.0, F.col("before")), 2), F.lit(0.0)))


def description_groups(df: DataFrame, description: str = "description", id_col: str = "row_id", order: str = "_ord") -> DataFrame:
    """id, group_hash, representative (the group's first id), members. Groups are counted before they are joined back, so copies do not meet in one task."""
    hashed = df.select(F.col(id_col).alias("id"), F.col(order).alias("_o"), description_hash(F.col(description)).alias("group_hash"))
    heads = hashed.groupBy("group_hash").agg(F.min(F.struct("_o", "id")).alias("h"), F.count("*").alias("members"))
    return hashed.join(heads, "group_hash").select("id", "group_hash", F.col("h.id").alias("representative"), "members")


def fan_out(members: DataFrame, results: DataFrame, id_col: str = "id", rep_col: str = "representative") -> DataFrame:
    """Every member's result: its own where it has one, else its representative's."""
    rep = results.withColumnRenamed(id_col, rep_col)
    lacking = members.select(id_col, rep_col).join(results.select(id_col), id_col, "left_anti")
    return results.unionByName(lacking.join(rep, rep_col).select(*results.columns))


def spread_value(df: DataFrame, group: str, column: str, is_rep: str) -> DataFrame:
    """A column overwritten by the representative's value where that is not NULL."""
    reps = df.filter(F.col(is_rep)).groupBy(F.col(group).alias("_g")).agg(F.first(column).alias("_v"))
    return df.join(reps, df[group].eqNullSafe(F.col("_g")), "left").withColumn(column, F.coalesce("_v", column)).drop("_g", "_v")


# ------------------------------------------------------------ near duplicates


#: Counters of the token frequencies that order tokens; a fixed number, whatever the number of different tokens.
COUNTERS = 1 << 20


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    """counter, n: occurrences of tokens by a hash of the token; at most COUNTERS rows."""
    counter = F.pmod(F.xxhash64("t"), F.lit(COUNTERS)).cast("int")
    return df.select(F.explode(F.array_distinct(tokens)).alias("t")).groupBy(counter.alias("counter")).agg(F.count("*").alias("n"))


def first_tokens(df: DataFrame, tokens: str, counts: DataFrame, threshold: float, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with n, the size of its sets, and prefix: ARRAY<STRUCT<t, left>>, the first tokens of each (as 64-bit hashes) and how many tokens are left from each on.

    Tokens are ordered by the count of their counter, then by hash: one order for all rows, in which any two similar sets share a first token. Tokens that
    share a counter are taken for more frequent than they are, and tokens of equal hash for one, which adds candidates and loses none. The counters go to
    every task, and rows are ordered where they lie: tokens are not shuffled.
    """
    spark = df.sparkSession
    ship(spark)
    found = counts.toArrow()
    size = np.zeros(COUNTERS, "i8")
    size[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(size)
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    columns = list(keep)
    rows = df.select(*columns, F.size(tokens).alias("n"), hashes.alias("prefix"))
    shape = pa.list_(pa.struct([("t", pa.int64()), ("left", pa.int32())]))

    def run(batches):
        for batch in batches:
            every = batch.column(len(columns) + 1)
            values, bounds = every.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(np.maximum(every.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0))])
            occur = shared.value[values % len(shared.value)]
            lengths, ts, left = [0], [], []
            for s, e in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                n = e - s
                k = n - math.ceil(threshold * n) + 1 if n else 0
                order = np.lexsort((values[s:e], occur[s:e]))[:k]
                ts.append(values[s:e][order])
                left.append(n - np.arange(len(order), dtype="i4"))
                lengths.append(lengths[-1] + len(order))
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(ts) if ts else [], pa.int64()), pa.array(np.concatenate(left) if left else [], pa.int32())], names=["t", "left"])
            prefix = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat).cast(shape)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns) + 1], prefix], names=[*columns, "n", "prefix"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", prefix array<struct<t:bigint,left:int>>"
    return rows.mapInArrow(run, ddl)


#: From this threshold on, similar sets are found by equal parts, below it by single tokens: a part has about threshold / (1 - threshold) tokens.
PARTS_FROM = 0.9
#: Sets of a block: at most twice as many meet in one group of `similarities`, give or take the chance of the dealing.
BLOCK = 256


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _class_width(threshold: float) -> float:
    """Width of a size class in logarithms: a little wider than the ratio of similar sizes, so that rounding leaves them in neighbouring classes."""
    return max(-math.log(threshold) * (1 + 1e-9), 1e-9)


def set_parts(df: DataFrame, tokens: str, threshold: float, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` with n, the size of its sets, and prefix: ARRAY<STRUCT<t, left>>, hashes of the parts of each; left is 1 for its own size class, 0 for the next smaller one.

    Similar sets x and y, x not larger, differ in at most K = |x| (1 - threshold) / threshold tokens. In a size class K is that of its largest size; tokens are
    dealt by hash to K + 1 parts, so one part at least is the same in both. A set has parts for its own class and, as the larger one of a pair, for the class below:
    similar sets share the t of a part that is of the own class of one of them. Equal hashes of different parts add candidates and lose none.
    """
    ship(df.sparkSession)
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    columns = list(keep)
    rows = df.select(*columns, F.size(tokens).alias("n"), hashes.alias("prefix"))
    shape = pa.list_(pa.struct([("t", pa.int64()), ("left", pa.int32())]))
    width = _class_width(threshold)

    def run(batches):
        for batch in batches:
            every = batch.column(len(columns) + 1)
            values = every.flatten().to_numpy(zero_copy_only=False).view("u8")
            n = np.maximum(every.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype("i8")
            mixed, owner = _mix(values), np.repeat(np.arange(len(n)), n)
            own = np.floor(np.log(np.maximum(n, 1)) / width).astype("i8")
            classes = [own, own - 1]
            largest = [np.floor(np.exp((c + 1) * width) + 1e-6) for c in classes]
            apart = [np.floor(m * (1 - threshold) / threshold + 1e-9).astype("i8") for m in largest]
            # sets that may not differ at all are found by their digests
            dealt = [np.where((n > 0) & (c >= 0) & (k > 0), k + 1, 0) for c, k in zip(classes, apart, strict=True)]
            bounds = np.concatenate([[0], np.cumsum(dealt[0] + dealt[1])])
            sums, tags, left = np.zeros(bounds[-1], "u8"), np.zeros(bounds[-1], "u8"), np.zeros(bounds[-1], "i4")
            for role, (c, k, first) in enumerate(zip(classes, dealt, (bounds[:-1], bounds[:-1] + dealt[0]), strict=True)):
                used = k[owner] > 0
                of = owner[used]
                np.add.at(sums, first[of] + (mixed[used] % k[of].astype("u8")).astype("i8"), mixed[used] * np.uint64(0x9E3779B97F4A7C15))
                at = np.repeat(np.arange(len(n)), k)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
                tags[first[at] + nth] = _mix((c[at] << 24).astype("u8") + nth.astype("u8") + np.uint64(1))
                left[first[at] + nth] = 1 - role
            flat = pa.StructArray.from_arrays([pa.array(_mix(sums + tags).view("i8"), pa.int64()), pa.array(left, pa.int32())], names=["t", "left"])
            prefix = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat).cast(shape)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns) + 1], prefix], names=[*columns, "n", "prefix"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", prefix array<struct<t:bigint,left:int>>"
    return rows.mapInArrow(run, ddl)


def _overlaps(pairs: pa.Table, members: pa.Table, threshold: float) -> pa.Table:
    """The pairs of one group that are similar: tokens are numbered within the group, sets are rows of bits."""
    ids, sets = members.column("id").combine_chunks(), members.column("set").combine_chunks()
    n = sets.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
    codes = sets.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(n)), n)
    x, y = (pc.index_in(pairs.column(c), value_set=ids).to_numpy() for c in ("a", "b"))
    shared = np.zeros(len(x), "i8")
    step, bits = 4096, 1 << 14
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, bits):
        s, e = np.searchsorted(codes, [low, low + bits])
        held = np.zeros((len(n), bits), bool)
        held[owner[s:e], codes[s:e] - low] = True
        words = np.packbits(held[:, : -(-(int(codes[e - 1]) - low + 1) // 64) * 64], axis=1).view("u8")
        for k in range(0, len(x), step):
            shared[k : k + step] += np.bitwise_count(words[x[k : k + step]] & words[y[k : k + step]]).sum(axis=1, dtype="i8")
    similarity = shared / (n[x] + n[y] - shared)
    found = pa.table([pairs.column("a"), pairs.column("b"), pa.array(similarity, pa.float64())], names=["a", "b", "similarity"])
    return found.filter(pa.array(similarity >= threshold))


def similarities(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b, similarity of the candidates (a, b) whose sets (id, set) have a Jaccard similarity of at least `threshold`; candidates is a stored table.

    Sets are not shipped with each pair. Ids are dealt to blocks of about BLOCK, those of one cluster of candidates (a follows its smallest partner, and
    that one its own) to blocks of their own, small clusters together; a set goes once to each pair of blocks that it has a candidate in. Blocks bound what a group
    holds, whatever the size of a cluster, and which block an id is in changes only the cost.
    """
    spark = candidates.sparkSession
    ship(spark)
    near = candidates.select(F.col("b").alias("id"), F.col("a").alias("label")).unionAll(candidates.select(F.col("a").alias("id"), F.col("a").alias("label")))
    label = written(near.groupBy("id").agg(F.min("label").alias("label")))
    pools = max(1, label.count() // BLOCK)
    for _ in range(2):
        label = label.join(label.select(F.col("id").alias("label"), F.col("label").alias("next")), "label").select("id", F.col("next").alias("label"))
    sizes = label.groupBy("label").agg(F.count("*").alias("size"))
    own = F.xxhash64("label", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK)))
    block = written(label.join(sizes, "label").select("id", F.when(F.col("size") < BLOCK, F.pmod(F.xxhash64("label"), F.lit(pools))).otherwise(own).alias("block")))
    one, other = block.toDF("a", "one"), block.toDF("b", "other")
    dealt = written(candidates.join(one, "a").join(other, "b").select(F.least("one", "other").alias("low"), F.greatest("one", "other").alias("high"), "a", "b"))
    # as a filter, which is taken down to below what makes the sets
    held = sets.filter(F.col("id").isin(block.select("id")))
    placed = dealt.select(F.col("low").alias("of_low"), F.col("high").alias("of_high"), F.explode(F.array("a", "b")).alias("id"))
    members = placed.distinct().join(held, "id").select("of_low", "of_high", "id", "set")
    kind = candidates.schema["a"].dataType.simpleString()

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        return _overlaps(pairs, sets, threshold)

    return dealt.groupBy("low", "high").cogroup(members.groupBy("of_low", "of_high")).applyInArrow(run, f"a {kind}, b {kind}, similarity double")


def near_duplicate_pairs(df: DataFrame, tokens: str, threshold: float = 0.95, id_col: str = "id", parts: DataFrame | None = None) -> DataFrame:
    """a, b, similarity: rows with a < b whose token sets have a Jaccard similarity of at least `threshold`.

    From a threshold of PARTS_FROM on, candidates are sets that have a whole part in common (`set_parts`). Below it, exact prefix filter: tokens are ordered
    from rare to frequent (`first_tokens`), two similar sets share one of their first n - ceil(threshold * n) + 1 tokens. The list of a token is dealt by size of
    set: similar sets lie in one size class or in neighbouring ones, so a frequent token is many smaller lists. A pair that meets at a place from where too few
    tokens are left to be similar is no candidate; the first token that two similar sets share always leaves enough.
    Rows with equal sets are joined by their smallest id, and only different sets are compared; empty sets are equal to each
    other only, NULL sets to none. Sets are told apart by 128-bit hashes. No set is stored; those of candidates are made again from `df`.
    `parts`, from PARTS_FROM on: id, digest, n and prefix of the rows to compare where they are stored already; `df` may then have more rows.
    """
    rows = df.select(F.col(id_col).alias("id"), F.sort_array(F.array_distinct(tokens)).alias("set"))
    digest = F.unhex(F.md5(F.to_json("set"))).alias("digest")
    if threshold >= PARTS_FROM:
        hashed = parts if parts is not None else written(set_parts(rows.select("id", "set", digest), "set", threshold, ["id", "digest"])).filter("digest IS NOT NULL")
        classes = hashed.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        postings = written(classes.select("id", "n", F.inline("prefix")))
        a, b = postings.toDF("x", "nx", "t", "lx"), postings.toDF("y", "ny", "t", "ly")
        close = F.least("nx", "ny") >= F.greatest("nx", "ny") * threshold
        found = a.join(b, "t").filter((F.col("x") < F.col("y")) & (F.col("lx") + F.col("ly") > 0) & close).select(F.col("x").alias("a"), F.col("y").alias("b"))
    else:
        rows = rows.filter("set IS NOT NULL")
        hashed = rows.withColumn("digest", digest)
        classes = written(hashed.groupBy("digest").agg(F.min("id").alias("id"), F.first("set").alias("set")).withColumn("n", F.size("set")))
        prefix = first_tokens(classes, "set", token_counts(classes, "set"), threshold, ["id"])
        prefix = written(prefix.select("id", "n", F.inline("prefix"), F.floor(F.log(F.col("n")) / _class_width(threshold)).alias("class")))
        a = prefix.select("t", F.col("class"), F.col("id").alias("x"), F.col("n").alias("nx"), F.col("left").alias("lx"))
        b = prefix.select("t", F.col("class").alias("own"), F.explode(F.array("class", F.col("class") - 1)).alias("class"), F.col("id").alias("y"), F.col("n").alias("ny"), F.col("left").alias("ly"))
        close = F.least("nx", "ny") >= F.greatest("nx", "ny") * threshold
        enough = F.least("lx", "ly") >= (F.col("nx") + F.col("ny")) * F.lit(threshold / (1 + threshold)) - 1e-6
        once = (F.col("own") != F.col("class")) | (F.col("x") < F.col("y"))
        found = a.join(b, ["t", "class"]).filter(close & enough & once).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    different = similarities(written(found.distinct()), rows, threshold)
    heads = hashed.groupBy("digest").agg(F.min("id").alias("first"))
    same = hashed.select("id", "digest").join(heads, "digest").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    return different.unionByName(same)


def class_pairs(df: DataFrame, tokens: str, threshold: float, id_col: str = "id", parts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs between class representatives, and each row's class (the smallest id with its token set)."""
    pairs = written(near_duplicate_pairs(df, tokens, threshold, id_col, parts))
    ids = df.select(F.col(id_col).alias("id")) if parts is None else parts.select("id")
    same = pairs.filter("similarity = 1.0").select(F.col("b").alias("id"), F.col("a").alias("class_id"))
    return pairs.filter("similarity < 1.0"), ids.join(same, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))


def leaders(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, leader: an id is a leader if no smaller similar id is one; others follow their smallest leader.

    The lexicographically first maximal independent set, in rounds over the links alone: an undecided id with no
    smaller undecided or leading neighbour leads, neighbours above a leader follow. Rounds end when all are decided.
    """
    links = written(pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    state = written(links.select(F.col("low").alias("id")).unionAll(links.select("high")).distinct().withColumn("leads", F.lit(None).cast("boolean")))
    while not state.filter("leads IS NULL").isEmpty():
        low = state.select(F.col("id").alias("low"), F.col("leads").alias("low_leads"))
        seen = links.join(low, "low").groupBy(F.col("high").alias("id")).agg(F.max(F.coalesce("low_leads", F.lit(False))).alias("led"), F.max(F.col("low_leads").isNull()).alias("waits"))
        new = F.when(F.col("leads").isNotNull(), F.col("leads")).when(F.coalesce("led", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        state = written(state.join(seen, "id", "left").select("id", new.alias("leads")))
    heads = state.filter("leads").select(F.col("id").alias("low"))
    follow = links.join(heads, "low").groupBy(F.col("high").alias("id")).agg(F.min("low").alias("leader"))
    return ids.select("id").join(follow, "id", "left").withColumn("leader", F.coalesce("leader", "id"))


def similar_leaders(df: DataFrame, tokens: str, threshold: float = 0.95, id_col: str = "id", parts: DataFrame | None = None) -> DataFrame:
    """id, leader of every row by the similarity of its token sets, as `leaders` of all similar pairs would have it.

    Rows with equal sets have the same similar rows, so the smallest of them decides for all: what it follows, or itself.
    """
    pairs, classes = class_pairs(df, tokens, threshold, id_col, parts)
    classes = written(classes)
    led = leaders(pairs, classes.filter("id = class_id")).toDF("class_id", "leader")
    return classes.join(led, "class_id").select("id", "leader")


def merge_groups(groups: DataFrame, near: DataFrame) -> DataFrame:
    """Description groups whose representatives are near duplicates become one: near has id, leader of representatives."""
    moved = near.select(F.col("id").alias("representative"), F.col("leader").alias("_leader"))
    return groups.join(moved, "representative", "left").withColumn("representative", F.coalesce("_leader", "representative")).drop("_leader")


def prefix_size(n: int, threshold: float) -> int:
    """Tokens of a set of n that a similar set must share one of."""
    return n - math.ceil(threshold * n) + 1
