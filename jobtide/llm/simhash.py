"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits agree in at least six of their eight positional
bytes. Posting lists of single bytes have only 256 values a position, so their lists grow with the corpus
and tallying them pair by pair is quadratic. The index therefore posts each fingerprint under pairs
of two-byte lanes (four positional bytes, 2**32 values a list): two differing bits touch at most two of the four
lanes, so each wanted pair shares at least one of the six lists. Pairs of a list are tallied over all eight
positions, kept from six matches on, and verified by counting differing bits.

Equal fingerprints are collapsed first, so copies cost one posting each however many there are. A list
of more than `LONG_LIST` different fingerprints is not paired off. Its fingerprints are posted under
themselves and their 64 one-bit neighbours instead: two fingerprints share such a key exactly when they
differ in at most two bits, a key has at most 65 holders, and linking each holder to the smallest one joins the
same components as all pairs would. Work is linear in any list's length and no link is lost.

Near duplicates by similarity of word shingles (`near_duplicate_groups`): a Jaccard similarity of 0.8 leaves
SimHash fingerprints about ten of 64 bits apart, where bytes guarantee no match. Candidates there are the
SimHash links and, beside them, the documents that agree in a band of min-hashes of the same shingles;
all are verified on whole shingle sets.

Null and empty texts have no words and fingerprint zero, which links like any other. Repeated rows are
rows of their own with equal results. A null doc_id never names a component. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, lower_ascii, record_batch, release, scratch_scope, scratch_table, text_or_empty
from .components import connected_components

WORDS = 3
SEED = 42
#: Longer posting lists take the neighbour keys instead of pairs.
LONG_LIST = 8
_LANES = list(combinations(range(4), 2))
_WORD_BLOCK = 1 << 17


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a text, in blocks; repeats included."""
    found = lower_ascii(text).split()  # bytes split at space and the controls from tab to carriage return
    digest = xxhash.xxh64_intdigest
    if 0 < len(found) < words:
        yield np.array([digest(b" ".join(found), SEED)], "<u8")
        return
    for a in range(0, len(found) - words + 1, _WORD_BLOCK):
        part = found[a : a + _WORD_BLOCK + words - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), "i8", len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(starts[: len(part) - words + 1].tolist(), ends[words - 1 :].tolist())], "<u8")


def simhash(blocks: Iterator[np.ndarray]) -> int:
    """Signed 64-bit fingerprint; a bit is set where more than half of the hashes have it."""
    total, n = np.zeros(64, "i8"), 0
    for hashes in blocks:
        for a in range(0, len(hashes), 1 << 16):
            part = hashes[a : a + (1 << 16)]
            total += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
            n += len(part)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _fingerprint(words: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield record_batch(_PRINTS, {"doc_id": batch.column(0), "fp": [simhash(shingle_hashes(t, words)) for t in texts]})

    return run


def fingerprints(docs: DataFrame, *, words: int = WORDS) -> DataFrame:
    """doc_id, fp (signed). No shuffle."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_fingerprint(words), "doc_id long, fp long")


def _lane(i: int):
    return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links a, b between the ids of different fingerprints (columns fp, id; fp unique) that differ in at most two bits."""
    keys = [F.lit(n << 32).bitwiseOR(F.shiftleft(_lane(i), 16)).bitwiseOR(_lane(j)) for n, (i, j) in enumerate(_LANES)]
    postings = prints.select("fp", "id", F.explode(F.array(*keys)).alias("list"))
    lists = scratch_table(postings.groupBy("list").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-lists")
    posted = scratch_table(postings.join(lists, "list"), "simhash-posted")

    short = posted.filter(F.col("n") <= LONG_LIST)
    a, b = short.select("list", F.col("fp").alias("x"), F.col("id").alias("a")), short.select("list", F.col("fp").alias("y"), F.col("id").alias("b"))
    differ = F.col("x").bitwiseXOR(F.col("y"))
    tally = sum((F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for i in range(8))
    pairs = a.join(b, (a["list"] == b["list"]) & (F.col("x") < F.col("y")) & (tally >= 6) & (F.bit_count(differ) <= 2)).select("a", "b")

    neighbours = [F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64))]
    long = posted.filter(F.col("n") > LONG_LIST).select("fp", "id").distinct()
    held = long.select("id", F.explode(F.array(*neighbours)).alias("key")).groupBy("key").agg(F.collect_set("id").alias("ids")).filter(F.size("ids") > 1)
    stars = held.select(F.array_min("ids").alias("a"), F.explode("ids").alias("b")).filter("a <> b")

    links = scratch_table(pairs.unionAll(stars).distinct(), "simhash-links")
    release(lists, posted)
    return links


def simhash_components(docs: DataFrame, *, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = scratch_table(fingerprints(docs, words=words), "simhash-prints")
    unique = scratch_table(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-unique")
    nodes = connected_components(fingerprint_links(unique.filter("id IS NOT NULL")))
    labels = unique.join(nodes.withColumnsRenamed({"a": "id", "b": "root"}), "id", "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- similarity of shingle sets

SIMILARITY = 0.8
SHINGLE = 5
BANDS, ROWS = 16, 4
#: Members of a band up to this many are compared pair by pair; a larger band is compared with its hub first.
SMALL_BUCKET = 8
#: Members, and bytes of shingle sets, of a block of a large band; each task compares two blocks.
BLOCK_MEMBERS, BLOCK_BYTES = 1024, 16 << 20
#: Candidate ids are broadcast up to this many (16 MB); beyond it the join shuffles.
BROADCAST_IDS = 1 << 20
_MIX = np.random.default_rng(20_240_229).integers(1, 2**63, (2, BANDS * ROWS), dtype="u8") | np.uint64(1)


def min_hash_bands(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a shingle set; an empty set has none."""
    lowest = np.full(BANDS * ROWS, np.iinfo("u8").max, "u8")
    for a in range(0, len(shingles), 4096):
        part = shingles[a : a + 4096, None]
        mixed = part * _MIX[0] + _MIX[1]
        mixed ^= mixed >> np.uint64(29)
        np.minimum(lowest, (mixed * _MIX[1]).min(axis=0), out=lowest)
    keys = np.arange(BANDS, dtype="u8")
    for row in lowest.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys.view("i8")


def shingle_set(text: str | None, words: int) -> np.ndarray:
    blocks = [np.unique(b) for b in shingle_hashes(text, words)]
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, "u8")


_SKETCH = pa.schema([("id", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("id", pa.int64()), ("shingles", pa.binary()), ("digest", pa.binary())])


def _sketch(words: int):
    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"id": batch.column(0).to_pylist(), "fp": [], "bands": []}
            for t in batch.column(1).to_pylist():
                blocks = list(shingle_hashes(t, words))
                out["fp"].append(simhash(iter(blocks)))
                out["bands"].append(min_hash_bands(np.unique(np.concatenate(blocks))).tolist() if blocks else [])
            yield record_batch(_SKETCH, out)

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()]
            yield record_batch(_SETS, {"id": batch.column(0), "shingles": sets, "digest": list(map(xxhash.xxh3_128_digest, sets))})

    return run


def near(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
    whole = len(x) + len(y) - common
    return not whole or common >= similarity * whole


def _similar(similarity: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.bool_())])

    def run(batches):
        for batch in batches:
            same = [near(np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8"), similarity) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield record_batch(schema, {"a": batch.column(0), "b": batch.column(1), "same": same})

    return run


def parity_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits per set, the parity of its members at each bit: two rows differ in at most as many bits as the sets have unshared members."""
    mean = sum(map(len, sets)) / max(1, len(sets))
    width = min(max(9, int(4 * mean).bit_length()), 15)
    rows = np.zeros((len(sets), 1 << width - 6), "u8")
    for row, s in zip(rows, sets):
        at = ((s * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - width)).astype("i8")
        row[:] = np.packbits((np.bincount(at, minlength=1 << width) & 1).astype("u1"), bitorder="little").view("<u8")
    return rows


def links_between(sets: list[np.ndarray], labels: np.ndarray, left: np.ndarray, right: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """Links that join the components of all similar pairs between `left` and `right` (within `left` without it), given what `labels` joins.

    Every pair whose labels differ is tested: by sizes, by parity sketches (both exclude only pairs that cannot be similar), then on
    the sets, nearest first. A link joins two labels, so later pairs of them need no test.
    """
    roots = np.unique(labels, return_inverse=True)[1]
    sizes, bits = np.fromiter(map(len, sets), "i8", len(sets)), parity_sketches(sets)
    share, found = (1 - similarity) / (1 + similarity), []
    for k, i in enumerate(left.tolist()):
        js = left[k + 1 :] if right is None else right
        js = js[roots[js] != roots[i]]
        js = js[np.minimum(sizes[js], sizes[i]) >= similarity * np.maximum(sizes[js], sizes[i])]
        apart = np.bitwise_count(bits[js] ^ bits[i]).sum(axis=1, dtype="i8")
        fit = apart <= share * (sizes[js] + sizes[i]) + 1e-6
        for j in js[fit][np.argsort(apart[fit], kind="stable")].tolist():
            if roots[i] != roots[j] and near(sets[i], sets[j], similarity):
                found.append((i, j))
                roots[roots == roots[j]] = roots[i]
    return found


def _compare_blocks(similarity: float):
    def run(key, group):
        low, high = key[1].as_py(), key[2].as_py()
        ids, own, labels = (group.column(c).to_numpy() for c in ("id", "own", "label"))
        sets = [np.frombuffer(x.as_buffer(), "u8") for x in group.column("shingles")]
        left, right = np.flatnonzero(own == low), None if low == high else np.flatnonzero(own == high)
        pairs = [sorted((ids[i], ids[j])) for i, j in links_between(sets, labels, left, right, similarity)]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(lean(_similar(similarity)), "a long, b long, same boolean").filter("same").select("a", "b")


def _joined(edges: list[DataFrame]) -> DataFrame:
    whole = edges[0]
    for more in edges[1:]:
        whole = whole.unionAll(more)
    return connected_components(whole)


def _large_band_links(large: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between members of a large band (columns bucket, id) that `nodes` leaves in different components.

    The members of a band's most frequent component need no test among each other. They and the others make blocks;
    each block of others meets every block, a pair of blocks in one task.
    """
    labels = nodes.select(F.col("a").alias("id"), F.col("b").alias("label"))
    held = sets.select("id", F.length("shingles").alias("bytes"))
    labelled = large.join(labels, "id", "left").join(held, "id").select("bucket", "id", "bytes", F.coalesce("label", "id").alias("label"))
    labelled = scratch_table(labelled, "near-labelled")
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    parts = parts.groupBy("bucket").agg(F.max(F.struct("n", "label", "bytes")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).filter("n > main.n")
    blocks = lambda n, size: F.ceil(F.greatest(n / F.lit(BLOCK_MEMBERS), size / F.lit(BLOCK_BYTES))).cast("long")
    parts = scratch_table(parts.select("bucket", F.col("main.label").alias("main"), blocks(F.col("main.n"), F.col("main.bytes")).alias("inner"), blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("outer")), "near-parts")
    place = F.xxhash64("id", "bucket")
    inside = F.col("label") == F.col("main")
    own = F.when(inside, F.col("outer") + F.pmod(place, "inner")).otherwise(F.pmod(place, "outer"))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1))
    cells = labelled.join(parts, "bucket").select("bucket", "id", "label", own.alias("own"), meets.alias("other"))
    cells = cells.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "label", "own")
    rows = cells.join(sets.select("id", "shingles"), "id")
    links = scratch_table(rows.groupBy("bucket", "low", "high").applyInArrow(_compare_blocks(similarity), "a long, b long"), "near-links")
    release(labelled, parts)
    return links


def near_duplicate_groups(docs: DataFrame, *, words: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, group_id (the smallest doc_id of the group) of documents that have a near duplicate.

    Links join documents whose sets of `words`-word shingles have a Jaccard similarity of `similarity` or
    more. Texts without words equal each other. Candidates are the members of a min-hash band and the
    SimHash links. Equal sets are linked first and stand for each other. A small band is compared pair by pair. In a larger one each
    member is compared with the hub, the member whose bands are fullest: of an original and its edited copies that is the
    original, which is near most of them. Of what is not in one component by then every pair is tested, in blocks
    (`_large_band_links`), so no pair of a band is left out. The work on such a rest is quadratic in its members, but a
    pair costs some words of a bit sketch. Rows that share a doc_id are one document; rows without one are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    sketch = scratch_table(rows.mapInArrow(lean(_sketch(words)), "id long, fp long, bands array<long>"), "near-sketch")
    unique = sketch.groupBy("fp").agg(F.min("id").alias("id"))
    unique = scratch_table(unique, "near-unique")
    by_print = sketch.select("fp", F.col("id").alias("b")).join(unique.select("fp", F.col("id").alias("a")), "fp").filter("a <> b").select("a", "b")
    simhash_pairs = fingerprint_links(unique).unionAll(by_print).distinct()

    banded = sketch.select("id", F.explode("bands").alias("bucket"))
    shared = scratch_table(banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "near-shared")
    members = scratch_table(banded.join(shared, "bucket").select("bucket", "id").distinct(), "near-members")
    simhash_pairs = scratch_table(simhash_pairs, "near-simhash")

    wanted = members.select("id").unionAll(simhash_pairs.select(F.col("a").alias("id"))).unionAll(simhash_pairs.select(F.col("b").alias("id"))).distinct()
    wanted = scratch_table(wanted, "near-wanted")
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    sets = scratch_table(rows.join(ids, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(lean(_sets(words)), "id long, shingles binary, digest binary"), "near-sets")

    first = scratch_table(sets.groupBy("digest").agg(F.min("id").alias("first")), "near-first")
    copies = scratch_table(sets.select("id", "digest").join(first, "digest").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")), "near-copies")
    members = scratch_table(members.join(first.select(F.col("first").alias("id")), "id", "left_semi"), "near-distinct")

    popular = scratch_table(members.join(shared, "bucket").groupBy("id").agg(F.sum("n").alias("pop")), "near-popular")
    known = scratch_table(members.join(popular, "id"), "near-known")
    sizes = scratch_table(known.groupBy("bucket").agg(F.count("*").alias("n"), F.max(F.struct("pop", F.bitwise_not("id").alias("low"))).alias("hub")).filter("n > 1"), "near-sizes")
    sized = scratch_table(known.join(sizes.select("bucket", "n", F.bitwise_not(F.col("hub.low")).alias("hub")), "bucket").select("bucket", "id", "n", "hub"), "near-sized")
    few, many = sized.filter(F.col("n") <= SMALL_BUCKET), sized.filter(F.col("n") > SMALL_BUCKET)
    small = few.select("bucket", F.col("id").alias("a")).join(few.select("bucket", F.col("id").alias("b")), "bucket").filter("a < b").select("a", "b")
    to_hub = many.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    pairs = small.unionAll(to_hub).unionAll(simhash_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    links = [copies, scratch_table(_verified(pairs, sets, similarity), "near-links")]
    nodes = _joined(links)
    if not many.isEmpty():
        more = _large_band_links(many.select("bucket", "id"), nodes, sets, similarity)
        if not more.isEmpty():
            nodes = _joined([nodes, more])
    heads = nodes.select(F.col("b").alias("doc_id")).distinct()
    return nodes.select(F.col("a").alias("doc_id"), F.col("b").alias("group_id")).unionAll(heads.withColumn("group_id", F.col("doc_id")))


def drop_near_duplicates(docs: DataFrame, *, words: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without those that have a near duplicate with a smaller doc_id in their group."""
    with scratch_scope(docs.sparkSession) as keep:
        groups = keep(scratch_table(near_duplicate_groups(docs, words=words, similarity=similarity).filter("doc_id <> group_id").select("doc_id"), "near-dropped"))
    dropped = F.broadcast(groups) if groups.count() <= BROADCAST_IDS else groups
    return docs.join(dropped, "doc_id", "left_anti")
