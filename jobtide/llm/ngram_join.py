"""Similarity join of documents by the Jaccard index of their word n-gram sets: a blocked product of the incidence matrix with its transpose.

The matrix has a row per different set and a column per n-gram; an entry of the product is the number of n-grams two sets
share. It is never formed whole, as sizes bound what an entry must reach:

* Equal sets are one row. Copies cost nothing beyond their first.
* Columns are ordered by how often they occur (counted over all documents, those beyond a bound of broadcast columns by hash).
  Two sets that are similar enough share a column among the first n - ceil(0.85 n) + 1 of either, so only these entries are
  multiplied, and what is frequent comes last and is rarely among them.
* A column of few rows adds its count to each of its pairs. Equal columns are added up before, and a pair whose
  count, with all that may still come, stays below the bound is discarded.
* A column of more rows is cut by sizes first, so that rows whose sizes alone exclude a link do not meet. Its rows
  are then multiplied with one of them (the hub). What is not in one component after some hubs is multiplied in blocks of rows
  against blocks of rows, n-grams in blocks as well, so that every pair of a column is decided and no task holds more than two blocks.

Pairs that remain are verified on whole sets, by integers: 100 x shared >= 85 x united. N-grams are 64-bit hashes of the hashes
of their words, sets are told apart by 128 bits.

Null and empty texts, and texts of white space only, have no n-gram and link with nothing, not even each other. Rows that share
a doc_id are rows of their own. A row without doc_id links like others and carries links on, but never names a component; one of such rows only has a
null component_id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, lower_ascii, record_batch, release, scratch_table, text_or_empty, worker_cache
from .components import connected_components

WORDS = 4
#: A link: PART * shared >= SHARE * united.
SHARE, PART = 85, 100
#: Rows of a column up to this many are paired off.
FEW = 8
#: Most columns whose frequency is broadcast (9 bytes each); the threshold is the power of two that fits.
FREQUENT = 1 << 21
#: Hubs that a column's rows are compared with before blocks.
HUBS = 3
#: Rows, and bytes of their sets, of a block; n-grams that are multiplied at once.
BLOCK_ROWS, BLOCK_BYTES, BLOCK_GRAMS = 512, 8 << 20, 4096
#: Ids that are broadcast up to this many; beyond it the join shuffles.
BROADCAST_IDS = 1 << 20
#: Documents per key of the frequency count: about half a million n-grams meet in a group.
CHUNK_DOCUMENTS = 1024
#: Bytes of texts whose words are hashed at once.
TEXT_BLOCK = 1 << 19
_HELD_GRAMS = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- sets


def _powers(odd: np.uint64, size: int) -> np.ndarray:
    steps = np.full(size, odd, "u8")
    steps[0] = 1
    return np.multiply.accumulate(steps)


class WordHashes:
    """64-bit hashes of all words of a block of bytes at once: a random number per byte times the power of its place, summed from a word's start."""

    def __init__(self):
        self.bytes = np.random.default_rng(20_240_613).integers(1, 2**64, 256, dtype="u8", endpoint=False)
        self.space = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", "u1"))
        self.odd = int(_ODD)
        self.up = self.down = np.zeros(0, "u8")

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word."""
        at = np.frombuffer(raw, "u1")
        if len(at) > len(self.up):
            self.up, self.down = _powers(_ODD, len(at)), _powers(np.uint64(pow(self.odd, -1, 1 << 64)), len(at))
        inside = np.zeros(len(at) + 2, bool)
        inside[1:-1] = ~self.space[at]
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        sums = np.zeros(len(at) + 1, "u8")
        np.cumsum(self.bytes[at] * self.up[: len(at)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype("u8")
        return mixed(found), starts


def mixed(values: np.ndarray) -> np.ndarray:
    for shift in (29, 32):
        values = (values ^ (values >> np.uint64(shift))) * _ODD
    return values ^ (values >> np.uint64(31))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of so many words, in their order."""
    grams = np.full(len(words) - size + 1, size, "u8")
    for k in range(size):
        grams = grams * _ODD + words[k : len(words) - size + 1 + k]
    return mixed(grams)


def gram_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Sorted different hashes of the n-grams of each text; of fewer words the whole sequence is one."""
    hashes: WordHashes = worker_cache("word hashes", WordHashes)

    def of_block(block: list[bytes]) -> Iterator[np.ndarray]:
        raw = b"\n".join(block)
        found, starts = hashes.of(raw)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in block])])
        bounds = np.searchsorted(starts, begins).tolist()
        every = _grams(found, words) if len(found) >= words else np.zeros(0, "u8")
        for s, e in zip(bounds, bounds[1:]):
            yield np.unique(every[s : e - words + 1]) if e - s >= words else _grams(found[s:e], e - s) if e > s else np.zeros(0, "u8")

    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = lower_ascii(text)
        if len(raw) > TEXT_BLOCK:
            yield from of_block(held)
            held, size = [], 0
            found = np.concatenate([hashes.of(part)[0] for part in _at_spaces(raw)])
            yield np.unique(_grams(found, min(words, len(found)))) if len(found) else found
            continue
        held.append(raw)
        size += len(raw)
        if size > TEXT_BLOCK:
            yield from of_block(held)
            held, size = [], 0
    if held:
        yield from of_block(held)


def _at_spaces(raw: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space. A run without any is one part."""
    at = 0
    while at < len(raw):
        found = _SPACE.search(raw, at + TEXT_BLOCK)
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def gram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    return next(gram_sets([text], words))


def prefix_length(n: int) -> int:
    """Of a set of n members, how many of the first it takes to share one with any similar set."""
    return n - -(-SHARE * n // PART) + 1


def linked(shared, x, y):
    """For numbers and Columns: sets of x and y members with so many in common are similar."""
    return (SHARE + PART) * shared >= SHARE * (x + y)


# ---------------------------------------------------------------- frequencies

_CHUNKS = pa.schema([("chunk", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])
_FREQUENT = pa.schema([("gram", pa.int64()), ("n", pa.int64())])


def _short_key(grams: np.ndarray, bits: int) -> np.ndarray:
    """The first `bits` + 32 bits of a hash: a key of the count and a place within it. Columns that share one are counted together, which is right for an order."""
    return grams >> np.uint64(32 - bits)


def _slices(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype("i4")), pa.py_buffer(np.ascontiguousarray(values))])


def _chunk_rows(keys: np.ndarray) -> pa.RecordBatch:
    keys, n = np.unique(keys, return_counts=True)
    chunk = keys >> np.uint64(32)
    ids = np.unique(chunk)
    single = n == 1
    once = (keys[single] & np.uint64(0xFFFFFFFF)).astype("u4")
    more = np.stack([(keys[~single] & np.uint64(0xFFFFFFFF)).astype("u4"), n[~single].astype("u4")], axis=1).reshape(-1).view("u8")
    cuts = lambda part: np.append(np.searchsorted(part, ids), len(part))
    return pa.RecordBatch.from_arrays([pa.array(ids.astype("i8")), _slices(once, cuts(chunk[single])), _slices(more, cuts(chunk[~single]))], schema=_CHUNKS)


def _gram_chunks(words: int, bits: int):
    def run(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for grams in gram_sets(batch.column(0).to_pylist(), words):
                held.append(_short_key(grams, bits))
                size += len(held[-1])
                if size >= _HELD_GRAMS:
                    yield _chunk_rows(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield _chunk_rows(np.concatenate(held))

    return run


def _chunk_counts(least: int):
    def run(key, group):
        once = np.frombuffer(b"".join(group.column("once").to_pylist()), "u4")
        more = np.frombuffer(b"".join(group.column("more").to_pylist()), "u4").reshape(-1, 2)
        keys, n = np.concatenate([once, more[:, 0]]), np.concatenate([np.ones(len(once), "i8"), more[:, 1].astype("i8")])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, "i8")
        n = np.add.reduceat(n, first) if len(keys) else n
        kept = n >= least
        return pa.table({"gram": pa.array((key[0].as_py() << 32) + keys[first][kept].astype("i8"), pa.int64()), "n": pa.array(n[kept], pa.int64())})

    return run


def frequent_grams(texts: DataFrame, words: int, bits: int, *, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted short keys of the most frequent columns, at most `frequent`, and the power of two of their frequency."""
    chunks = texts.mapInArrow(lean(_gram_chunks(words, bits)), "chunk long, once binary, more binary")
    counts = scratch_table(chunks.groupBy("chunk").applyInArrow(_chunk_counts(FEW + 1), "gram long, n long"), "grams-frequent")
    power = F.length(F.bin("n"))
    least, held = 64, 0
    for k, n in sorted(((r.k, r["count"]) for r in counts.groupBy(power.alias("k")).count().collect()), reverse=True):  # a row per power of two
        held += n
        if held > frequent:
            break
        least = k
    found = counts.filter(power >= least).select("gram", power.cast("int").alias("k")).toArrow().sort_by("gram")
    release(counts)
    return found["gram"].to_numpy().astype("u8"), found["k"].to_numpy().astype("u1")


# ---------------------------------------------------------------- rows of the matrix

_ROWS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("prefix", pa.list_(pa.int64()))])


def _prefixes(words: int, bits: int, shared):
    def run(batches):
        keys, powers = shared.value
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column(0).to_pylist(), "n": [], "digest": [], "prefix": []}
            for grams in gram_sets(batch.column(1).to_pylist(), words):
                prefix = np.zeros(0, "i8")
                if len(grams):
                    power = np.zeros(len(grams), "u1")
                    if len(keys):
                        short = _short_key(grams, bits)
                        at = np.minimum(np.searchsorted(keys, short), len(keys) - 1)
                        known = keys[at] == short
                        power[known] = powers[at[known]]
                    prefix = grams[np.argsort(power, kind="stable")[: prefix_length(len(grams))]].view("i8")
                out["n"].append(len(grams))
                out["digest"].append(xxhash.xxh3_128_digest(grams.tobytes()))
                out["prefix"].append(prefix)
            yield record_batch(_ROWS, out)

    return run


def _whole_sets(words: int):
    schema = pa.schema([("digest", pa.binary()), ("grams", pa.binary())])

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            out: dict[str, list] = {"digest": [], "grams": []}
            for raw in map(np.ndarray.tobytes, gram_sets(batch.column(0).to_pylist(), words)):
                digest = xxhash.xxh3_128_digest(raw)
                if raw and digest not in seen:
                    seen.add(digest)
                    out["digest"].append(digest)
                    out["grams"].append(raw)
            yield record_batch(schema, out)

    return run


# ---------------------------------------------------------------- products


def _pair_links(batches):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        kept: dict[str, list] = {"a": [], "b": []}
        for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
            if linked(min(len(x), len(y)), len(x), len(y)) and linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                kept["a"].append(a)
                kept["b"].append(b)
        yield record_batch(schema, kept)


def block_product(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared members of every left and every right set. Only n-grams that both sides hold are multiplied, a block of them at a time."""
    out = np.zeros((len(left), len(right)), "i4")
    if not left or not right:
        return out
    x, y = np.concatenate(left), np.concatenate(right)
    row_x, row_y = np.repeat(np.arange(len(left)), list(map(len, left))), np.repeat(np.arange(len(right)), list(map(len, right)))
    columns = np.intersect1d(x, y)
    in_x, in_y = np.isin(x, columns), np.isin(y, columns)
    x, row_x, y, row_y = np.searchsorted(columns, x[in_x]), row_x[in_x], np.searchsorted(columns, y[in_y]), row_y[in_y]
    order_x, order_y = np.argsort(x, kind="stable"), np.argsort(y, kind="stable")
    x, row_x, y, row_y = x[order_x], row_x[order_x], y[order_y], row_y[order_y]
    for start in range(0, len(columns), BLOCK_GRAMS):
        parts = []
        for at, row, rows in ((x, row_x, len(left)), (y, row_y, len(right))):
            s, e = np.searchsorted(at, (start, start + BLOCK_GRAMS))
            dense = np.zeros((rows, min(BLOCK_GRAMS, len(columns) - start)), "f4")
            dense[row[s:e], at[s:e] - start] = 1
            parts.append(dense)
        out += (parts[0] @ parts[1].T).astype("i4")  # sums below 2**24 are exact
    return out


def _block_links(key, group):
    low, high = key[2].as_py(), key[3].as_py()
    ids, own, labels = (group.column(c).to_numpy() for c in ("row", "own", "label"))
    sets = [np.frombuffer(x.as_buffer(), "u8") for x in group.column("grams")]
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    n = np.fromiter(map(len, sets), "i8", len(sets))
    shared = block_product([sets[i] for i in left], [sets[j] for j in right])
    i, j = np.nonzero(linked(shared, n[left][:, None], n[right][None, :]) & (labels[left][:, None] != labels[right][None, :]))
    a, b = np.minimum(ids[left[i]], ids[right[j]]), np.maximum(ids[left[i]], ids[right[j]])
    # of all links between two labels one is enough to join them
    tied = np.unique(np.stack([np.minimum(labels[left[i]], labels[right[j]]), np.maximum(labels[left[i]], labels[right[j]])], axis=1), axis=0, return_index=True)[1] if len(i) else []
    return pa.table({"a": pa.array(a[tied] if len(i) else [], pa.int64()), "b": pa.array(b[tied] if len(i) else [], pa.int64())})


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among pairs of rows (a < b)."""
    left, right = sets.select(F.col("row").alias("a"), F.col("grams").alias("x")), sets.select(F.col("row").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_pair_links, "a long, b long")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _few_pairs(members: DataFrame, *keys: str) -> DataFrame:
    """a, x, b, y, shared: pairs of rows (with sizes) of columns of at most FEW rows, and in how many columns they meet."""
    lists = members.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("row", "n"))).alias("rows"))
    same = lists.groupBy("rows").agg(F.count("*").alias("c"))
    each = same.select("rows", "c", F.posexplode("rows").alias("i", "x"))
    pairs = each.select("c", "x", F.explode(F.expr("slice(rows, i + 2, size(rows))")).alias("y")).filter(linked(F.least("x.n", "y.n"), F.col("x.n"), F.col("y.n")))
    return pairs.groupBy(F.col("x.row").alias("a"), F.col("x.n").alias("x"), F.col("y.row").alias("b"), F.col("y.n").alias("y")).agg(F.sum("c").alias("shared"))


def _column_pairs(posted: DataFrame) -> DataFrame:
    """Pairs of rows that meet in columns of few rows, without those whose count stays below the bound whatever other columns add."""
    pairs = _few_pairs(posted.filter(F.col("m") <= FEW), "gram")
    long = scratch_table(posted.filter(F.col("m") > FEW).groupBy("row").agg(F.count("*").alias("k")), "grams-long")
    pairs = pairs.join(long.toDF("a", "ka"), "a", "left").join(long.toDF("b", "kb"), "b", "left")
    unseen = F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0)))
    behind = lambda n: F.ceil(F.col(n) * SHARE / PART) - 1
    most = F.least(F.col("shared") + unseen + F.greatest(behind("x"), behind("y")), F.col("x"), F.col("y"))
    return pairs.filter(linked(most, F.col("x"), F.col("y"))).select("a", "b")


def _cells(posted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns of many rows, cut by sizes into cells (gram, size class): those of few rows, and the different ones of more."""
    # sizes of linked sets differ by less than a class, so they share a cell
    kind = F.floor(F.log("n") / 0.165)
    cells = posted.filter(F.col("m") > FEW).select("gram", "row", "n", F.explode(F.array(kind, kind + 1)).alias("kind"))
    cells = scratch_table(cells, "grams-cells")
    held = cells.groupBy("gram", "kind").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("row")).alias("s"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("t")).filter("m > 1")
    held = scratch_table(held, "grams-held")
    many = scratch_table(held.filter(F.col("m") > FEW).groupBy("m", "s", "t").agg(F.min(F.struct("gram", "kind")).alias("cell")).select("cell.*"), "grams-many")
    small = scratch_table(cells.join(held.filter(F.col("m") <= FEW).select("gram", "kind"), ["gram", "kind"]), "grams-small")
    large = scratch_table(cells.join(many, ["gram", "kind"]).select("gram", "kind", "row", "n"), "grams-large")
    release(cells, held, many)
    return small, large


def _labelled(large: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of cells whose rows are not all in one component, with their component and if it is the cell's largest."""
    rows = scratch_table(large.join(nodes.toDF("row", "label"), "row", "left").withColumn("label", F.coalesce("label", "row")), "grams-labelled")
    parts = rows.groupBy("gram", "kind", "label").agg(F.count("*").alias("m"))
    main = parts.groupBy("gram", "kind").agg(F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("all")).filter("all > main.m")
    main = scratch_table(main.select("gram", "kind", F.col("main.label").alias("main")), "grams-main")
    out = scratch_table(rows.join(main, ["gram", "kind"]), "grams-open")
    release(rows, main)
    return out


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Each cell's most popular row outside its largest component, with all rows of other components."""
    hub = rows.filter("label <> main").groupBy("gram", "kind").agg(F.max(F.struct("pop", (-F.col("row")).alias("low"), "label", "n")).alias("hub"))
    hub = scratch_table(hub.select("gram", "kind", (-F.col("hub.low")).alias("hub"), F.col("hub.label").alias("hub_label"), F.col("hub.n").alias("hub_n")), "grams-hubs")
    met = rows.join(hub, ["gram", "kind"]).filter("label <> hub_label").filter(linked(F.least("n", "hub_n"), F.col("n"), F.col("hub_n")))
    return met.select(*_ordered("row", "hub")).distinct()


def _block_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between rows of one cell in different components: each block of rows outside the largest component meets every block."""
    held = rows.join(sets.select("row", F.length("grams").alias("bytes")), "row")
    held = scratch_table(held, "grams-rest")
    inside = F.col("label") == F.col("main")
    blocks = lambda c: F.greatest(F.ceil(F.greatest(F.count_if(c) / BLOCK_ROWS, F.sum(F.when(c, F.col("bytes")).otherwise(0)) / BLOCK_BYTES)), F.lit(1)).cast("long")
    parts = scratch_table(held.groupBy("gram", "kind").agg(blocks(inside).alias("inner_blocks"), blocks(~inside).alias("outer_blocks")), "grams-blocks")
    place = F.xxhash64("row", "gram")
    own = F.when(inside, F.col("outer_blocks") + F.pmod(place, "inner_blocks")).otherwise(F.pmod(place, "outer_blocks"))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("outer_blocks")).otherwise(F.col("outer_blocks") + F.col("inner_blocks")) - 1))
    cells = held.join(parts, ["gram", "kind"]).select("gram", "kind", "row", "label", own.alias("own"), meets.alias("other"))
    cells = cells.select("gram", "kind", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "row", "label", "own")
    links = cells.join(sets, "row").groupBy("gram", "kind", "low", "high").applyInArrow(_block_links, "a long, b long")
    links = scratch_table(links.distinct(), "grams-block-links")
    release(held, parts)
    return links


def _components(*edges: DataFrame) -> DataFrame:
    whole = edges[0]
    for more in edges[1:]:
        whole = whole.unionAll(more)
    return connected_components(whole)


def similarity_links(reps: DataFrame, sets_of) -> DataFrame:
    """a, b: rows joined to the smallest of their component. `reps` has row, n, prefix; `sets_of` gives row, grams of the rows of a table."""
    postings = reps.select("row", "n", F.explode("prefix").alias("gram"))
    lists = scratch_table(postings.groupBy("gram").agg(F.count("*").alias("m")).filter("m > 1"), "grams-lists")
    posted = scratch_table(postings.join(lists, "gram").select("gram", "m", "row", "n"), "grams-posted")
    release(lists)
    small, large = _cells(posted)
    pairs = _column_pairs(posted).unionAll(_few_pairs(small, "gram", "kind").select("a", "b"))
    pairs = scratch_table(pairs.distinct(), "grams-pairs")
    needed = pairs.select(F.col("a").alias("row")).unionAll(pairs.select(F.col("b").alias("row"))).unionAll(large.select("row")).distinct()
    sets = sets_of(scratch_table(needed, "grams-needed"))
    links = scratch_table(_verified(pairs, sets), "grams-links")
    nodes = _components(links)
    if large.isEmpty():
        return nodes
    pop = scratch_table(large.groupBy("row").agg(F.count("*").alias("pop")), "grams-pop")
    large = scratch_table(large.join(pop, "row"), "grams-popular")
    rows = _labelled(large, nodes)
    for _ in range(HUBS):
        if rows.isEmpty():
            return nodes
        more = scratch_table(_verified(_hub_pairs(rows), sets), "grams-hub-links")
        if more.isEmpty():
            break
        nodes = _components(nodes, more)
        rows = _labelled(rows.select("gram", "kind", "row", "n", "pop"), nodes)
    if rows.isEmpty():
        return nodes
    more = _block_pairs(rows, sets)
    return nodes if more.isEmpty() else _components(nodes, more)


def similarity_components(docs: DataFrame, *, words: int = WORDS, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(text_or_empty().alias("text"))
    bits = min(24, max(6, (docs.count() // CHUNK_DOCUMENTS).bit_length()))
    shared = spark.sparkContext.broadcast(frequent_grams(texts, words, bits, frequent=frequent))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(lean(_prefixes(words, bits, shared)), "doc_id long, n long, digest binary, prefix array<long>")
    rows = scratch_table(rows.withColumn("row", F.monotonically_increasing_id()), "grams-rows")
    shared.destroy()

    first = scratch_table(rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("rep")), "grams-first")
    reps = scratch_table(rows.join(first.select(F.col("rep").alias("row")), "row").select("row", "n", "digest", "prefix"), "grams-reps")

    def sets_of(needed: DataFrame) -> DataFrame:
        few = needed.count() <= BROADCAST_IDS
        wanted = scratch_table(reps.select("row", "digest").join(needed, "row"), "grams-wanted")
        found = texts.mapInArrow(lean(_whole_sets(words)), "digest binary, grams binary").join(F.broadcast(wanted) if few else wanted, "digest").select("row", "grams")
        return scratch_table(found.dropDuplicates(["row"]), "grams-sets")

    nodes = similarity_links(reps.select("row", "n", "prefix"), sets_of)
    members = rows.select("row", "doc_id", "n", "digest").join(first, "digest", "left").join(nodes.toDF("rep", "root"), "rep", "left")
    members = scratch_table(members.select("doc_id", "n", F.coalesce("root", "rep", "row").alias("root")), "grams-members")
    least = scratch_table(members.groupBy("root").agg(F.min("doc_id").alias("component_id")), "grams-least")
    return members.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def oracle_sql(*, words: int = WORDS) -> str:
    """The same as DuckDB SQL over `documents` with different doc_ids."""
    return rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
        g AS (
            SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1), lambda i: array_to_string(w[i : i + {words - 1}], ' '))) AS s
            FROM w WHERE len(w) > 0),
        x AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM g),
        e AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {SHARE + PART} * count(*) >= {SHARE} * (a.n + b.n)),
        both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        reach AS (
            SELECT a AS doc_id, a AS least FROM both_ways
            UNION
            SELECT b, least FROM reach JOIN both_ways ON doc_id = a WHERE least < b),
        c AS (SELECT doc_id, min(least) AS least FROM reach GROUP BY doc_id)
        SELECT w.doc_id, CAST(coalesce(len(g.s), 0) AS BIGINT) AS n_shingles, coalesce(c.least, w.doc_id) AS component_id
        FROM w LEFT JOIN g ON w.doc_id = g.doc_id LEFT JOIN c ON w.doc_id = c.doc_id"""
