"""Exact duplicates by counting quotient filters and byte verification.

1. One pass leaves a narrow row per document: 64-bit fingerprint and SHA-256 of the normalised text
   and its length in code points.
2. Each partition counts its fingerprints and stores them, per slab of the fingerprint space, as a
   counting quotient filter: a fingerprint is a quotient (its home slot, kept as an occupied bit and a
   run end) and a remainder, and a repeated one has a counter. Filters of a slab hold the whole
   fingerprint between them, so they merge without loss by their sorted remainders. A hot fingerprint
   costs one entry per partition, however many rows have it.
3. Fingerprints with a merged count above one route their documents to verification: rows are grouped by
   the bytes of the normalised text itself, after counting inside each task.
4. Verified groups name the row that stays.

Null text counts as empty; empty texts are equal to each other. Repeated rows (same doc_id, same
text) belong to one group, and all copies of the row that stays are marked kept. A null doc_id is
allowed and stays only where no other id has as many code points. Very long texts are hashed whole. Columns of other names are
ignored by `exact_duplicates` and kept by `drop_exact_duplicates`, whatever they are called. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import scratch_scope, scratch_table, text_or_empty

#: Deleted before comparing: space and the ASCII controls from tab to carriage return.
SPACE_CHARS = r"[\x20\x09-\x0D]"
#: Fingerprints that a task gathers before it closes its filters.
FILTER_ROWS = 1 << 21


class CountingQuotientFilter:
    """Fingerprints below 2**bits with counts, as sorted remainders in quotient runs."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int):
        """`fingerprints` are different and rise."""
        self.bits, self.size = bits, len(fingerprints)
        self.q = min(bits, max(1, math.ceil(math.log2(max(2, self.size)))))
        self.r = bits - self.q
        quotients = (fingerprints >> np.uint64(self.r)).astype("i8") if self.r < 64 else np.zeros(self.size, "i8")
        self.remainders = fingerprints & np.uint64((1 << self.r) - 1)
        self.occupied = np.zeros(1 << self.q, bool)
        self.occupied[quotients] = True
        self.run_ends = np.ones(self.size, bool)
        if self.size > 1:
            self.run_ends[:-1] = quotients[1:] != quotients[:-1]
        self.counted = counts > 1
        self.counters = counts[self.counted].astype("<u8")

    @classmethod
    def of(cls, values: np.ndarray, bits: int) -> CountingQuotientFilter:
        return cls(*np.unique(values, return_counts=True), bits)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints, rising, and their counts."""
        homes = np.flatnonzero(self.occupied).astype("u8")
        run = np.zeros(self.size, "i8")
        run[1:] = np.cumsum(self.run_ends[:-1])
        counts = np.ones(self.size, "u8")
        counts[self.counted] = self.counters
        high = homes[run] << np.uint64(self.r) if self.size else np.zeros(0, "u8")
        return high | self.remainders, counts

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """All entries in order of quotient and remainder; counters of equal ones are added."""
        parts = [f.entries() for f in filters]
        values, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.ones(len(values), bool)
        first[1:] = values[1:] != values[:-1]
        at = np.flatnonzero(first)
        return cls(values[at], np.add.reduceat(counts, at), filters[0].bits)

    def to_bytes(self) -> bytes:
        width = -(-self.r // 8)
        slots = np.ascontiguousarray(self.remainders.astype("<u8").view("u1").reshape(-1, 8)[:, :width])
        head = np.array([self.bits, self.q, self.size, len(self.counters)], "<u8")
        return b"".join([head.tobytes(), np.packbits(self.occupied).tobytes(), np.packbits(self.run_ends).tobytes(), np.packbits(self.counted).tobytes(), slots.tobytes(), self.counters.tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        self = cls.__new__(cls)
        self.bits, self.q, self.size, n_counters = np.frombuffer(raw, "<u8", 4).tolist()
        self.r, at = self.bits - self.q, 32

        def flags(n: int) -> np.ndarray:
            nonlocal at
            size = -(-n // 8)
            found = np.unpackbits(np.frombuffer(raw, "u1", size, at))[:n].astype(bool)
            at += size
            return found

        self.occupied, self.run_ends, self.counted = flags(1 << self.q), flags(self.size), flags(self.size)
        width = -(-self.r // 8)
        slots = np.zeros((self.size, 8), "u1")
        slots[:, :width] = np.frombuffer(raw, "u1", self.size * width, at).reshape(self.size, width)
        self.remainders = slots.view("<u8").reshape(-1)
        self.counters = np.frombuffer(raw, "<u8", n_counters, at + self.size * width)
        return self


_FILTERS = pa.schema([("slab", pa.int64()), ("filter", pa.binary())])
_REPEATED = pa.schema([("fp", pa.int64()), ("copies", pa.int64())])


def _build(slab_bits: int):
    bits = 64 - slab_bits

    def filters(values: np.ndarray):
        values = np.sort(values.view("u8"))
        slabs = (values >> np.uint64(bits)).astype("i8") if slab_bits else np.zeros(len(values), "i8")
        names, starts = np.unique(slabs, return_index=True)
        low = values & np.uint64((1 << bits) - 1)
        made = [CountingQuotientFilter.of(low[a:b], bits).to_bytes() for a, b in zip(starts, [*starts[1:], len(values)])]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(made, pa.binary())], schema=_FILTERS)

    def build(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype("i8"))
            rows += batch.num_rows
            if rows >= FILTER_ROWS:
                yield filters(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield filters(np.concatenate(held))

    return build


def _merge(slab_bits: int):
    bits = 64 - slab_bits

    def merge(group: pa.Table) -> pa.Table:
        slab = group.column("slab")[0].as_py()
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.from_bytes(x.as_py()) for x in group.column("filter")])
        values, counts = whole.entries()
        many = counts > 1
        high = np.uint64(slab << bits) if slab_bits else np.uint64(0)
        return pa.table({"fp": (values[many] | high).view("i8"), "copies": counts[many].astype("i8")}, schema=_REPEATED)

    return merge


def slab_bits_for(rows: int) -> int:
    """Up to 64 slabs for parallel merging, and beyond that as many as keep one near two million fingerprints."""
    return max(min(6, math.ceil(math.log2(max(1, rows / (1 << 13))))) if rows else 0, math.ceil(math.log2(max(1, rows / (1 << 21)))))


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Of a column of 64-bit fingerprints, those that occur more than once: fp, copies."""
    slab_bits = slab_bits_for(rows)
    ship(fingerprints.sparkSession)
    filters = fingerprints.mapInArrow(_build(slab_bits), "slab long, filter binary")
    return filters.groupBy("slab").applyInArrow(_merge(slab_bits), "fp long, copies long")


#: Groups are broadcast up to this many rows (about 20 MB). Beyond it those of `HOT` rows or more are, of which there is at most one
#: in every `HOT` rows, and the others are joined by a shuffle in which no key has as many rows.
BROADCAST_ROWS = 1 << 18
HOT = 1_000_000


def _join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """`rows` with the columns of `groups`, which has one row per key and the key's number of rows in `size`; no hot key meets in one task."""
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), keys, how)
    hot = F.broadcast(groups.filter(F.col(size) >= HOT))
    others = rows.join(hot.select(*keys), keys, "left_anti").join(groups.filter(F.col(size) < HOT), keys, how)
    return rows.join(hot, keys).unionByName(others)


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, code_points."""
    normal = F.regexp_replace(text_or_empty(text_col), SPACE_CHARS, "")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.length(text_or_empty(text_col)).alias("code_points"), normal.alias("norm"))
    narrow = scratch_table(texts.select("doc_id", "code_points", F.unhex(F.sha2("norm", 256)).alias("sha"), F.xxhash64("norm").alias("fp")), "exact-narrow")
    repeated = scratch_table(repeated_fingerprints(narrow.select("fp"), narrow.count()), "exact-repeated")

    routed = _join_groups(texts.select("norm", F.xxhash64("norm").alias("fp")), repeated, ["fp"], "copies")
    verified = routed.groupBy("fp", "norm").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    groups = scratch_table(verified.select("fp", F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size"), "exact-verified")

    # the most code points, then the smallest id: the complement of an id falls as the id rises
    best = F.max(F.struct("code_points", F.bitwise_not(F.col("doc_id").cast("long")).alias("low")))
    members = _join_groups(narrow, groups, ["fp", "sha"], "group_size")
    keepers = scratch_table(members.groupBy("fp", "sha").agg(best.alias("best"), F.max("group_size").alias("group_size")), "exact-keepers")

    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.bitwise_not(F.col("best.low")))
    kept = alone | (F.col("doc_id").eqNullSafe(keep_id) & (F.col("code_points") == F.col("best.code_points")))
    return _join_groups(narrow, keepers, ["fp", "sha"], "group_size", "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "code_points"
    )


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their columns; of rows repeated with id and text, one."""
    with scratch_scope(docs.sparkSession) as keep:
        verdicts = keep(scratch_table(exact_duplicates(docs, id_col=id_col, text_col=text_col), "exact-verdicts"))
    dropped = verdicts.filter("NOT kept").select("doc_id", "text_sha256", "code_points")
    repeated = scratch_table(verdicts.filter("kept AND group_size > 1").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "text_sha256"), "exact-repeated-rows")
    sha, size = F.sha2(F.regexp_replace(text_or_empty(text_col), SPACE_CHARS, ""), 256), F.length(text_or_empty(text_col))

    def matching(rows: DataFrame, verdict: DataFrame, how: str) -> DataFrame:
        v = verdict.alias("v")
        on = F.col(f"d.{id_col}").eqNullSafe(F.col("v.doc_id")) & (sha == F.col("v.text_sha256"))
        if "code_points" in verdict.columns:
            on &= size == F.col("v.code_points")
        return rows.alias("d").join(F.broadcast(v) if verdict.count() <= BROADCAST_ROWS else v, on, how)

    kept = matching(docs, dropped, "left_anti")
    if not repeated.isEmpty():
        kept = matching(kept, repeated, "left_anti").unionByName(matching(kept, repeated, "left_semi").dropDuplicates([id_col, text_col]))
    return kept
