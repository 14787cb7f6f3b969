"""Best-fit packing of token pieces into sequences of a fixed length.

Bounded-space best-fit: a task keeps at most `open_bins` bins open, listed by free space; a bitset of
the free spaces that occur gives the tightest bin that a piece fits by one shift and one lowest bit.
When one more bin is needed than may be open, the fullest closes. A task reads its pieces in windows
and takes each window by falling length, so that short pieces come when gaps are there to be filled.

A text longer than a sequence is cut into whole sequences; its first piece takes the rest and so may be
shorter. Empty and null texts are the end id alone. Repeated rows are packed as rows of their own, a
null doc_id is kept, an empty table gives no rows, other columns are ignored. Any row count costs each
task the same memory; tasks share nothing, so each leaves only its last few bins unfilled.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import bounded_batches, lean, record_batch, scratch_table, size_sliced, text_or_empty
from .tokens import PIECES, shared_encoder

SEQUENCE = 1024
OPEN_BINS = 8192
WINDOW = 16_384

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PACKED = _PIECES.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))


def piece_starts(n: int, sequence: int) -> list[int]:
    """Where the pieces of n ids begin: the first is the shorter one."""
    return [0, *range(n % sequence or sequence, n, sequence)]


def _cut(tokenizer: str | None, end_id: int, sequence: int, remember: int):
    def cut(batches):
        encoder, end = shared_encoder(tokenizer, remember), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in size_sliced(texts):
                rows: list[tuple] = []
                for key, ids in zip(keys[a:b], encoder.encode(texts[a:b]), strict=True):
                    raw = ids + end
                    starts = piece_starts(len(raw) // 4, sequence)
                    for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(raw) // 4])):
                        rows.append((key, k, s, e - s, zlib.crc32(memoryview(raw)[4 * s : 4 * e])))
                yield record_batch(_PIECES, dict(zip(_PIECES.names, zip(*rows))))

    return cut


class OpenBins:
    """At most `limit` open bins, found by free space. place(length) gives (bin, offset)."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit, self.next, self.open = capacity, limit, first, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.spaces &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fits = self.spaces >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            space, found = self.capacity, self.next
            self.next += 1
        if left := space - length:
            if self.open >= self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            self.by_space[left].append(found)
            self.spaces |= 1 << left
            self.open += 1
        return found, self.capacity - space


def _pack(sequence: int, open_bins: int, window: int):
    def pack(batches):
        from pyspark import TaskContext

        bins = OpenBins(sequence, open_bins, TaskContext.get().partitionId() << 40)
        held, rows = [], 0

        def placed():
            part = pa.Table.from_batches(held)
            lengths = part.column("length").to_numpy()
            ids, offsets = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
            for i in np.argsort(-lengths, kind="stable").tolist():
                ids[i], offsets[i] = bins.place(int(lengths[i]))
            yield from part.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets)).cast(_PACKED).to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= window:
                yield from placed()
                held, rows = [], 0
        if rows:
            yield from placed()

    return pack


def cut_pieces(docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 2, sequence: int = SEQUENCE, remember: int = PIECES) -> DataFrame:
    """The pieces of all texts: doc_id, piece, start, length, ids_crc32. No shuffle. `remember` bounds the encoder's memory, not the result."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_cut(tokenizer, end_id, sequence, remember), from_arrow_schema(_PIECES))


def pack_documents(
    docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 2, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, window: int = WINDOW, remember: int = PIECES
) -> DataFrame:
    """One row per piece with its sequence_id and offset. The pieces are small rows, written once and packed in place."""
    pieces = scratch_table(cut_pieces(docs, tokenizer=tokenizer, end_id=end_id, sequence=sequence, remember=remember), "pieces")
    return pieces.mapInArrow(lean(_pack(sequence, open_bins, window)), from_arrow_schema(_PACKED))
