"""Benchmark decontamination by a generalised suffix automaton over words.

The words of all test items make one automaton: a state is a set of word sequences with the same
ends. Document words are streamed through it; the automaton's state and matched length give at each
word the longest sequence that ends there and occurs in some item. Where that length reaches the window
(10 words), the last words are a span shared with an item, and the state's items are its origin.
An item with fewer words than a window is one window of its own length.

The automaton grows with the test items only. They are read in blocks of at most `block_chars` characters
(measured before anything is collected), one automaton per block, and each block is one pass over
the documents that ends in a written table, so that no more than one automaton is in memory; ordinary test sets are one block, whose pass is
not written. Spans and items of all passes travel with the uncut text and are
merged at the end, so results do not depend on the number of blocks. Documents are never shuffled.

Null and empty texts have no words and no hits, items without words give no windows, repeated items
under other ids count as items of their own (an id counts once, as in the SQL), repeated documents are rows of their own, an empty benchmark leaves every
document clean, other columns are passed on untouched by `remove_contamination`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch, release, scratch_table, text_or_empty

WINDOW = 10
#: Characters of items in one automaton, which then takes about 0.2 GB.
BLOCK_CHARS = 2_000_000
#: A document of which more than this share is test items goes as a whole.
COVERAGE = 0.5
#: In UTF-8 every byte from 0x80 belongs to a character outside ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SLICE = 1 << 22


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """Generalised over items; each is added from the root."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[int]] = [set()]
        self.names = [name for name, _ in items]
        ends: list[tuple[int, int]] = []
        for k, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, w)
                self.items[last].add(k)
            if 0 < len(words) < window:
                ends.append((k, len(words)))
        # a state's items also end at its shorter suffixes
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.items[self.link[state]] |= self.items[state]
        self.short: list[list[tuple[int, int]]] = [[] for _ in self.link]
        self._place_short_items(items, ends)

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            to = self.next[last][w]
            if self.length[to] == self.length[last] + 1:
                return to
            return self._clone(last, w, to)
        state = self._new(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            to = self.next[at][w]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._clone(at, w, to)
        return state

    def _new(self, length: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        self.items.append(set())
        return len(self.next) - 1

    def _clone(self, at: int, w: bytes, to: int) -> int:
        copy = self._new(self.length[at] + 1, dict(self.next[to]))
        self.link[copy] = self.link[to]
        self.link[to] = copy
        while at >= 0 and self.next[at].get(w) == to:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def _place_short_items(self, items, ends) -> None:
        own: dict[int, list[tuple[int, int]]] = {}
        for k, size in ends:
            state = 0
            for w in items[k][1]:
                state = self.next[state][w]
            own.setdefault(state, []).append((size, k))
        if own:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                self.short[state] = [*own.get(state, ()), *self.short[self.link[state]]]

    def matches(self, words: Iterator[bytes]) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words; word spans [a, b) of hits, merged; numbers of the items that occur."""
        moves, link, length, short, window = self.next, self.link, self.length, self.short, self.window
        root = moves[0]
        state = held = 0
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        i = -1
        for i, w in enumerate(words):
            to = moves[state].get(w)
            if to is None:
                if state:
                    while state and w not in moves[state]:
                        state = link[state]
                        held = length[state]
                    to = moves[state].get(w)
                if to is None:
                    continue
            state = to
            held += 1
            size = 0
            if held >= window:
                size = held
                top = state
                while length[link[top]] >= window:
                    top = link[top]
                found |= self.items[top]
            if short[state]:
                for n, k in short[state]:
                    if n <= held:
                        found.add(k)
                        size = max(size, n)
            if size:
                a = i + 1 - size
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, i + 1))
        return i + 1, spans, found


def _sliced(text: str | None) -> Iterator[re.Match]:
    """Words of a long text without a list of them all."""
    return _WORD.finditer((text or "").encode("utf-8", "surrogatepass").lower())


def _words(text: str | None) -> Iterator[bytes]:
    return iter(item_words(text)) if len(text or "") < _SLICE else (m[0] for m in _sliced(text))


def automata(benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items. Sizes are summed by Spark first; a block never exceeds the bound by more than its last item."""
    chars = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), text_or_empty(text_col).alias("text"))
    if blocks > 1:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for b in range(blocks):
        part = rows.filter(F.col("block") == b) if blocks > 1 else rows
        yield SuffixAutomaton([(r["item"], item_words(r["text"])) for r in part.toLocalIterator()], window)


def _each_and_last(found: Iterator[SuffixAutomaton]) -> Iterator[tuple[SuffixAutomaton, bool]]:
    now = next(found)
    for later in found:
        yield now, False
        now = later
    yield now, True


_HITS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def merged(spans: list) -> list[tuple[int, int]]:
    """Spans in order; those that overlap or touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and out[-1][1] >= a:
            a, b = out[-1][0], max(b, out.pop()[1])
        out.append((a, b))
    return out


def _hits(shared):
    """Adds a block's spans and items to those of the blocks before it."""

    def run(batches):
        automaton = shared.value
        for batch in batches:
            texts, n_words, all_spans, all_items = batch.column(1).to_pylist(), [], [], []
            for text, spans_before, items_before in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                n, spans, found = automaton.matches(_words(text))
                n_words.append(n)
                all_spans.append([list(s) for s in (merged([*spans_before, *spans]) if spans_before else spans)])
                all_items.append(sorted({*items_before, *(automaton.names[k] or "" for k in found)}))
            yield record_batch(_HITS, {"doc_id": batch.column(0), "text": batch.column(1), "n_words": n_words, "spans": all_spans, "items": all_items})

    return run


def contamination_report(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, spans (word positions [a, b)), items (sorted), one row per document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    nothing = [F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<long>>").alias("spans"), F.array().cast("array<string>").alias("items")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *nothing)
    before = None
    for automaton, last in _each_and_last(automata(benchmark, window=window, block_chars=block_chars)):
        shared = spark.sparkContext.broadcast(automaton)
        rows = rows.mapInArrow(_hits(shared), "doc_id long, text string, n_words long, spans array<array<long>>, items array<string>")
        if not last:
            rows = scratch_table(rows, "contamination")
            shared.destroy()
            if before is not None:
                release(before)
            before = rows
    return rows.drop("text")


def hit_words(spans):
    """Words covered by spans that may overlap, as a Column."""
    end = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), x[1] - F.greatest(s["to"], x[0]))).alias("n"), F.greatest(s["to"], x[1]).alias("to")),
    )
    return end["n"]


def contamination_digest(report: DataFrame) -> DataFrame:
    n_hit = hit_words(F.col("spans"))
    return report.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its words [a, b) of each span and what lies between them."""
    raw, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    wanted = iter(spans)
    span = next(wanted, None)
    for i, m in enumerate(_WORD.finditer(raw.lower())):
        if span is None:
            break
        if i == span[0]:
            out.append(raw[at : m.start()])
        if i == span[1] - 1:
            at = m.end()
            span = next(wanted, None)
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """Documents without the spans of `window` or more words that test items hold; those covered beyond `coverage` go.

    Clean documents pass unchanged. `length_col`, where present, follows a shortened text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = docs.schema
    place = schema.names.index(text_col)
    length_at = schema.names.index(length_col) if length_col in schema.names else None
    def clean(shared, last: bool):
        def run(batches):
            automaton = shared.value
            for batch in batches:
                texts, keep, changed = batch.column(place).to_pylist(), [], False
                before = batch.column(len(schema.names)).to_pylist()
                for i, text in enumerate(texts):
                    n, spans, _ = automaton.matches(_words(text))
                    before[i] = merged([*before[i], *spans]) if before[i] else spans
                    if last:
                        keep.append(sum(b - a for a, b in before[i]) <= coverage * n)
                        if before[i] and keep[-1]:
                            texts[i] = cut_spans(text, before[i])
                            changed = True
                columns = list(batch.columns)
                if not last:
                    columns[-1] = pa.array([[list(s) for s in b] for b in before], batch.schema.field(len(columns) - 1).type)
                    yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                    continue
                if changed:
                    columns[place] = pa.array(texts, batch.schema.field(place).type)
                    if length_at is not None:
                        sizes = [len(t) if t is not None and len(t) != len(w or "") else s for s, t, w in zip(batch.column(length_at).to_pylist(), texts, batch.column(place).to_pylist())]
                        columns[length_at] = pa.array(sizes, batch.schema.field(length_at).type)
                whole = pa.RecordBatch.from_arrays(columns[:-1], names=batch.schema.names[:-1])
                yield whole.filter(pa.array(keep, pa.bool_()))

        return run

    # spans of all blocks are gathered on the uncut text, in a last column that the last pass takes off
    docs = docs.select("*", F.array().cast("array<array<long>>").alias("_spans"))
    with_spans = docs.schema
    before = None
    for automaton, last in _each_and_last(automata(benchmark, window=window, block_chars=block_chars)):
        shared = spark.sparkContext.broadcast(automaton)
        if last:
            return docs.mapInArrow(clean(shared, True), schema)
        docs = scratch_table(docs.mapInArrow(clean(shared, False), with_spans), "contamination")
        shared.destroy()
        if before is not None:
            release(before)
        before = docs
