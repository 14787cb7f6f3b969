"""Where two tokenizers cut the same texts: groups of tokens between common cuts, and how often their ids overlap.

A is a byte-level BPE file of the `tokenizers` library and encodes a space and the text, B is a `sentencepiece` model that
adds this space itself. Both encode without special tokens; their strings in a text are plain text. A task lays the texts of
an Arrow batch one after the other as bytes, with the byte where each document begins, and so the ends of all tokens of the
batch are two sums of token lengths. Counting the ends of A and of B once per byte shows where both end (cuts) and
where either ends. Between two neighbouring ends lies exactly one pair of tokens that overlap (a link). Prefix
sums at the document bounds give what belongs to each document.

A text's tokens are kept as different pairs of ids with their number. They are counted over the corpus by partial sums of
tasks. Pairs that occur often enough for at most `FREQUENT` of them to be so frequent are broadcast as sorted arrays; what
is rarer is joined by a shuffle, so no pair is left out and nothing that grows with the corpus is broadcast.

Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty digest. Rows
that share a doc_id are rows of their own, and a null doc_id is kept. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch, release, scratch_table, size_sliced, text_or_empty, worker_cache
from .tokens import PIECES, Encoder, TwoGenerations, _byte_letters, default_tokenizer

#: Most pairs of ids that are broadcast, 17 bytes each.
FREQUENT = 1 << 21
#: Different pairs that a task sums up before it hands them on.
HELD_PAIRS = 1 << 20
#: Characters of a block of texts.
BLOCK = 1 << 21
#: Pieces that each of the two encoders of a worker remembers, in each of two generations.
REMEMBER = 300_000
_META = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteTable:
    """The bytes of every token id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.fromiter(map(len, tokens), "i4", len(tokens))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype("i4")
        self.bytes = np.frombuffer(b"".join(tokens), "u1")

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        shift = np.repeat(self.starts[ids] - (ends - n).astype("i4"), n)
        return self.bytes[shift + np.arange(len(shift), dtype="i4")]


class PlainBytes(Encoder):
    """Byte-level BPE to which the strings of special tokens are plain text."""

    def __init__(self, path: str | None, pieces: int = PIECES):
        super().__init__(path, pieces)
        self.tokenizer.encode_special_tokens = True
        self.added, self.added_at = {}, None
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        tokens = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.table = ByteTable(tokens)


class Pieces:
    """A sentencepiece model, word by word: no piece goes on behind a space that follows something else, so equal words have equal pieces.

    Models with such pieces get whole texts.
    """

    def __init__(self, path: str | None, pieces: int = PIECES):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path or default_pieces())
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = ByteTable([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_META, " ").encode() for i, p in enumerate(names)])
        self.by_word = not any(_META in p.lstrip(_META) for p in names)
        self.words = TwoGenerations(pieces)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.model.encode(texts, num_threads=1)]

    def encode(self, raw: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """Ids of texts that lie in `raw` from `begins`, each with a space before it; none is empty."""
        space = raw == 0x20
        starts = np.flatnonzero(space & np.concatenate([[True], ~space[:-1]]))
        if not self.by_word:
            starts = begins[:-1]
        first = np.zeros(len(raw), bool)
        first[starts] = True
        last = begins[1:][space[begins[1:] - 1]]  # spaces at a text's end stay with its last word
        first[starts[np.searchsorted(starts, last) - 1]] = False
        first[begins[:-1]] = True
        starts = np.flatnonzero(first)
        offsets = np.append(starts, len(raw)).astype("i4")
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        different = words.dictionary.to_pylist()
        ids = self.words.get_all(different)
        new = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(new, self._ids([different[i][1:] for i in new]), strict=True):
            ids[i] = x
            if len(different[i]) < 100:
                self.words.put(different[i], x)
        of_text = pa.array(np.searchsorted(starts, begins).astype("i4"))
        return pc.binary_join(pa.ListArray.from_arrays(of_text, pa.array(ids, pa.binary()).take(words.indices)), b"").to_pylist()


def _flat(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and per text how many ids come before it (one more at the end)."""
    counts = np.fromiter(map(len, found), "i8", len(found)) // 4
    return np.frombuffer(b"".join(found), "<u4").astype("i8"), np.concatenate([[0], np.cumsum(counts)])


class Digits:
    """Decimal ids, each with the sign behind it, as rows of eight bytes."""

    def __init__(self, size: int):
        self.size = size
        texts = [f"{i}{sign}".encode() for sign in ",|;" for i in range(size)]
        self.lengths = np.fromiter(map(len, texts), "u1", len(texts))
        self.width = max(8, int(self.lengths.max()))
        self.rows = np.frombuffer(b"".join(t.ljust(self.width, b"\0") for t in texts), f"V{self.width}")

    def text(self, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The joined texts of codes (id, plus size or twice size for another sign), and where each ends."""
        lengths = self.lengths[codes]
        used = np.arange(self.width) < lengths[:, None]
        return self.rows[codes].view("u1").reshape(-1, self.width)[used].tobytes(), np.cumsum(lengths, dtype="i8")


def same_bytes(raw: np.ndarray, begins: np.ndarray, found: list[bytes], table: ByteTable) -> np.ndarray:
    """Which texts the tokens give back."""
    ids, of_text = _flat(found)
    ends = np.concatenate([[0], np.cumsum(table.lengths[ids], dtype="i8")])[of_text]
    size = np.diff(begins)
    same = np.diff(ends) == size
    mine, theirs = table.joined(ids), raw
    if not same.all():
        mine, theirs = mine[np.repeat(same, np.diff(ends))], raw[np.repeat(same, size)]
    at = np.flatnonzero(mine != theirs)
    if len(at):
        kept = np.flatnonzero(same)
        same[kept[np.unique(np.searchsorted(np.cumsum(size[kept]), at, "right"))]] = False
    return same


def aligned(begins: np.ndarray, found_a: list[bytes], found_b: list[bytes], table_a: ByteTable, table_b: ByteTable, digits: Digits, shift: int) -> dict[str, list]:
    """Per text of a block: numbers of tokens, groups and links, the digest of the groups, and the different linked pairs (a << shift | b) with counts."""
    ids_a, of_a = _flat(found_a)
    ids_b, of_b = _flat(found_b)
    ends_a, ends_b = np.cumsum(table_a.lengths[ids_a], dtype="i8"), np.cumsum(table_b.lengths[ids_b], dtype="i8")
    size = int(begins[-1]) + 1
    at_a, at_b = np.bincount(ends_a, minlength=size).astype("i4"), np.bincount(ends_b, minlength=size).astype("i4")
    before_a, before_b = np.cumsum(at_a, dtype="i4") - at_a, np.cumsum(at_b, dtype="i4") - at_b
    cut = (at_a > 0) & (at_b > 0)
    cuts = np.cumsum(cut, dtype="i4")
    ends = np.flatnonzero((at_a > 0) | (at_b > 0))
    links = np.searchsorted(ends, begins, "right")

    group_a, group_b = cuts[ends_a] - cut[ends_a], cuts[ends_b] - cut[ends_b]
    n_groups = int(cuts[-1])
    upto_a, upto_b = np.cumsum(np.bincount(group_a, minlength=n_groups)), np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))])
    codes = np.empty(len(ids_a) + len(ids_b), "i8")
    codes[np.arange(len(ids_a)) + upto_b[group_a]] = ids_a + digits.size * cut[ends_a]
    codes[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b + 2 * digits.size * cut[ends_b]
    text, stops = digits.text(codes)
    stops = np.concatenate([[0], stops])[of_a + of_b].tolist()

    document = np.searchsorted(begins[1:], ends, "left")
    keys = (document << 2 * shift) | (ids_a[before_a[ends]] << shift) | ids_b[before_b[ends]]
    keys, counts = np.unique(keys, return_counts=True)
    bounds = np.searchsorted(keys >> 2 * shift, np.arange(len(begins))).tolist()
    keys &= (1 << 2 * shift) - 1
    return {
        "n_a": np.diff(of_a).tolist(), "n_b": np.diff(of_b).tolist(), "n_groups": np.diff(cuts[begins]).tolist(), "n_links": np.diff(links).tolist(),
        "groups_sha256": [hashlib.sha256(text[s : e - 1]).hexdigest() for s, e in zip(stops, stops[1:])],
        "pairs": [pack_pairs(keys[s:e], counts[s:e], shift) for s, e in zip(bounds, bounds[1:])],
    }


def pack_pairs(keys: np.ndarray, counts: np.ndarray, shift: int) -> bytes:
    """Sorted pairs and their counts as byte planes, which the file's codec then makes small."""
    rows = np.stack([keys >> shift, keys & ((1 << shift) - 1), counts]).astype("<u4")
    return rows.view("u1").reshape(3, -1, 4).transpose(0, 2, 1).tobytes()


def unpack_pairs(packed: bytes, shift: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(packed, "u1").reshape(3, 4, -1).transpose(0, 2, 1)
    a, b, n = np.ascontiguousarray(planes).view("<u4")[..., 0].astype("i8")
    return (a << shift) | b, n


_ALIGNED = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("pairs", pa.binary())])
_EMPTY = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": b""}


class Aligner:
    def __init__(self, a: str | None, b: str | None, remember: int):
        self.a, self.b = PlainBytes(a, remember), Pieces(b, remember)
        largest = max(len(self.a.table.lengths), len(self.b.table.lengths))
        self.shift, self.digits = largest.bit_length(), Digits(largest)

    def align(self, texts: list[str]) -> list[dict]:
        """A dict per text."""
        out = [_EMPTY] * len(texts)
        where = [i for i, t in enumerate(texts) if t]
        if not where:
            return out
        spaced = [" " + texts[i] for i in where]
        encoded = [t.encode() for t in spaced]
        begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, encoded), "i8", len(encoded)))])
        raw = np.frombuffer(b"".join(encoded), "u1")
        found_a, found_b = self.a.encode(spaced), self.b.encode(raw, begins)
        same = same_bytes(raw, begins, found_a, self.a.table) & same_bytes(raw, begins, found_b, self.b.table)
        if not same.all():
            kept = np.flatnonzero(same).tolist()
            where, found_a, found_b = [where[i] for i in kept], [found_a[i] for i in kept], [found_b[i] for i in kept]
            begins = np.concatenate([[0], np.cumsum(np.diff(begins)[same])])
        if where:
            rows = aligned(begins, found_a, found_b, self.a.table, self.b.table, self.digits, self.shift)
            for k, i in enumerate(where):
                out[i] = {name: column[k] for name, column in rows.items()}
        return out


def _align(a: str | None, b: str | None, remember: int):
    def run(batches):
        aligner = worker_cache(f"aligner {a} {b} {remember}", lambda: Aligner(a, b, remember))
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s, e in size_sliced(texts, BLOCK):
                rows = aligner.align(texts[s:e])
                yield record_batch(_ALIGNED, {"doc_id": keys[s:e]} | {n: [r[n] for r in rows] for n in _EMPTY})

    return run


_COUNTS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _pair_sums(shift: int):
    def run(batches):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            parts += [unpack_pairs(p, shift) for p in batch.column(0).to_pylist() if p]
            now = sum(len(k) for k, _ in parts)
            if now > 2 * held + HELD_PAIRS:
                parts = [_summed(parts)]
                held = len(parts[0][0])
                if held > HELD_PAIRS:
                    yield record_batch(_COUNTS, {"pair": parts[0][0], "n": parts[0][1]})
                    parts, held = [], 0
        if parts:
            keys, n = _summed(parts)
            yield record_batch(_COUNTS, {"pair": keys, "n": n})

    return run


_KEPT = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<long>, rest_n array<long>"


def _score(shared, shift: int):
    def run(batches):
        keys, counts, best = shared.value
        for batch in batches:
            found: list[tuple] = []
            for packed in batch.column("pairs").to_pylist():
                pairs, n = unpack_pairs(packed, shift)
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                known = keys[at] == pairs
                at, m = at[known], n[known]
                found.append((int(m[best[at]].sum()), int((m * counts[at]).sum()), pairs[~known], n[~known]))
            n_best, count_sum, rest, rest_n = zip(*found) if found else ((),) * 4
            columns = [batch.column(c) for c in _KEPT] + [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rest, pa.list_(pa.int64())), pa.array(rest_n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*_KEPT, "n_best", "count_sum", "rest", "rest_n"])

    return run


def pair_counts(aligned_docs: DataFrame, shift: int) -> DataFrame:
    """pair, n, best: how many links of the corpus hold each pair of ids, and if no other pair of its B id has more."""
    counts = scratch_table(aligned_docs.select("pairs").mapInArrow(_pair_sums(shift), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << shift) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    out = scratch_table(counts.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-pairs")
    release(counts)
    return out


def align_documents(docs: DataFrame, *, a: str | None = None, b: str | None = None, remember: int = REMEMBER, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    bounded_batches(spark, megabytes=8)
    a, b = a or default_tokenizer(), b or default_pieces()
    shift = Aligner(a, b, 1).shift
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_align(a, b, remember), "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary")
    rows = scratch_table(rows.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = pair_counts(rows, shift)

    by_size = sorted(((r.k, r["count"]) for r in counts.groupBy(F.length(F.bin("n")).alias("k")).count().collect()), reverse=True)  # a row per power of two
    least, held = 63, 0
    for k, n in by_size:
        held += n
        if held > frequent:
            break
        least = k - 1
    known = counts.filter(F.col("n") >= F.lit(1 << least)).orderBy("pair").toArrow() if least < 63 else pa.table({"pair": [-1], "n": [0], "best": [False]})
    shared = spark.sparkContext.broadcast((known["pair"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy()))
    scored = rows.mapInArrow(_score(shared, shift), _SCORED)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    if held <= frequent:
        return scored.select(*columns)
    scored = scratch_table(scored, "align-scored")
    rest = scored.filter(F.size("rest") > 0).select("row", F.inline(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_n").alias("m"))))
    sums = rest.toDF("row", "pair", "m").join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"), F.sum(F.col("m") * F.col("n")).alias("more_sum"))
    whole = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return scored.join(sums, "row", "left").withColumns({"n_best": whole("n_best", "more_best"), "count_sum": whole("count_sum", "more_sum")}).select(*columns)
