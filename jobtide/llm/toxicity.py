"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the different hashed unigrams, bigrams and skip-grams (one or two words left out)
of its lower-cased words, in 2**BITS slots. FTRL-proximal (McMahan et al., 2013) gives each coordinate its own
rate from the squares of its gradients, and its L1 term leaves most weights at exactly zero: what is
broadcast for scoring is a list of a few thousand slots and weights, bounded by 2**BITS.

The model is fitted on at most `TRAIN_ROWS` labelled rows (and about `TRAIN_CHARS` characters), those whose doc_id hashes lowest: the rows are
found on labels alone, and only the chosen ids (of that bounded number) are broadcast to the scan that hashes their
texts. Ids, languages and sources are never features.

Null and empty texts have no features and score as the bias says. Repeated label rows of a document with
different labels count as toxic; documents without labels are scored all the same; with no labelled
row, or with one class only, the score is the share of toxic rows with one of each class added.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch, scratch_table, text_or_empty, worker_cache

BITS = 20
#: Bound of the labelled sample that the model is fitted on.
TRAIN_ROWS = 15_000
#: Bound of the characters of that sample, which a single task learns from: beyond it a share of the rows is taken by their hashes.
TRAIN_CHARS = 200_000_000
#: FTRL-proximal: rate, its offset, L1 and L2; passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 3.0, 1.0, 5.0, 0.01, 6
SKIPS = (1, 2, 3)
_WORD = re.compile(r"[^\W_]+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "u8")
_SLICE = 1 << 20


class WordHashes:
    """Hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.known = limit, {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        found = list(map(known.get, words))
        if None in found:
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    found[i] = known[w] = xxhash.xxh64_intdigest(w)
        return np.array(found, "u8")


def features(text: str | None, hashes: WordHashes, bits: int = BITS):
    """Arrays of slots, with repeats, of a whole text; long ones come in parts that overlap."""
    shift = np.uint64(64 - bits)
    text = (text or "").lower()
    tail: list[str] = []
    for at in range(0, len(text), _SLICE):
        # a word on the seam is left whole to the next part
        end = at + _SLICE
        part = text[at:end]
        words = _WORD.findall(part) if len(text) <= _SLICE else _WORD.findall(_whole_words(text, at, end))
        h = hashes.of(tail + words)
        new = len(tail)
        yield (h[new:] * _MULTIPLIERS[0]) >> shift
        for k in SKIPS:
            if len(h) > k:
                left, right = h[max(0, new - k) : -k], h[max(0, new - k) + k :]
                yield ((left * _MULTIPLIERS[1] + np.uint64(k)) ^ (right * _MULTIPLIERS[2])) * _MULTIPLIERS[0] >> shift
        tail = (tail + words)[-max(SKIPS) :]


def _whole_words(text: str, at: int, end: int) -> str:
    """The part of the text whose words begin in [at, end)."""
    if at and _WORD.match(text[at - 1]) and (m := _WORD.match(text, at)):
        at = m.end()
    if end < len(text) and _WORD.match(text[end - 1]) and (m := _WORD.match(text, end)):
        end = m.end()
    return text[at:end]


def feature_set(text: str | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    parts = [np.unique(p) for p in features(text, hashes, bits)]
    return np.unique(np.concatenate(parts)).astype("u4") if parts else np.zeros(0, "u4")


class FtrlProximal:
    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last slot is the bias
        self.bias = 1 << bits

    def _weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.bias, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, slots: np.ndarray, label: int) -> None:
        at = np.append(slots, self.bias).astype("i8")
        w = self._weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] += g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero((np.abs(self.z) > self.l1) | (np.arange(len(self.z)) == self.bias))
        return at, self._weights(at)


def fit(rows: list[tuple[int, np.ndarray]], bits: int = BITS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights from (label, feature set) rows in the given order."""
    positive = sum(y for y, _ in rows)
    if not 0 < positive < len(rows):
        return np.array([1 << bits]), np.array([np.log((positive + 1) / (len(rows) - positive + 1))])
    model = FtrlProximal(bits)
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(rows)).tolist():
            model.learn(rows[i][1], rows[i][0])
    return model.sparse()


_FEATURES = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("slots", pa.binary())])
_WEIGHTS = pa.schema([("slot", pa.int64()), ("weight", pa.float64())])


def _featurize(bits: int):
    def run(batches):
        hashes = worker_cache("toxicity word hashes", WordHashes)
        for batch in batches:
            slots = [feature_set(t, hashes, bits).tobytes() for t in batch.column(2).to_pylist()]
            yield record_batch(_FEATURES, {"doc_id": batch.column(0), "toxic": batch.column(1), "slots": slots})

    return run


def _fit_group(bits: int, passes: int):
    def run(group: pa.Table) -> pa.Table:
        # slots are read in place
        slots = [np.frombuffer(x.as_buffer(), "u4") for x in group.column("slots")]
        ids, labels = group.column("doc_id").to_pylist(), group.column("toxic").to_pylist()
        # equal ids (repeated documents) are told apart by their features
        order = sorted(range(len(ids)), key=lambda i: (ids[i], labels[i], xxhash.xxh64_intdigest(slots[i].data)))
        slots, weights = fit([(labels[i], slots[i]) for i in order], bits, passes)
        return pa.table({"slot": slots, "weight": weights}, schema=_WEIGHTS)

    return run


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS, bits: int = BITS, passes: int = PASSES) -> DataFrame:
    """slot, weight of the fitted model. `labels` holds the rows that may be learnt from."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    total = known.count()
    # the lowest hashes: a threshold on all rows that leaves about as many as the bound, then the bound itself
    if total > train_rows:
        known = known.filter(F.xxhash64("doc_id").cast("double") < -(2.0**63) + 2.0**64 * min(1.0, 1.2 * train_rows / total))
    chosen = scratch_table(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    chars = sample.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars > train_chars:
        sample = sample.filter(F.xxhash64("doc_id", F.lit(1)).cast("double") < -(2.0**63) + 2.0**64 * train_chars / chars)
    rows = sample.mapInArrow(_featurize(bits), "doc_id long, toxic int, slots binary")
    return rows.groupBy(F.lit(0).alias("all")).applyInArrow(_fit_group(bits, passes), "slot long, weight double")


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


class Scorer:
    def __init__(self, slots: np.ndarray, weights: np.ndarray, bits: int):
        self.bits, self.hashes = bits, worker_cache("toxicity word hashes", WordHashes)
        self.weights = np.zeros(1 << bits, "f8")
        self.weights[slots[slots < 1 << bits]] = weights[slots < 1 << bits]
        self.bias = float(weights[slots == 1 << bits].sum())

    def score(self, text: str | None) -> float:
        parts = []
        for slots in features(text, self.hashes, self.bits):
            hit = slots[self.weights[slots] != 0]
            if len(hit):
                parts.append(np.unique(hit))
        total = self.bias + (self.weights[np.unique(np.concatenate(parts))].sum() if parts else 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def _collect(weights: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sparse weights, of which there are at most 2**bits + 1."""
    rows = weights.toArrow()
    return rows.column("slot").to_numpy(), rows.column("weight").to_numpy()


def score_documents(docs: DataFrame, weights: DataFrame, *, bits: int = BITS) -> DataFrame:
    """doc_id, score of every whole text. No shuffle."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(_collect(weights))

    def run(batches):
        scorer = Scorer(*shared.value, bits)
        for batch in batches:
            yield record_batch(_SCORES, {"doc_id": batch.column(0), "score": [scorer.score(t) for t in batch.column(1).to_pylist()]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, weights: DataFrame, *, threshold: float = 0.5, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The documents that score below `threshold`, unchanged."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(_collect(weights))
    place = docs.schema.names.index(text_col)

    def run(batches):
        scorer = Scorer(*shared.value, bits)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """True for rows never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
