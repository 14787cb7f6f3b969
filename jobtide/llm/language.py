"""Language identification by interpolated Kneser-Ney character models.

A model is trained on the words (runs of letters, lower-cased) of each language's documents: all of them, none
sampled. Tasks count words, break them into character 4-grams (a word is padded by three starts and one
end, so no context crosses words) and Spark adds up counts per language. Lower orders use continuation
counts (the number of different left neighbours), the top order uses counts, each is discounted by
n1 / (n1 + 2 n2) and interpolated with the next lower one, down to a uniform distribution.

The tables are sorted arrays of 64-bit n-gram and context hashes with one column per language, found by binary
search. Every 4-gram of the training words is kept. Where all languages together have more than `SHARD_CELLS` cells, they are
dealt over several models, each broadcast and read over the documents on its own (a language is never split), so
results do not depend on the number of models. A document's cross-entropy in a language is the mean negative
log-probability of its characters; the lowest wins, and the score is the winner's share of the languages'
probabilities at an effective length of `EFFECTIVE` characters. Calibrated rejection: a text is `rejected` if its
cross-entropy is beyond the winner's mean over all of its labelled documents by more than `SPREAD` standard
deviations; `reject=True` also gives it `und`.

Null texts, empty texts and texts without a letter are `und` with score 0 and rejected. With no training row everything
is. Equal cross-entropies go to the smallest language value. Very long texts are read in parts.
Repeated rows are rows of their own, columns of other names are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch, scratch_table, text_or_empty, worker_cache

ORDER = 4
START, END = "\x02", "\x03"
#: Cells of a model (its 4-grams times its languages), beyond which the next language starts another model.
SHARD_CELLS = 2_400_000
#: Different words that a task counts before it hands on their 4-grams.
WORDS_HELD = 200_000
EFFECTIVE = 12
SPREAD = 6.0
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None):
    """Lower-cased runs of letters, in parts for long texts."""
    text = (text or "").lower()
    if len(text) < 1 << 22:
        return [_LETTERS.findall(text)]
    found, parts = _LETTERS.finditer(text), []

    def read():
        for m in found:
            parts.append(m[0])
            if len(parts) >= 1 << 18:
                yield list(parts)
                parts.clear()
        yield parts

    return read()


def gram_counts(words: Counter) -> Counter:
    grams: Counter = Counter()
    for word, n in words.items():
        padded = START * (ORDER - 1) + word + END
        for i in range(len(padded) - ORDER + 1):
            grams[padded[i : i + ORDER]] += n
    return grams


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])


def _count(batches):
    held: dict[str, Counter] = defaultdict(Counter)
    size = 0

    def emit():
        for lang, words in held.items():
            grams = gram_counts(words)
            yield record_batch(_COUNTS, {"lang": [lang] * len(grams), "gram": list(grams), "n": list(grams.values())})

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for words in words_of(text):
                held[lang].update(words)
        size = sum(map(len, held.values()))
        if size >= WORDS_HELD:
            yield from emit()
            held.clear()
    yield from emit()


def train_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: all character 4-gram counts of every document with a language."""
    bounded_batches(docs.sparkSession)
    rows = docs.filter("lang IS NOT NULL").select("lang", text_or_empty().alias("text"))
    return scratch_table(rows.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-counts")


def _hash_chars(codes: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(codes[0]), "u8")
    for c in codes:
        h = (h ^ c) * _MIX
        h ^= h >> np.uint64(31)
    return h


class KneserNey:
    """Tables of all languages: per order sorted gram hashes with discounted shares, sorted context hashes with back-off weights."""

    def __init__(self, grams: dict[str, dict[str, int]], alphabet: int | None = None):
        """`alphabet` is the number of characters of all languages, where `grams` has some of them."""
        self.languages = sorted(grams)
        self.orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.limits: dict[str, float] = {}
        shares = [defaultdict(lambda: np.zeros(len(self.languages))) for _ in range(ORDER)]
        weights = [defaultdict(lambda: np.ones(len(self.languages))) for _ in range(ORDER)]
        chars = len({g[-1] for counts in grams.values() for g in counts}) if alphabet is None else alphabet
        self.uniform = 1.0 / (chars + 1)
        for at, lang in enumerate(self.languages):
            counts = dict(grams[lang])
            for k in range(ORDER, 0, -1):
                n1, n2 = (sum(1 for n in counts.values() if n == x) for x in (1, 2))
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                totals, kinds = Counter(), Counter()
                for g, n in counts.items():
                    totals[g[:-1]] += n
                    kinds[g[:-1]] += 1
                for g, n in counts.items():
                    shares[k - 1][g][at] = max(n - discount, 0) / totals[g[:-1]]
                for c, n in totals.items():
                    weights[k - 1][c][at] = discount * kinds[c] / n
                lower: Counter = Counter()
                for g in counts:
                    lower[g[1:]] += 1
                counts = lower
        for k in range(ORDER):
            self.orders.append((*self._table(shares[k], k + 1), *self._table(weights[k], k)))

    def _table(self, rows: dict[str, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
        if not rows:
            return np.zeros(0, "u8"), np.zeros((0, len(self.languages)), "f4")
        names = list(rows)
        codes = [np.array([ord(n[i]) for n in names], "u8") for i in range(size)] or [np.zeros(len(names), "u8")]
        h = _hash_chars(codes)
        order = np.argsort(h)
        return h[order], np.array([rows[n] for n in names], "f4")[order]

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, h: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full((len(h), values.shape[1]), missing, "f4")
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where((keys[at] == h)[:, None], values[at], np.float32(missing))

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Negative log-probability of each word with its end, per language."""
        padded = "".join(START * (ORDER - 1) + w + END for w in words)
        codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
        sizes = np.fromiter(map(len, words), "i8", len(words)) + 1
        begins = np.cumsum(np.concatenate([[0], sizes[:-1] + ORDER - 1])) + ORDER - 1
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[owner]
        p = np.full((len(place), len(self.languages)), self.uniform)
        for k, (keys, shares, contexts, weights) in enumerate(self.orders):
            columns = [codes[place - j] for j in range(k, -1, -1)]
            context = _hash_chars(columns[:-1] or [np.zeros(len(place), "u8")])
            p = self._find(keys, shares, _hash_chars(columns), 0.0) + self._find(contexts, weights, context, 1.0) * p
        return np.add.reduceat(-np.log(p), np.cumsum(sizes) - sizes, axis=0)


class Sharded:
    """Models of disjoint languages, in order of language, with one alphabet."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.languages = [lang for m in models for lang in m.languages]
        self.limits: dict[str, float] = {}

    def word_costs(self, words: list[str]) -> np.ndarray:
        return np.concatenate([m.word_costs(words) for m in self.models], axis=1)


def verdict(entropy: np.ndarray | None, languages: list[str], limits: dict[str, float], reject: bool) -> tuple[str, float, bool]:
    """Language, score, rejected."""
    if entropy is None:
        return UNDETERMINED, 0.0, True
    best = int(entropy.argmin())
    share = float(1 / np.exp((entropy[best] - entropy) * EFFECTIVE).sum())
    lang = languages[best]
    rejected = bool(entropy[best] > limits.get(lang, np.inf))
    return UNDETERMINED if reject and rejected else lang, share, rejected


class Identifier:
    """Scores documents with word costs remembered up to a bound."""

    def __init__(self, model: KneserNey, limit: int = 600_000, cells: int = 20_000_000):
        self.model, self.limit = model, min(limit, max(1000, cells // max(1, len(model.languages))))
        limit = self.limit
        self.rows: dict[str, int] = {}
        self.costs = np.zeros((limit, max(1, len(model.languages))), "f4")

    def _rows_of(self, words: list[str]) -> np.ndarray | None:
        rows = self.rows
        found = list(map(rows.get, words))
        if None in found:
            new = list({w for w, r in zip(words, found) if r is None})
            if len(rows) + len(new) > self.limit:
                rows.clear()
                new = list(set(words))
                if len(new) > self.limit:
                    return None
            at = len(rows)
            self.costs[at : at + len(new)] = self.model.word_costs(new)
            rows.update(zip(new, range(at, at + len(new))))
            found = list(map(rows.__getitem__, words))
        return np.array(found, "i8")

    def entropies(self, text: str | None) -> np.ndarray | None:
        """Cross-entropy per character in each language; None without a letter or without a model."""
        if not self.model.languages or not any(map(str.isalpha, text or "")):
            return None
        total, chars = np.zeros(len(self.model.languages)), 0
        for words in words_of(text):
            for a in range(0, len(words), 1 << 16):
                part = words[a : a + (1 << 16)]
                at = self._rows_of(part)
                total += self.costs[at].sum(axis=0, dtype="f8") if at is not None else self.model.word_costs(part).sum(axis=0)
                chars += sum(map(len, part)) + len(part)
        return total / chars if chars and len(total) else None

    def identify(self, text: str | None, reject: bool = False) -> tuple[str, float, bool]:
        return verdict(self.entropies(text), self.model.languages, self.model.limits, reject)


def _identifier(shared) -> Identifier:
    """One for the tasks of a worker that read the same model."""
    model = shared.value
    return worker_cache(f"identifier {id(model)}", lambda: Identifier(model))


def load_model(counts: DataFrame, *, shard_cells: int = SHARD_CELLS) -> KneserNey | Sharded:
    """The model of all counts; several where they are more than `shard_cells`."""
    sizes = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.count("*").alias("n")).collect())
    shards: list[list[str]] = [[]]
    held = 0
    for lang, n in sizes:
        if shards[-1] and (held + n) * (len(shards[-1]) + 1) > shard_cells:
            shards.append([])
            held = 0
        shards[-1].append(lang)
        held += n
    alphabet = counts.select(F.substring("gram", -1, 1).alias("c")).distinct().count()
    models = []
    for shard in shards:
        grams: dict[str, dict[str, int]] = defaultdict(dict)
        rows = (counts if len(shards) == 1 else counts.filter(F.col("lang").isin(shard))).toArrow()
        for lang, gram, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "gram", "n"))):
            grams[lang][gram] = n
        models.append(KneserNey(grams, alphabet))
    return models[0] if len(models) == 1 else Sharded(models)


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
_DDL = "doc_id long, lang_pred string, score double, rejected boolean"
_SCORED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("lang", pa.string()), ("own", pa.float64())])
_SCORED_DDL = "doc_id long, lang_pred string, score double, entropy double, lang string, own double"


def _add_entropies(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string()), ("entropies", pa.list_(pa.float64()))])

    def run(batches):
        identifier = _identifier(shared)
        for batch in batches:
            out = []
            for text, before in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                e = identifier.entropies(text)
                out.append(before if e is None else before + e.tolist())
            yield record_batch(schema, {"doc_id": batch.column(0), "lang": batch.column(1), "text": batch.column(2), "entropies": out})

    return run


def _scored_batch(ids, langs, entropies: list[np.ndarray | None], languages: list[str], places: dict[str, int]) -> pa.RecordBatch:
    verdicts = [verdict(e, languages, {}, False) for e in entropies]
    known = langs.to_pylist()
    return record_batch(_SCORED, {
        "doc_id": ids, "lang_pred": [v[0] for v in verdicts], "score": [v[1] for v in verdicts], "entropy": [None if e is None else float(e.min()) for e in entropies], "lang": known,
        "own": [None if e is None or lang not in places else float(e[places[lang]]) for e, lang in zip(entropies, known, strict=True)],
    })


def score_languages(docs: DataFrame, model: KneserNey | Sharded, lang=None) -> DataFrame:
    """doc_id, lang_pred, score, entropy (the winner's), lang, own (the entropy in `lang`, where that is learnt) of every whole text. No shuffle.

    `lang` is the value that a row calibrates; it has no part in its prediction. Several models: one pass over the documents per
    model, entropies travel with the texts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    languages, places = model.languages, {lang: k for k, lang in enumerate(model.languages)}
    known = F.lit(None).cast("string") if lang is None else lang
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), known.cast("string").alias("lang"), "text")
    if isinstance(model, Sharded):
        rows = rows.withColumn("entropies", F.array().cast("array<double>"))
        for m in model.models:
            rows = rows.mapInArrow(_add_entropies(spark.sparkContext.broadcast(m)), "doc_id long, lang string, text string, entropies array<double>")

        def finish(batches):
            for batch in batches:
                found = [np.array(e) if e else None for e in batch.column(2).to_pylist()]
                yield _scored_batch(batch.column(0), batch.column(1), found, languages, places)

        return rows.select("doc_id", "lang", "entropies").mapInArrow(finish, _SCORED_DDL)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        identifier = _identifier(shared)
        for batch in batches:
            yield _scored_batch(batch.column(0), batch.column(1), [identifier.entropies(t) for t in batch.column(2).to_pylist()], languages, places)

    return rows.mapInArrow(run, _SCORED_DDL)


def rejection_bounds(scored: DataFrame) -> DataFrame:
    """lang, bound: a row per language, from all scored documents that have it."""
    spread = F.coalesce(F.stddev_pop("own"), F.lit(0.0))
    return scored.filter("own IS NOT NULL").groupBy("lang").agg((F.avg("own") + SPREAD * spread).alias("bound"))


def calibrate(model: KneserNey | Sharded, docs: DataFrame) -> None:
    """Set each language's rejection bound from all of its documents."""
    known = docs.filter("lang IS NOT NULL")
    for r in rejection_bounds(score_languages(known, model, F.col("lang"))).toLocalIterator():
        model.limits[r["lang"]] = r["bound"]


def identify_calibrated(docs: DataFrame, model: KneserNey | Sharded, learnt) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every whole text, with bounds from all rows where the Column `learnt` holds and that have a language.

    Texts are scored once: their entropies, a few numbers a row, are written, and both the bounds and the verdicts come from them.
    """
    scored = scratch_table(score_languages(docs, model, F.when(learnt, F.col("lang"))), "lang-scores")
    bounds = rejection_bounds(scored).select(F.col("lang").alias("lang_pred"), "bound")
    # a row per language
    found = scored.drop("lang").join(F.broadcast(bounds), "lang_pred", "left")
    return found.select("doc_id", "lang_pred", "score", F.coalesce(F.col("entropy").isNull() | (F.col("entropy") > F.col("bound")), F.lit(False)).alias("rejected"))


def identify_documents(docs: DataFrame, model: KneserNey | Sharded, *, reject: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every whole text, by the model's own bounds. No shuffle."""
    limits = dict(model.limits)

    def run(batches):
        for batch in batches:
            langs, entropies = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            rejected = [e is None or e > limits.get(lang, np.inf) for lang, e in zip(langs, entropies, strict=True)]
            named = [UNDETERMINED if reject and r else lang for lang, r in zip(langs, rejected, strict=True)]
            yield record_batch(_OUT, {"doc_id": batch.column(0), "lang_pred": named, "score": batch.column(2), "rejected": rejected})

    return score_languages(docs, model).select("doc_id", "lang_pred", "score", "entropy").mapInArrow(run, _DDL)
