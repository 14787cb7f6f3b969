"""The queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, html_extract, language, licenses, ngram_join, packing, pii, simhash, token_alignment, token_store, toxicity, vector_codes
from .common import scratch_path, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), end_id=0)
    return token_store.read_tokens(spark, path)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination_digest(report)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), end_id=2)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    scores = toxicity.score_documents(docs, weights)
    return scores.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = docs.filter(~toxicity.held_out())
    model = language.load_model(language.train_counts(known))
    found = language.identify_calibrated(docs, model, ~toxicity.held_out())
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_pii_surrogates(spark: SparkSession, sf_dir: str, key: str = "query key") -> DataFrame:
    """The default key is public and serves comparisons of runs; a real run gives a secret of its own."""
    return pii.replace_personal_data(table(spark, sf_dir, "documents"), key=key)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("code_points")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash_near_dedup, op2_token_store, op3_license_scan, op4_decontaminate, op5_best_fit_packing, op6_toxicity, op7_language_id, op8_pii_surrogates, op9_html_extraction, op10_exact_dedup, op11_vector_codes, op12_token_alignment, op13_ngram_join)
}

ORACLE_SQL: dict[str, str] = {
    "op11_vector_codes": vector_codes.oracle_sql(),
    "op13_ngram_join": ngram_join.oracle_sql(),
    "op3_license_scan": licenses.oracle_sql(),
    "op4_decontaminate": r"""
        WITH it AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM it WHERE len(w) > 0)),
        dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM dw),
        cand AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM pos, (SELECT DISTINCT n FROM win) WHERE i + n - 1 <= len(w)),
        hit AS (SELECT c.doc_id, c.i, c.n, win.item_id FROM cand c JOIN win ON c.n = win.n AND c.s = win.s),
        words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
        SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256, words.n_hit IS NOT NULL AS contaminated
        FROM dw LEFT JOIN words ON dw.doc_id = words.doc_id LEFT JOIN items ON dw.doc_id = items.doc_id""",
    "op10_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        r AS (
            SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
            FROM t)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM r""",
}
