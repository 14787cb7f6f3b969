"""The pipeline over documents: five filters and a packer, each written and read again as the next one's input.

Stages, in order: toxicity (rejected documents go), exact dedup, near dedup (one document of each group stays),
benchmark decontamination (spans of benchmark items are cut out, documents that are mostly such spans go), best-fit packing.
All but the last return the columns of documents. Clean documents pass unchanged. Tables that a stage needs besides
its documents (labels, benchmark) are read from sf_dir. Empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from jobtide.llm.common import release, scratch_scope, scratch_table, table

#: Pieces of text that a worker's encoder remembers, twice over: fewer than by default, as its executor has been through other stages.
REMEMBER = 200_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model of the labels scores 0.5 or more.

    The model learns from the labels of all documents: nothing is held out where it is put to use.
    """
    labels = table(spark, sf_dir, "labels")
    weights = toxicity.train(table(spark, sf_dir, "documents"), labels)
    return toxicity.drop_toxic(docs, weights).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then the smallest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group linked by a similarity of 0.8 or more over 5-word shingles."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without spans of ten or more words that a benchmark item holds."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place in it."""
    return packing.pack_documents(docs, end_id=2, remember=REMEMBER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: No SQL expresses a learnt model, suffix automata and bin packing; tests/llm/test_pipeline.py has planted cases, the tests of each operator compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's output is deleted when the next one's is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:
            written = keep(scratch_table(stage(spark, docs, sf_dir), f"stage-{name}"))
        if name != STAGES[0][0]:
            release(docs)
        docs = written
    return STAGES[-1][1](spark, docs, sf_dir)
