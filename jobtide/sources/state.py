"""State of rows through the stages, as a table: registered, pending, completed, failed, skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .io import insert_or_ignore

STATUSES = ("pending", "completed", "failed", "skipped")
SCHEMA = "row_id string, file_path string, stage string, status string, error_message string, updated_at timestamp"


def register(state: DataFrame, rows: DataFrame, file_path: str) -> DataFrame:
    """Rows that the table does not know yet, as pending."""
    new = rows.select("row_id").distinct().select(
        "row_id", F.lit(file_path).alias("file_path"), F.lit("registered").alias("stage"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error_message"), F.current_timestamp().alias("updated_at")
    )
    return insert_or_ignore(state, new, "row_id")


def advance(state: DataFrame, ids: DataFrame, stage: str, status: str = "pending", error: str | None = None) -> DataFrame:
    """The named rows at a stage with a status."""
    moved = state.join(ids.select("row_id").distinct().withColumn("_hit", F.lit(True)), "row_id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    return moved.select(
        "row_id", "file_path", F.when(hit, stage).otherwise(F.col("stage")).alias("stage"), F.when(hit, status).otherwise(F.col("status")).alias("status"),
        F.when(hit, F.lit(error)).otherwise(F.col("error_message")).alias("error_message"), F.when(hit, F.current_timestamp()).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def with_status(state: DataFrame, *status: str) -> DataFrame:
    return state.filter(F.col("status").isin(*status))


def pending(rows: DataFrame, done: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows that have no result yet."""
    return rows.join(done.select(key), key, "left_anti")


def progress(state: DataFrame) -> DataFrame:
    return state.groupBy("stage", "status").agg(F.count("*").alias("n"))


def merge_results(rows: DataFrame, results: DataFrame, key: str = "row_id", order: Sequence = ()) -> DataFrame:
    """Left join to the last result of each key; regex_ columns lose their prefix."""
    if order:
        results = results.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(o) for o in order]))).filter("_n = 1").drop("_n")
    promoted = {c: c.removeprefix("regex_") for c in rows.columns if c.startswith("regex_")}
    clash = [c for c in results.columns if c != key and c in {*rows.columns, *promoted.values()}]
    return rows.withColumnsRenamed(promoted).join(results.drop(*clash), key, "left")
