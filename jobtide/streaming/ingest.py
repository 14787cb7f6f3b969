"""Beyond batch: postings as a stream. Stateless stages, keyed de-duplication within a watermark, weekly counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.io import upsert
from ..sources.state_log import StateLog


def read_drops(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).load(folder)


def dedup_stream(df: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def weekly_counts(df: DataFrame, time: str, *keys: str, delay: str = "1 day") -> DataFrame:
    """Rows per week from Monday and key, as weeks close."""
    week = F.window(time, "7 days", startTime="4 days")
    return df.withWatermark(time, delay).groupBy(week.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("week"), *keys, "n")


def upsert_batches(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges each batch into a versioned table: new rows win.

    A batch reads the latest finished version before its own number, so batches may be skipped, and one that is run again writes
    its version anew. Versions before the one read are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        made = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
        done = {int(p.getName()[1:]): p for p in made if p.getName()[:1] == "v" and files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}
        before = max((v for v in done if v < number), default=None)
        fresh = batch.dropDuplicates([key])
        merged = fresh if before is None else upsert(spark.read.parquet(done[before].toString()), fresh, key)
        merged.write.mode("overwrite").parquet(f"{path}/v{number:09d}")
        for v in done:
            if before is not None and v < before:
                files.delete(done[v], True)

    return merge


def merge_batches(log: StateLog, *, order: Sequence = (), writer: str = "stream", compact_every: int = 20) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that commits each batch as a delta of a state log, once, and compacts now and then."""

    def merge(batch: DataFrame, number: int) -> None:
        log.upsert(batch, order=order, writer=writer, batch=number)
        if number % compact_every == compact_every - 1:
            log.compact()

    return merge
