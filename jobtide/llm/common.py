"""What the operators share: tables, scratch tables in the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Used only where the session names no shared folder, as in tests.
LOCAL_SCRATCH = "file:///tmp/checkpoints"

#: White space of the word definitions: space and the five ASCII controls from tab to carriage return.
SPACE_BYTES = rb"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session on one machine may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (named or LOCAL_SCRATCH).rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/jobtide/{tag}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SCOPES: ContextVar[tuple[set[str], ...]] = ContextVar("scratch scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """At its end, or on a failure, the scratch tables made within are deleted, but for those that were given to what it yields."""
    made: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        made.discard(df.scratch)
        return df

    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield keep
    finally:
        _SCOPES.reset(token)
        for path in made:
            delete_path(spark, path)


def scratch_table(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends at committed files."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    for made in _SCOPES.get():
        made.add(path)
    writer.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing will read again."""
    for df in tables:
        delete_path(df.sparkSession, df.scratch)


def bounded_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 16) -> None:
    """Keep Arrow batches small enough that long texts do not fill a Python worker, and see that workers have this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


_WORKER: dict[str, object] = {}


def forget() -> None:
    _WORKER.clear()


def trim() -> None:
    """Give memory that Arrow and the C library hold free back to the machine; idle workers then cost the next stage little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` as a task that uses no worker cache: it begins without what earlier stages left and ends without what it held."""

    def whole(batches: Iterator) -> Iterator:
        forget()
        yield from run(batches)
        trim()

    return whole


def worker_cache(name: str, make: Callable[[], object]):
    """What a Python worker keeps between its tasks: one thing at a time, so memory of an earlier stage is given back by the next one."""
    if name not in _WORKER:
        forget()
        trim()
        _WORKER[name] = make()
    return _WORKER[name]


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def record_batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def size_sliced(texts: list, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts together hold about `limit` characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_WORD_RUN = re.compile(SPACE_BYTES)


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z lower-cased; other letters are left alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def space_words(text: str | None) -> list[bytes]:
    return _WORD_RUN.findall(lower_ascii(text))
