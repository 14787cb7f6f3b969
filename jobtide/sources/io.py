"""Readers and writers: source CSVs with a column mapping, the NA boundary, JSON, state tables, fingerprints."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.numbers import UNKNOWN_DATE, posted_date
from ..functions.text import null_if_sentinel, row_id, strip
from ..scratch import scratch_path
from ..shipping import ship
from .csv_split import read_csv_split

INGEST_COLUMNS = ("title", "site", "job_url", "company_name", "location", "date_posted", "description")
INGEST_SCHEMA = StructType([StructField(c, StringType()) for c in INGEST_COLUMNS])


@dataclass(frozen=True)
class Source:
    """A raw file: its site label and, per ingest column, the name that the file gives it."""

    name: str
    path: str
    site: str
    columns: Mapping[str, str] = field(default_factory=dict)


def read_csv(spark: SparkSession, path: str, *, encoding: str = "UTF-8", schema: StructType | None = None) -> DataFrame:
    """Every cell as text, a file per task. Quoted cells may hold line breaks and doubled quotes; `read_csv_split` reads such files by ranges."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", encoding).option("nullValue", "\0")
    return (reader.schema(schema) if schema else reader).csv(path)


def guess_encoding(spark: SparkSession, path: str, fallback: str = "ISO-8859-1") -> str:
    """UTF-8 unless a line is not valid UTF-8; all lines are looked at, by all tasks."""
    broken = spark.read.option("lineSep", "\n").text(path).filter(~F.is_valid_utf8("value"))
    return fallback if broken.limit(1).count() else "UTF-8"


def read_csv_safe(spark: SparkSession, path: str) -> DataFrame:
    """CSV with sentinels as NULL, read by byte ranges."""
    raw = read_csv_split(spark, path, encoding=guess_encoding(spark, path))
    return raw.select(*[null_if_sentinel(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, as CSV cells must be."""
    nested = {f.name: F.to_json(f.name) for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")}
    return df.withColumns(nested) if nested else df


def write_csv_safe(df: DataFrame, path: str, *, single: bool = False) -> None:
    """CSV with NULL as NA. `single` is for small tables only."""
    (flat(df).coalesce(1) if single else flat(df)).write.mode("overwrite").option("header", True).option("nullValue", "NA").option("emptyValue", "").option("quote", '"').option("escape", '"').csv(path)


def load_source(spark: SparkSession, source: Source, *, limit: int | None = None) -> DataFrame:
    """A source's rows under the ingest columns, stripped, with row order in _ord."""
    raw = read_csv_split(spark, source.path, encoding=guess_encoding(spark, source.path), order="_ord")
    missing = [s for s in source.columns.values() if s not in raw.columns]
    if missing:
        raise ValueError(f"{source.name} lacks {', '.join(missing)}")
    cells = {t: F.col(f"`{s}`") for t, s in source.columns.items()} | {"site": F.lit(source.site)}
    picked = raw.select(*[strip(cells.get(c, F.lit(None).cast("string"))).alias(c) for c in INGEST_COLUMNS], "_ord", F.lit(source.name).alias("source_file"))
    no_text = picked.withColumns({c: F.when(~F.col(c).isin("nan", "None"), F.col(c)) for c in INGEST_COLUMNS})
    return no_text.orderBy("_ord").limit(limit) if limit is not None else no_text


def ingest(spark: SparkSession, sources: Sequence[Source], scrape_date: str, *, limit: int | None = None) -> DataFrame:
    """All sources in one table with exact dates (unknown ones get a fixed future date) and row_id. Order: source, then row."""
    parts = [load_source(spark, s).withColumn("_src", F.lit(k)) for k, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, parts)
    date = F.coalesce(posted_date(F.col("date_posted"), F.lit(scrape_date).cast("date")), F.lit(UNKNOWN_DATE))
    rows = rows.withColumn("date_posted", date).withColumn("row_id", row_id(F.col("job_url"))).withColumn("_ord", F.struct("_src", "_ord")).drop("_src")
    return rows.orderBy("_ord").limit(limit) if limit is not None else rows


def contract(df: DataFrame, rules: Mapping[str, Column], *, unique: Sequence[str] = ()) -> DataFrame:
    """Raise unless every rule (a condition that NULL passes) holds on every row and the named columns are unique; one pass."""
    found = df.agg(*[F.count_if(~F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()], *[(F.count(c) - F.countDistinct(c)).alias(f"unique:{c}") for c in unique]).first().asDict()
    broken = {k: v for k, v in found.items() if v}
    if broken:
        raise ValueError(f"contract broken: {broken}")
    return df


def ingest_contract(df: DataFrame) -> DataFrame:
    return contract(df, {"title": F.col("title").isNotNull(), "url": F.col("job_url").startswith("http"), "date": F.col("date_posted").rlike(r"^\d{4}-\d{2}-\d{2}$")})


def write_json_records(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """One JSON object per line, NULLs included."""
    (df.select(*columns) if columns else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_report(tables: Mapping[str, DataFrame], path: str, max_rows: int = 100_000) -> None:
    """Small results as one JSON file on the driver, numbers rounded to two decimals. A table of more than max_rows is refused."""

    def cell(v):
        return None if isinstance(v, float) and v != v else round(v, 2) if isinstance(v, float) else v if isinstance(v, (int, str, bool, type(None), list)) else str(v)

    found = {k: t.limit(max_rows + 1).collect() for k, t in tables.items()}
    if large := [k for k, rows in found.items() if len(rows) > max_rows]:
        raise ValueError(f"more than {max_rows} rows in {', '.join(large)}")
    with open(path, "w", encoding="utf-8") as out:
        json.dump({k: [{c: cell(v) for c, v in r.asDict().items()} for r in rows] for k, rows in found.items()}, out, ensure_ascii=False, indent=1)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All new rows, and old rows whose key is not among them."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of each file below `path`, one task a file, which reads it as a stream of lines.

    A file is never split and never in one row, so memory is that of its longest stretch without a line feed. The read runs in a session of its own, whose
    limit of bytes per task is off; the digests are written to the shared folder.
    """
    ship(spark)
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str((1 << 63) - 1))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 62))
    # a line in a batch is held once; long lines make small batches
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    lines = own.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select("_metadata.file_path", "_metadata.file_size", F.col("value").cast("binary").alias("value"))
    target = scratch_path(spark)
    lines.mapInArrow(_digest_lines, "path string, bytes long, sha256 string").write.parquet(target)
    found = spark.read.parquet(target)
    # files without a byte have no line; Spark's readers leave them out
    empty = [(p, 0, hashlib.sha256().hexdigest()) for p in _empty_files(spark, path)]
    return found.unionByName(spark.createDataFrame(empty, found.schema)) if empty else found


def _empty_files(spark: SparkSession, path: str) -> list[str]:
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in files.globStatus(top) or []:
        listed = files.listFiles(status.getPath(), True)
        while listed.hasNext():
            f = listed.next()
            if f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")):
                out.append(f.getPath().toString())
    return out


def _digest_lines(batches):
    """Lines come in order, file by file. The last one ends with a line feed if the bytes read are one short of the size."""
    import pyarrow as pa

    now, digest, size, read = None, None, 0, 0
    done: list[tuple] = []

    def finish() -> None:
        if now is not None:
            if read == size + 1:
                done.append((now, size, last.hexdigest()))
            else:
                done.append((now, size, digest.hexdigest()))

    last = None
    for batch in batches:
        for path, length, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if path != now:
                finish()
                now, digest, size, read = path, hashlib.sha256(), length, 0
            raw = line.as_buffer()
            digest.update(raw)
            read += raw.size + 1
            if read > size:  # the file's last line has no line feed
                last = digest.copy()
            else:
                digest.update(b"\n")
    finish()
    paths, sizes, found = zip(*done) if done else ((),) * 3
    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(found, pa.string())], names=["path", "bytes", "sha256"])


def fingerprint_files(spark: SparkSession, path: str) -> DataFrame:
    """path, fingerprint: first 16 hex digits of each file's SHA-256."""
    return file_digests(spark, path).select("path", F.substring("sha256", 1, 16).alias("fingerprint"))


def fingerprint_config(config: Mapping) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


def export_by_source(df: DataFrame, path: str, *, source: str = "source_file", categoricals: Sequence[str] = ("contract_type", "work_modality", "seniority")) -> dict[str, str]:
    """CSV per source (folders source=<name>) and all rows together; blank categories are NULL, lists are JSON. Returns the two folders."""
    clean = df.withColumns({c: F.when(strip(F.col(c)) != "", F.col(c)) for c in categoricals if c in df.columns})
    found = {"by_source": f"{path}/by_source", "combined": f"{path}/combined"}
    write_csv_safe(clean, found["combined"])
    flat(clean).write.mode("overwrite").partitionBy(source).option("header", True).option("nullValue", "NA").option("emptyValue", "").option("quote", '"').option("escape", '"').csv(found["by_source"])
    return found


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Replace the table at `path` by a finished one: written beside it, then put in its place by renames.

    A run that fails while it writes leaves the old table. One that dies between the two renames leaves it under a name that the next call, and
    `restore`, put back.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    restore(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    target, old, new = make(path), make(f"{path}._old"), f"{path}._new-{uuid.uuid4().hex}"
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        (write or (lambda d, p: d.write.parquet(p)))(df, new)
    except BaseException:
        files.delete(make(new), True)
        raise
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not files.rename(make(new), target):
        restore(spark, path)
        raise OSError(f"cannot move {new}")
    files.delete(old, True)


def restore(spark: SparkSession, path: str) -> None:
    """Put a table back that a publication had moved away when it died, or drop that copy where the new table is there."""
    target, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}._old"))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(old):
        if files.exists(target):
            files.delete(old, True)
        else:
            files.rename(old, target)


def load_enriched(spark: SparkSession, work: str, names: Sequence[str] = ("export_light", "export")) -> DataFrame:
    """The finished table for analysis: the light one where there is one, else the full one."""
    for name in names:
        if exists(spark, f"{work}/{name}"):
            return spark.read.parquet(f"{work}/{name}")
    raise FileNotFoundError(f"{work} holds none of {', '.join(names)}")


class JsonTables:
    """JSON tables of a folder by name, each read and cached at its first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.known = spark, folder, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.known:
            self.known[name] = self.spark.read.json(f"{self.folder}/{name}").cache()
        return self.known[name]

    def clear(self) -> None:
        for df in self.known.values():
            df.unpersist()
        self.known = {}
