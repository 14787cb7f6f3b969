"""A keyed table as a log of deltas: a batch writes its own rows, readers see the latest row of each key.

    <path>/data/<commit>/_bucket=<k>/*.parquet   rows with _deleted and the commit's number in _version
    <path>/log/<version>.json                     what the table is made of since that version

A commit writes its files first and then publishes them by one rename of a small manifest, which fails if another writer took the
version; that writer's work is then merged onto the new state by trying again. A run that dies before the rename leaves files that no
manifest names, and the old state. Keys are dealt to a fixed number of buckets by hash. Compaction rewrites only the
buckets whose deltas outweigh a share of their base, and `vacuum` deletes files that no kept manifest names.

Reading: rows of the base without those whose key is in a delta, and the latest delta of each key. Deltas are compared as (key, version) only;
hot keys cost a row per commit and task.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 16
#: Buckets whose deltas have more than this share of their base's bytes are compacted.
SHARE = 0.3
#: Manifests that stay readable.
KEEP = 10
_OWN = ("_bucket", "_deleted", "_version")


class Conflict(Exception):
    """Another writer published the version first."""


class _Moved(Exception):
    """The table is not what a change was made for."""


@dataclass(frozen=True)
class Part:
    """The files of one bucket of one commit."""

    path: str
    bucket: int
    version: int
    bytes: int
    base: bool


@dataclass(frozen=True)
class Manifest:
    version: int
    key: tuple[str, ...]
    buckets: int
    schema: str
    parts: tuple[Part, ...]
    batches: dict[str, int]

    def as_json(self) -> str:
        return json.dumps({**self.__dict__, "parts": [p.__dict__ for p in self.parts]})

    @staticmethod
    def of(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(**(raw | {"key": tuple(raw["key"]), "parts": tuple(Part(**p) for p in raw["parts"])}))


class StateLog:
    """upsert, delete, read, lookup, compact, vacuum on the table at `path`; created by `StateLog.create`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    @staticmethod
    def create(spark: SparkSession, path: str, schema: StructType, key: Sequence[str], *, buckets: int = BUCKETS) -> StateLog:
        """A new table; one that is there already stays as it is if it has the same key and columns."""
        log = StateLog(spark, path)
        if missing := [k for k in key if k not in schema.names]:
            raise ValueError(f"no key column {', '.join(missing)}")
        if clash := [c for c in schema.names if c in _OWN]:
            raise ValueError(f"columns that the log uses itself: {', '.join(clash)}")
        if log.version() is None:
            try:
                log._publish(Manifest(0, tuple(key), buckets, schema.json(), (), {}))
            except Conflict:
                pass
        now = log.manifest()
        if now.key != tuple(key) or log.schema().names != schema.names:
            raise ValueError(f"{path} has the key {now.key} and the columns {log.schema().names}")
        return log

    # ---------------------------------------------------------------- manifests

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def versions(self) -> list[int]:
        folder = self._path("log")
        if not self._files.exists(folder):
            return []
        return sorted(int(n[:-5]) for s in self._files.listStatus(folder) if (n := s.getPath().getName()).endswith(".json") and n[:-5].isdigit())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no state log at {self.path}")
        stream = self._files.open(self._path("log", f"{version:012d}.json"))
        try:
            return Manifest.of(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.manifest().schema))

    def _publish(self, manifest: Manifest) -> None:
        """One rename that does not replace: of two writers of a version one fails."""
        held = self._path("log", f".{uuid.uuid4().hex}")
        out = self._files.create(held)
        try:
            out.write(bytearray(manifest.as_json().encode()))
        finally:
            out.close()
        target = self._path("log", f"{manifest.version:012d}.json")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(held, target, options)
        except Exception as e:
            self._files.delete(held, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(str(manifest.version)) from None
            raise

    # ---------------------------------------------------------------- writing

    def _bucket(self, manifest: Manifest):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in manifest.key]), F.lit(manifest.buckets)).cast("int")

    def _write(self, rows: DataFrame, manifest: Manifest, *, base: bool) -> list[Part]:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        target = self._jvm.org.apache.hadoop.fs.Path(folder)
        found = [s for s in self._files.listStatus(target) if s.isDirectory() and s.getPath().getName().startswith("_bucket=")]
        return [Part(f"{folder}/{s.getPath().getName()}", int(s.getPath().getName()[8:]), manifest.version, self._files.getContentSummary(s.getPath()).getLength(), base) for s in found]

    def _commit(self, change: Callable[[Manifest], Manifest | None], tries: int = 20) -> int:
        """Publish what `change` makes of the newest manifest; files that a lost race wrote are used again where they do not depend on it."""
        for k in range(tries):
            now = self.manifest()
            new = change(now)
            if new is None:
                return now.version
            try:
                self._publish(new)
                return new.version
            except Conflict:
                time.sleep(min(1.0, 0.01 * 2**k))
        raise Conflict(f"{self.path}: lost {tries} times")

    def _add(self, rows: DataFrame, deleted: bool, writer: str | None, batch: int | None, only_on: int | None = None) -> int:
        now = self.manifest()
        names = StructType.fromJson(json.loads(now.schema)).names
        shaped = rows.select(*[F.col(f"`{c}`") for c in names]) if not deleted else rows.select(*[F.col(f"`{c}`") if c in now.key else F.lit(None).cast(self.schema()[c].dataType).alias(c) for c in names])
        if writer is not None and batch is not None and now.batches.get(writer, -1) >= batch:
            return now.version
        ready = shaped.withColumns({"_deleted": F.lit(deleted), "_bucket": self._bucket(now)})
        written: list[Part] = []

        def change(newest: Manifest) -> Manifest | None:
            if writer is not None and batch is not None and newest.batches.get(writer, -1) >= batch:
                return None
            if only_on is not None and newest.version != only_on:
                raise _Moved
            if not written:
                written.extend(self._write(ready, newest, base=False))
            batches = newest.batches | ({writer: batch} if writer is not None and batch is not None else {})
            own = [Part(p.path, p.bucket, newest.version + 1, p.bytes, False) for p in written]
            return Manifest(newest.version + 1, newest.key, newest.buckets, newest.schema, (*newest.parts, *own), batches)

        return self._commit(change)

    def upsert(self, rows: DataFrame, *, order: Sequence = (), writer: str | None = None, batch: int | None = None) -> int:
        """The rows become the latest of their keys; of rows with one key the last by `order` (any, without it). NULL keys are equal.

        A batch that `writer` has committed before is not written again. Returns the version. The cost is that of the rows, not of the table.
        """
        key = self.manifest().key
        best = rows.dropDuplicates(list(key))
        if order:
            pick = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]))
            best = rows.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(key)]).agg(pick.alias("_row")).select("_row.*")
        return self._add(best, False, writer, batch)

    def insert(self, rows: DataFrame, *, writer: str | None = None, batch: int | None = None, tries: int = 20) -> int:
        """Only rows whose key is not in the table. If another commit comes between, the rows are compared with the newer table."""
        for _ in range(tries):
            manifest = self.manifest()
            known = self._live(manifest).select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(manifest.key)])
            new = rows.dropDuplicates(list(manifest.key))
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(manifest.key)]
            try:
                return self._add(new.join(known, same, "left_anti"), False, writer, batch, only_on=manifest.version)
            except _Moved:
                pass
        raise Conflict(f"{self.path}: lost {tries} times")

    def delete(self, keys: DataFrame, *, writer: str | None = None, batch: int | None = None) -> int:
        return self._add(keys.dropDuplicates(list(self.manifest().key)), True, writer, batch)

    # ---------------------------------------------------------------- reading

    def _parts(self, manifest: Manifest, parts: Sequence[Part]) -> DataFrame:
        """Rows of parts with _version, from one scan for each version."""
        fields = StructType.fromJson(json.loads(manifest.schema)).add("_deleted", "boolean")
        by_version: dict[int, list[str]] = defaultdict(list)
        for p in parts:
            by_version[p.version].append(p.path)
        found = None
        for version, paths in sorted(by_version.items()):
            one = self.spark.read.schema(fields).parquet(*paths).withColumn("_version", F.lit(version).cast("long"))
            found = one if found is None else found.unionAll(one)
        return found if found is not None else self.spark.createDataFrame([], fields.add("_version", "long"))

    def _live(self, manifest: Manifest, buckets: set[int] | None = None) -> DataFrame:
        names = StructType.fromJson(json.loads(manifest.schema)).names
        chosen = [p for p in manifest.parts if buckets is None or p.bucket in buckets]
        base, deltas = [p for p in chosen if p.base], [p for p in chosen if not p.base]
        kept = self._parts(manifest, base)
        if deltas:
            keys = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(manifest.key)]
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(manifest.key)]
            changed = self._parts(manifest, deltas)
            last = changed.groupBy(*keys).agg(F.max("_version").alias("_last"))
            kept = kept.join(last, same, "left_anti").unionAll(changed.join(last, [*same, F.col("_version") == F.col("_last")], "left_semi"))
        return kept.filter("NOT _deleted").select(*[F.col(f"`{c}`") for c in names])

    def read(self, version: int | None = None) -> DataFrame:
        """The table, or what it was at a version that is kept."""
        return self._live(self.manifest(version))

    def lookup(self, keys: DataFrame, *, most: int = 100_000) -> DataFrame:
        """Rows of the given keys; only their buckets are read. More than `most` keys are joined with the whole table."""
        manifest = self.manifest()
        wanted = keys.select(*[F.col(f"`{k}`") for k in manifest.key]).distinct()
        named = wanted.select(self._bucket(manifest).alias("b")).distinct().limit(manifest.buckets).collect() if wanted.limit(most + 1).count() <= most else None
        live = self._live(manifest, None if named is None else {r.b for r in named})
        other = wanted.toDF(*[f"_k{i}" for i in range(len(manifest.key))])
        return live.join(other, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(manifest.key)], "left_semi")

    # ---------------------------------------------------------------- upkeep

    def heavy(self, share: float = SHARE) -> set[int]:
        """Buckets whose deltas have more than `share` of the bytes of their base."""
        size: dict[tuple[int, bool], int] = defaultdict(int)
        for p in self.manifest().parts:
            size[p.bucket, p.base] += p.bytes
        return {b for b in {b for b, _ in size} if size[b, False] > share * size[b, True]}

    def compact(self, buckets: set[int] | None = None, *, share: float = SHARE) -> int:
        """Buckets (the heavy ones) become one base each. Deltas that are committed meanwhile stay deltas."""
        start = self.manifest()
        chosen = self.heavy(share) if buckets is None else buckets
        if not chosen:
            return start.version
        rows = self._live(start, chosen).withColumns({"_deleted": F.lit(False), "_bucket": self._bucket(start)})
        written = self._write(rows, start, base=True)
        old = {p.path for p in start.parts if p.bucket in chosen}

        def change(newest: Manifest) -> Manifest:
            if not old <= {p.path for p in newest.parts}:
                raise Conflict("another compaction took these files")
            return Manifest(newest.version + 1, newest.key, newest.buckets, newest.schema, (*[p for p in newest.parts if p.path not in old], *written), newest.batches)

        return self._commit(change)

    def vacuum(self, *, keep: int = KEEP, older_than_s: float = 3600) -> int:
        """Delete older manifests than the last `keep`, and data that none of the kept names and that is old enough not to be in the making."""
        versions = self.versions()
        named = {p.path for v in versions[-keep:] for p in self.manifest(v).parts}
        commits = {x.rsplit("/", 2)[1] for x in named}
        gone = 0
        for v in versions[:-keep]:
            self._files.delete(self._path("log", f"{v:012d}.json"), False)
        if self._files.exists(self._path("data")):
            for s in self._files.listStatus(self._path("data")):
                if s.getPath().getName() not in commits and s.getModificationTime() / 1000 <= time.time() - older_than_s:
                    self._files.delete(s.getPath(), True)
                    gone += 1
        return gone
