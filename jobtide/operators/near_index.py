"""A stored index of near-duplicate leaders that grows batch by batch.

A row leads if no earlier row that is similar to it leads; it follows the first such leader otherwise. Rows are earlier by batch, then by
id, so what a batch decides no later batch changes, and n batches give what one run over all rows in that order gives.

Candidates are leaders that share a part with a new row (`dedup.set_parts`), which needs nothing that is known beforehand. Below a threshold of
PARTS_FROM they share a first token: the order of tokens (rare ones first) is frozen when the index is made, as a fixed number of counters, and tokens it
does not know come first. Any order that never changes keeps the prefix filter exact. Only leaders are compared with, since followers decide nothing. A batch is
compared with the leaders that it shares an entry with, then what is left of it within itself.

The token sets of a batch are written once, to a folder of their own that the log's rows name, and read for candidates only.
The index is a state log, so a batch is committed by one rename, a batch that is run again changes nothing, and its cost
is that of the batch and of one scan of the prefixes.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import written
from ..sources.state_log import StateLog
from .dedup import PARTS_FROM, first_tokens, set_parts, similar_leaders, similarities, token_counts

_SHAPE = "id string, batch long, leader string, leader_batch long, n int, digest binary, prefix array<struct<t:bigint,left:int>>, sets string"


class NearIndex:
    """create once, then add batches of (id, tokens); `leaders` has all rows."""

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.95):
        self.spark, self.path, self.threshold = spark, path, threshold
        self.log = StateLog(spark, f"{path}/rows")
        self.by_parts = threshold >= PARTS_FROM
        self.order = None if self.by_parts else spark.read.parquet(f"{path}/order")

    @staticmethod
    def create(spark: SparkSession, path: str, known: DataFrame, tokens: str, *, threshold: float = 0.95, buckets: int = 16) -> NearIndex:
        """`known` has the token sets (column `tokens`) whose frequencies fix the order, where there is one; it may be empty."""
        if threshold < PARTS_FROM:
            token_counts(known, tokens).write.mode("errorifexists").parquet(f"{path}/order")
        StateLog.create(spark, f"{path}/rows", StructType.fromDDL(_SHAPE), ["id"], buckets=buckets)
        return NearIndex(spark, path, threshold)

    def _with_prefix(self, rows: DataFrame) -> DataFrame:
        """id, digest, n, prefix: the parts, or the first tokens in the frozen order with how many are left from each on."""
        whole = rows.select("id", "set", F.unhex(F.md5(F.to_json("set"))).alias("digest"))
        if self.by_parts:
            return set_parts(whole, "set", self.threshold, ["id", "digest"])
        return first_tokens(whole, "set", self.order, self.threshold, ["id", "digest"])

    def _postings(self, rows: DataFrame, *more: str) -> DataFrame:
        width = max(-math.log(self.threshold) * (1 + 1e-9), 1e-9)
        kind = F.floor(F.log(F.col("n")) / width)
        return rows.filter("n > 0").select("id", "n", kind.alias("kind"), F.inline("prefix"), *more)

    def _candidates(self, new: DataFrame, leads: DataFrame) -> DataFrame:
        """a, b: leaders and new rows that may be similar."""
        a = self._postings(leads).select("t", "kind", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("left").alias("lx"))
        b = self._postings(new).select("t", "kind", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("left").alias("ly"))
        close = F.least("nx", "ny") >= F.greatest("nx", "ny") * self.threshold
        if self.by_parts:
            found = a.drop("kind").join(b.drop("kind"), "t").filter(close & (F.col("lx") + F.col("ly") > 0))
        else:
            b = b.withColumn("kind", F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1)))
            enough = F.least("lx", "ly") >= (F.col("nx") + F.col("ny")) * F.lit(self.threshold / (1 + self.threshold)) - 1e-6
            found = a.join(b, ["t", "kind"]).filter(close & enough)
        return found.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()

    def _first_leader(self, new: DataFrame, leads: DataFrame, sets: DataFrame) -> DataFrame:
        """id, leader_batch, leader: the first stored leader that each new row is similar to, where there is one."""
        similar = similarities(written(self._candidates(new, leads)), sets, self.threshold).select(F.col("a").alias("x"), F.col("b").alias("y"))
        similar = similar.join(leads.select(F.col("id").alias("x"), "batch"), "x").select("x", "y", "batch")
        equal = leads.select(F.col("id").alias("x"), "batch", "digest").join(new.select(F.col("id").alias("y"), "digest"), "digest").select("x", "y", "batch")
        first = similar.unionAll(equal).groupBy(F.col("y").alias("id")).agg(F.min(F.struct("batch", "x")).alias("l"))
        return first.select("id", F.col("l.batch").alias("leader_batch"), F.col("l.x").alias("leader"))

    def add(self, rows: DataFrame, tokens: str, *, batch: int) -> DataFrame:
        """Decide the rows of a batch (columns id and `tokens`) and store them. Returns their id and leader.

        Rows whose id is stored already, or comes twice in the batch, count once, as they were first. NULL sets lead themselves and nobody
        else; empty sets are equal to each other only.
        """
        if self.log.manifest().batches.get("batches", -1) >= batch:
            return self.leaders().filter(F.col("batch") == batch).select("id", "leader")
        every = rows.select(F.col("id").cast("string").alias("id"), F.sort_array(F.array_distinct(tokens)).alias("set"))
        state = self.log.read()
        # ids alone tell whether there are rows to leave out, so that sets need not be shuffled where there are none
        if not every.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            every = every.dropDuplicates(["id"])
        stored_before = written(every.select("id").join(state.select("id"), "id", "left_semi"))
        if not stored_before.isEmpty():
            every = every.join(stored_before, "id", "left_anti")
        folder = f"{self.path}/sets/{uuid.uuid4().hex}"
        every.write.parquet(folder)
        shape = "id string, set array<string>"
        fresh = self.spark.read.schema(shape).parquet(folder)
        new = written(self._with_prefix(fresh))
        whole = new.filter("digest IS NOT NULL")
        free = whole
        decided = new.filter("digest IS NULL").select("id", F.col("id").alias("leader"), F.lit(batch).cast("long").alias("leader_batch"))
        if folders := [r.sets for r in state.select("sets").distinct().collect()]:
            sets = self.spark.read.schema(shape).parquet(*folders, folder)
            led = written(self._first_leader(whole, state.filter("id = leader AND digest IS NOT NULL"), sets))
            free = written(whole.join(led.select("id"), "id", "left_anti"))
            decided = decided.unionByName(led)
        if self.by_parts:
            own = similar_leaders(fresh, "set", self.threshold, parts=free)
        else:
            own = similar_leaders(fresh.join(free.select("id"), "id", "left_semi"), "set", self.threshold)
        decided = written(decided.unionByName(own.withColumn("leader_batch", F.lit(batch).cast("long"))))
        kept = lambda c: F.when(F.col("id") == F.col("leader"), F.col(c)).alias(c)
        stored = new.join(decided, "id").select("id", F.lit(batch).cast("long").alias("batch"), "leader", "leader_batch", "n", kept("digest"), kept("prefix"), F.lit(folder).alias("sets"))
        self.log.upsert(stored, writer="batches", batch=batch)
        return decided.select("id", "leader")

    def leaders(self) -> DataFrame:
        return self.log.read().select("id", "leader", "batch")
