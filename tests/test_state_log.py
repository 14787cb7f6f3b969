"""The state log: latest wins, small commits, crashes, races, compaction."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from jobtide.sources import state_log
from jobtide.sources.state_log import Conflict, StateLog
from jobtide.streaming import ingest

SHAPE = StructType([StructField("id", StringType()), StructField("n", LongType()), StructField("note", StringType())])


def rows(spark, *values):
    return spark.createDataFrame(values, SHAPE)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data_bytes(path):
    return sum(f.stat().st_size for f in Path(path, "data").rglob("*.parquet"))


def test_equals_a_dictionary(spark, tmp_path):
    rng, want = random.Random(4), {}
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"], buckets=3)
    for step in range(12):
        keys = [None if rng.random() < 0.05 else f"k{rng.randrange(30)}" for _ in range(rng.randrange(8))]
        kind = rng.choice(["upsert", "upsert", "insert", "delete", "compact"])
        batch = [(k, step, rng.choice(["a", None])) for k in dict.fromkeys(keys)]
        df = rows(spark, *batch)
        if kind == "upsert":
            log.upsert(df)
            want |= {r[0]: r for r in batch}
        elif kind == "insert":
            log.insert(df)
            want = {r[0]: r for r in batch} | want
        elif kind == "delete":
            log.delete(df.select("id"))
            want = {k: v for k, v in want.items() if k not in {r[0] for r in batch}}
        else:
            log.compact({rng.randrange(3)} if rng.random() < 0.5 else None, share=0)
        assert content(log.read()) == sorted(want.values(), key=str), (step, kind)
        asked = spark.createDataFrame([("k1",), ("k2",), (None,)], "id string")
        assert content(log.lookup(asked)) == sorted((v for k, v in want.items() if k in ("k1", "k2", None)), key=str)
        assert content(log.lookup(asked, most=0)) == content(log.lookup(asked))


def test_a_small_batch_writes_little(spark, tmp_path):
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"], buckets=4)
    log.upsert(spark.range(200_000).select(F.col("id").cast("string"), F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("note")))
    log.compact()
    whole = data_bytes(tmp_path / "t")
    log.vacuum(keep=1, older_than_s=-1)
    base = data_bytes(tmp_path / "t")
    assert base < whole
    log.upsert(spark.range(2000).select(F.col("id").cast("string"), F.lit(-1).cast("long").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("note")))
    assert data_bytes(tmp_path / "t") - base < 0.03 * base
    assert log.read().agg(F.count("*"), F.count_if(F.col("n") == -1)).first()[:] == (200_000, 2000)
    assert log.heavy() == set() and log.compact() == log.version()
    # a compaction of one bucket leaves the others' files
    before = {p.path for p in log.manifest().parts if p.bucket != 1}
    log.compact({1})
    after = log.manifest().parts
    assert before == {p.path for p in after if p.bucket != 1} and len([p for p in after if p.bucket == 1]) == 1
    assert log.read().filter("n = -1").count() == 2000


def test_a_killed_merge_leaves_the_old_state(spark, tmp_path, monkeypatch):
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"])
    log.upsert(rows(spark, ("a", 1, "x"), ("b", 1, "x")))

    def dies(self, manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(StateLog, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            log.upsert(rows(spark, ("a", 2, "y")))
    assert content(StateLog(spark, log.path).read()) == [("a", 1, "x"), ("b", 1, "x")]
    assert log.vacuum(older_than_s=3600) == 0 and log.vacuum(older_than_s=-1) == 1
    log.upsert(rows(spark, ("a", 2, "y")))
    assert content(log.read()) == [("a", 2, "y"), ("b", 1, "x")] and content(log.read(1)) == [("a", 1, "x"), ("b", 1, "x")]


def test_of_two_writers_the_later_is_merged_onto_the_other(spark, tmp_path, monkeypatch):
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"])
    other, write = StateLog(spark, log.path), StateLog._write
    first = [True]

    def slow(self, *args, **more):
        if first:
            first.clear()
            other.upsert(rows(spark, ("a", 1, "other"), ("b", 1, "other")))
        return write(self, *args, **more)

    monkeypatch.setattr(StateLog, "_write", slow)
    log.upsert(rows(spark, ("a", 2, "mine")))
    assert content(log.read()) == [("a", 2, "mine"), ("b", 1, "other")] and log.version() == 2
    first.append(True)
    with monkeypatch.context() as m:
        m.setattr(StateLog, "_write", write)
        moved = [lambda: other.upsert(rows(spark, ("c", 5, "other")))]
        publish = StateLog._publish

        def late(self, manifest):
            if moved:
                moved.pop()()
            publish(self, manifest)

        m.setattr(StateLog, "_publish", late)
        log.insert(rows(spark, ("c", 6, "mine"), ("d", 6, "mine")))
    assert content(log.read().filter("id > 'b'")) == [("c", 5, "other"), ("d", 6, "mine")]
    with pytest.raises(Conflict):
        log._publish(log.manifest())


def test_last_by_order_batches_once_and_refusals(spark, tmp_path):
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"])
    log.upsert(rows(spark, ("a", 3, "old"), ("a", 5, "new"), ("a", 4, "mid")), order=["n"], writer="w", batch=0)
    log.upsert(rows(spark, ("a", 9, "again")), writer="w", batch=0)
    assert content(log.read()) == [("a", 5, "new")]
    log.upsert(rows(spark, ("a", 9, "next")), writer="w", batch=1)
    assert content(log.read()) == [("a", 9, "next")] and log.manifest().batches == {"w": 1}
    assert StateLog.create(spark, log.path, SHAPE, ["id"]).version() == 2
    for schema, key in ((SHAPE, ["n"]), (SHAPE, ["x"]), (StructType([StructField("id", StringType()), StructField("_bucket", IntegerType())]), ["id"])):
        with pytest.raises(ValueError):
            StateLog.create(spark, log.path, schema, key)
    with pytest.raises(FileNotFoundError):
        StateLog(spark, str(tmp_path / "none")).read()
    assert state_log.BUCKETS > 1


def test_streams_merge_into_it(spark, tmp_path):
    log = StateLog.create(spark, str(tmp_path / "t"), SHAPE, ["id"])
    merge = ingest.merge_batches(log, order=["n"])
    merge(rows(spark, ("a", 1, "x"), ("a", 2, "y")), 0)
    merge(rows(spark, ("b", 1, "x")), 1)
    merge(rows(spark, ("b", 7, "repeated")), 1)
    assert content(log.read()) == [("a", 2, "y"), ("b", 1, "x")]
