import datetime as dt

from jobtide.streaming import ingest

SHAPE = "key string, at timestamp, v int"


def drop(spark, folder, rows):
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(folder)


def drain(df, spark, name, folder, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def test_duplicates_within_the_watermark_go(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d)
    drop(spark, f"{tmp_path}/in", [("a", day(1), 1), ("a", day(2), 1), ("b", day(2), 1)])
    got = drain(ingest.dedup_stream(ingest.read_drops(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema), "key", "at"), spark, "kept", tmp_path, "append")
    assert sorted(r.key for r in got.collect()) == ["a", "b"]


def test_weeks_begin_on_monday(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d)
    drop(spark, f"{tmp_path}/in", [("a", day(1), 1), ("a", day(7), 1), ("a", day(8), 1), ("b", day(8), 1)])
    rows = ingest.read_drops(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    got = drain(ingest.weekly_counts(rows, "at", "key"), spark, "weeks", tmp_path, "complete")
    assert sorted((r.week.day, r.key, r.n) for r in got.collect()) == [(1, "a", 2), (8, "a", 1), (8, "b", 1)]


def test_batches_are_merged_though_numbers_are_skipped(spark, tmp_path):
    merge = ingest.upsert_batches(f"{tmp_path}/table", "key")
    rows = lambda *r: spark.createDataFrame(r, "key string, v int")
    read = lambda n: sorted((r.key, r.v) for r in spark.read.parquet(f"{tmp_path}/table/v{n:09d}").collect())
    merge(rows(("a", 1), ("b", 1)), 0)
    merge(rows(("b", 2), ("c", 2)), 3)
    assert read(3) == [("a", 1), ("b", 2), ("c", 2)]
    merge(rows(("b", 9)), 3)  # run again
    assert read(3) == [("a", 1), ("b", 9)]
    merge(rows(("d", 4)), 4)
    assert read(4) == [("a", 1), ("b", 9), ("d", 4)] and sorted(p.name for p in (tmp_path / "table").iterdir()) == ["v000000003", "v000000004"]
