"""Calls in flight, rate limits, runs that stop and go on, tables that are replaced as a whole."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from jobtide.plans import extraction, pipeline
from jobtide.plans.extraction import TokenBucket, remote
from jobtide.sources import io

ANSWER = json.dumps({"job_family": "Data", "job_summary": "Long enough to be read.", "technical_skills": [], "nice_to_have_skills": [], "benefits": [], "tasks": []})


def frame(spark, n, parts=1):
    return spark.createDataFrame([(f"{i:03d}", f"title {i}", "text") for i in range(n)], "row_id string, title string, description string").coalesce(parts)


def test_calls_are_in_flight_together_and_answers_in_order(spark):
    # the counters are those of the worker, which gets the function by value
    def in_worker(title, text):
        import threading

        me = in_worker.__globals__.setdefault("_flight", {"now": 0, "most": 0, "lock": threading.Lock()})
        with me["lock"]:
            me["now"] += 1
            me["most"] = max(me["most"], me["now"])
        time.sleep(0.02 if int(title.split()[1]) % 3 else 0.08)
        with me["lock"]:
            me["now"] -= 1
        return f"{title} {me['most']}", 1, 1

    got = remote(in_worker, in_flight=10)(frame(spark, 60)).collect()
    assert [r.row_id for r in got] == [f"{i:03d}" for i in range(60)] and [r.raw.split()[1] for r in got] == [str(i) for i in range(60)]
    assert max(int(r.raw.split()[2]) for r in got) == 10


def test_failures_stay_with_their_rows(spark):
    def call(title, text):
        if title.endswith("7"):
            raise ValueError("no")
        return title, 2, 3

    got = {r.row_id: r for r in remote(call, in_flight=4, tasks=3)(frame(spark, 30)).collect()}
    assert len(got) == 30 and {k for k, r in got.items() if r.error} == {"007", "017", "027"} and got["007"].raw == "" and got["008"].raw == "title 8"
    for bad in ({"in_flight": 0}, {"tasks": 0}):
        with pytest.raises(ValueError):
            remote(call, **bad)


def test_token_bucket_keeps_the_rate():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = TokenBucket(5, 2, clock=lambda: now[0], sleep=sleep)
    for _ in range(12):
        bucket.take()
    assert now[0] == pytest.approx(2.0) and len(slept) == 10  # two at once, then ten at five a second
    now[0] += 100
    before = len(slept)
    bucket.take(), bucket.take(), bucket.take()
    assert len(slept) == before + 1
    with pytest.raises(ValueError):
        TokenBucket(0)


def test_rate_holds_over_threads(spark):
    began = time.time()
    got = remote(lambda title, text: (title, 0, 0), in_flight=8, rate=40, burst=1, tasks=2)(frame(spark, 40)).count()
    assert got == 40 and time.time() - began > 0.8


def stage_rows(spark, n):
    rows = [(f"r{i:02d}", f"r{i // 2 * 2:02d}", "Developer", f"description {i // 2}") for i in range(n)]
    return spark.createDataFrame(rows, "row_id string, representative string, title_cleaned string, description string")


def test_a_stopped_extraction_goes_on(spark, tmp_path):
    asked = []

    def failing(rows):
        ids = sorted(r.row_id for r in rows.collect())
        if len(asked) == 2:
            raise KeyboardInterrupt
        asked.append(ids)
        return rows.select("row_id", F.lit(ANSWER).alias("raw"))

    def working(rows):
        asked.append(sorted(r.row_id for r in rows.collect()))
        return rows.select("row_id", F.lit(ANSWER).alias("raw"))

    df, store = stage_rows(spark, 40), str(tmp_path / "answers")
    settings = dict(answers=store, commit_rows=5)
    with pytest.raises(KeyboardInterrupt):
        pipeline.semantic_extract(spark, df, pipeline.Settings(extractor=failing, **settings))
    first = {x for ids in asked for x in ids}
    assert 0 < len(first) < 20
    asked.clear()
    got = pipeline.semantic_extract(spark, df, pipeline.Settings(extractor=working, **settings))
    again = [x for ids in asked for x in ids]
    assert not first & set(again) and len(again) == len(set(again)) == 20 - len(first)
    assert got.count() == 40 and got.filter("job_family = 'Data'").count() == 40
    asked.clear()
    pipeline.semantic_extract(spark, df, pipeline.Settings(extractor=working, **settings)).count()
    assert asked == []


def test_tables_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    io.publish(spark.range(3), path)
    boom = F.udf(lambda x: 1 // 0)
    with pytest.raises(Exception):
        io.publish(spark.range(5).withColumn("x", boom("id")), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["table"]
    io.publish(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    (tmp_path / "table").rename(tmp_path / "table._old")  # died between the renames
    io.restore(spark, path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["table"]
    io.publish(spark.read.parquet(path).filter("id > 2"), path)  # a table may be made from itself
    assert spark.read.parquet(path).count() == 2


def test_cleaning_remaps_and_casing(spark):
    rows = [(str(i), c, f, f"2025-01-0{i + 1}") for i, (c, f) in enumerate([("ACME", "dev"), ("Acme", "Data"), ("Acme", "odd"), ("acme", "Data"), ("N/A", "Data")])]
    df = spark.createDataFrame(rows, "row_id string, company_name string, job_family string, date_posted string")
    df = df.withColumns({"representative": F.col("row_id"), "title_cleaned": F.lit("Developer"), "description": F.lit("x"), "city": F.lit("Berlin"), "state": F.lit("Berlin"), "salary_min": F.lit("50000"), "salary_max": F.lit(None).cast("string"), "experience_years": F.lit("3"), "contract_type": F.lit("Full-time"), "work_modality": F.lit("remote work")})
    got = pipeline.clean_enrich(spark, df, pipeline.Settings(remaps={"job_family": {"dev": "Developer"}, "work_modality": {"remote work": "Remote"}, "no such": {"a": "b"}}, known_families=["Developer", "Data"]))
    found = {r.row_id: (r.company_name, r.job_family, r.work_modality) for r in got.collect()}
    assert found == {"0": ("Acme", "Developer", "Remote"), "1": ("Acme", "Data", "Remote"), "2": ("Acme", "Other", "Remote"), "3": ("Acme", "Data", "Remote"), "4": (None, "Data", "Remote")}
