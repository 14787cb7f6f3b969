"""Resumable extraction, exports, SQL names and the command line."""

from pyspark.sql import functions as F

from jobtide import sql
from jobtide.plans import extraction, pipeline
from jobtide.sources import io

ANSWER = '{"job_family": "Data", "job_summary": "Long enough to be read."}'


def test_extraction_goes_on_with_what_is_missing(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), "Data Engineer", "Python") for i in range(6)], "row_id string, title string, description string")
    calls = []

    def half(todo):
        calls.append(todo.count())
        return todo.select("row_id", F.when(F.col("row_id") < "3", ANSWER).otherwise("cannot be read, whatever is tried").alias("raw"))

    path = str(tmp_path / "store")
    first = extraction.extract_resumable(rows, path, half, attempts=2)
    assert calls == [6, 3] and {r.row_id for r in extraction.failures(first).collect()} == {"3", "4", "5"}
    assert {r.strategy: r.n for r in extraction.parse_summary(first).collect()} == {"direct": 3, "failed": 3}
    again = extraction.extract_resumable(rows, path, half, attempts=2)
    assert calls == [6, 3] and again.count() == 6
    mended = extraction.extract_resumable(rows, path, lambda todo: todo.select("row_id", F.lit(ANSWER).alias("raw")), attempts=3, batches=2)
    assert extraction.failures(mended).count() == 0 and {r.attempt for r in mended.collect()} == {1, 3}


def test_remote_calls_are_repeated_on_overload_only(spark):
    class Busy(Exception):
        status = 429

    def call(title, text):
        if title == "bad":
            raise ValueError("no")
        call.tries = getattr(call, "tries", 0) + 1
        if call.tries % 3:
            raise Busy("later")
        return text, 10, 2

    rows = spark.createDataFrame([("1", "good", "answer"), ("2", "bad", "x")], "row_id string, title string, description string").coalesce(1)
    got = {r.row_id: r for r in extraction.remote(call, attempts=3, pause=0)(rows).collect()}
    assert (got["1"].raw, got["1"].tokens_in, got["1"].error) == ("answer", 10, None) and got["2"].raw == "" and got["2"].error == "ValueError: no"
    assert extraction.remote(call)(rows.limit(0)).count() == 0


def test_exports_and_loaders(spark, tmp_path):
    rows = spark.createDataFrame([("1", "", ["a"], "s1"), ("2", "Full-time", [], "s2"), ("3", None, None, "s2")], "row_id string, contract_type string, technical_skills array<string>, source_file string")
    found = io.export_by_source(rows, str(tmp_path / "out"))
    combined = io.read_csv_safe(spark, found["combined"])
    assert combined.count() == 3 and {r.row_id: r.contract_type for r in combined.collect()} == {"1": None, "2": "Full-time", "3": None}
    assert sorted(p.name for p in (tmp_path / "out" / "by_source").iterdir() if p.is_dir()) == ["source_file=s1", "source_file=s2"]
    rows.write.parquet(str(tmp_path / "work/export"))
    assert "technical_skills" in io.load_enriched(spark, str(tmp_path / "work")).columns
    rows.drop("technical_skills").write.parquet(str(tmp_path / "work/export_light"))
    assert "technical_skills" not in io.load_enriched(spark, str(tmp_path / "work")).columns
    io.write_json_records(rows, str(tmp_path / "json/one"))
    tables = io.JsonTables(spark, str(tmp_path / "json"))
    assert tables("one").count() == 3 and tables("one") is tables("one")
    tables.clear()


def test_sql_names(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS)
    row = spark.sql("SELECT jt_strip('  a b ') AS s, jt_salary_mid(10, 20) AS m, jt_jaccard(array('a', 'b'), array('b')) AS j, jt_list_contains(array('SQL'), 'sql') AS c, jt_estimate_tokens('abcdefgh', 4) AS t, jt_description_quality('aB') AS q, length(jt_row_id('x')) AS n").first()
    assert tuple(row) == ("a b", 15.0, 0.5, True, 2, "clean", 12)


def test_stages_without_extraction():
    assert pipeline.plan(no_llm=True) == [n for n in pipeline.NAMES if n not in ("extract", "validate")]
    assert pipeline.main(["--no-llm", "--dry-run"]) == 0
