"""Character references as Columns against the library's function."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from jobtide.functions import text


def check(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    got = {r.i: r.u for r in df.select("i", text.unescape_entities(F.col("t")).alias("u")).collect()}
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if t is not None and got[i] != html.unescape(t)]
    assert wrong == [] and all(got[i] is None for i, t in enumerate(texts) if t is None)


def test_every_name(spark):
    names = sorted(html5)
    check(spark, [f"a&{n}b" for n in names] + [f"&{n}" for n in names] + [f"&{n.rstrip(';')}" for n in names] + [f"&{n.rstrip(';')}x;&{n}" for n in names] + [f"&{n.rstrip(';')}&" for n in names])


def test_edge_numbers(spark):
    edges = [*range(0, 300), 0x2028, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x1FFFF, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 9_999_999, 10**7, 10**30]
    check(spark, [f"x&#{n};y" for n in edges] + [f"&#{n}z" for n in edges] + [f"&#x{n:x};" for n in edges] + [f"&#X000{n:X}g" for n in edges] + [f"&#00{n};" for n in edges])


def test_odd_texts(spark):
    rng = random.Random(3)
    parts = ["&", "amp", "lt", ";", "#", "x", "41", "notit", "not", "&#", "&#x", "&#xg", " ", "\t", "<", "é", "😀", "&" + "a" * 40, "&" + "é" * 33 + ";", "CounterClockwiseContourIntegral", "&&amp;amp;", "\n", "AMP", "&#65", "&#;"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(800)]
    check(spark, [None, "", "plain", "&", "&&", "a & b", "&amp", *made])


def test_no_python_in_the_plan(spark):
    df = spark.range(1).select(F.concat(F.lit("<b>a</b> &auml; &#8364;"), F.when(F.col("id") > 5, "x").otherwise("")).alias("t"))
    plan = df.select(text.clean_html(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert df.select(text.clean_html(F.col("t"))).first()[0] == " a  ä €"


def test_the_query_keeps_to_the_references_of_its_sql(spark, tmp_path):
    import duckdb

    from jobtide import queries

    named = [e for e, _ in text.BASIC_ENTITIES]
    rng = random.Random(8)
    parts = [*named, "&", "&amp", "&quot", "&lt", "&hellip;", "&#8364;", "&#039;", "&#39", "&am", ";", "lt;", "<b>", "<", ">", " x", "é"]
    html_texts = ["Fish &amp", "&quot", "a &hellip; b", "&amp;lt; &amp;amp;", "", None, "no sign", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(400))]
    spark.createDataFrame(list(enumerate(html_texts)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.sha for r in queries.clean_html_entities(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = dict(con.sql(queries.ORACLE_SQL["clean_html_entities"]).fetchall())
    assert [t for i, t in enumerate(html_texts) if got[i] != want[i]] == []
