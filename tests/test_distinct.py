"""Expressions once per different input; patterns with and without their signs."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide.functions import fields
from jobtide.operators import distinct
from jobtide.plans import pipeline


def counted(monkeypatch):
    sizes, write = [], distinct.written

    def keep(df):
        out = write(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(distinct, "written", keep)
    return sizes


def test_equal_inputs_are_computed_once(spark, monkeypatch):
    sizes = counted(monkeypatch)
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "", None, "long " * 50]), rng.choice([None, 1])) for i in range(300)] + [(None, "a", 1), (None, "only here", 2)]
    df = spark.createDataFrame(rows, "id long, text string, other int")
    got = distinct.evaluate_once(df, ["text"], {"n": F.length("text"), "up": F.upper("text")}, id_col="id")
    assert sizes == [5] and got.columns == ["id", "text", "other", "n", "up"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.withColumns({"n": F.length("text"), "up": F.upper("text")}).collect()))
    both = distinct.evaluate_once(df, ["text", "other"], {"s": F.concat_ws("|", "text", F.col("other").cast("string"))}, id_col="id")
    assert sizes[1] == 10 and sorted(map(repr, both.collect())) == sorted(map(repr, df.withColumn("s", F.concat_ws("|", "text", F.col("other").cast("string"))).collect()))
    assert distinct.evaluate_once(df.limit(0), ["text"], {"n": F.length("text")}, id_col="id").count() == 0


def test_the_stage_touches_each_description_once(spark, monkeypatch):
    sizes = counted(monkeypatch)
    texts = ["Vollzeit, Remote, 3 Jahre Erfahrung, Master, Deutsch C1", "Teilzeit", None]
    rows = [(f"r{i}", f"Senior Developer {i} (Hybrid)" if i % 2 else "Praktikum", texts[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id string, title_cleaned string, description string").withColumn("title", F.col("title_cleaned"))
    got = pipeline.regex_extract(spark, df, pipeline.Settings())
    assert sizes == [3]
    want = df.withColumns(fields.regex_fields(F.col("description"), F.col("title_cleaned")))
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


PARTS = ["Vollzeit", "FULL-TIME", "full time", "festſellung", "Feſtanſtellung", "Teİlzeit", "Hybrıd", "parttime", "PraKtikum", "befristete", "unbefristetes", "Praktıkant", "Contractor", "mobiles Arbeiten", "Home  Office", "on-ſite", "Präsenz", "PRÄSENZ",
         "PhD", "Ph. D.", "M. Sc.", "M.ſc", "B Sc", "Diplom", "ſtudium", "Ausbildung", "3+ Jahre Erfahrung", "mindestens 4 Jahre", "5 YEARſ experience", "Mehrjährige Berufserfahrung", "Erste erfahrung", "und", "\n", "x"]


@pytest.mark.parametrize("patterns, signs", [(fields.CONTRACT, fields.CONTRACT_SIGNS), (fields.MODALITY, fields.MODALITY_SIGNS), (fields.EDUCATION, fields.EDUCATION_SIGNS)])
def test_signs_exclude_no_match(spark, patterns, signs):
    rng = random.Random(9)
    texts = PARTS + [rng.choice([" ", "", "-"]).join(rng.choice(PARTS) for _ in range(rng.randint(1, 4))) for _ in range(600)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    assert len(signs) == len(patterns)
    wrong = df.filter(~fields.first_match(t, patterns, signs).eqNullSafe(fields.first_match(t, patterns)))
    assert wrong.collect() == []
    plain = F.coalesce(F.regexp_extract(t, fields.EXPERIENCE, 1).try_cast("int"), F.regexp_extract(t, fields.EXPERIENCE_LEAST, 1).try_cast("int"))
    assert df.filter(plain.isNotNull() & ~fields.experience_years(t).eqNullSafe(plain)).collect() == []


def test_patterns_behind_long_texts_of_any_letters(spark):
    rng = random.Random(3)
    fills = ["word ", "\U0001f600", "e\u0301", "Straße, ", "\u0130", "\u212a ", "un", "home ", "vor ", "m ", "ph ", "befristet", "x" * 60, "\u03a3", "7 "]
    texts = ["".join(rng.choice(fills) for _ in range(rng.choice([0, 3, 80]))) + "".join(rng.choice(PARTS + ["vor\u00a0Ort", "Home \n Office", "M.\u2003Sc.", "70.000 EUR", "€ 70k", "gute Deutschkenntnisse", "Francösisch B2", "at  least 4 years", "min. 5 Jahre", "3+ years experience"]) + rng.choice(["", " ", "-"]) for _ in range(2)) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for patterns, signs in ((fields.CONTRACT, fields.CONTRACT_SIGNS), (fields.MODALITY, fields.MODALITY_SIGNS), (fields.EDUCATION, fields.EDUCATION_SIGNS)):
        assert df.filter(~fields.first_match(F.col("t"), patterns, signs).eqNullSafe(fields.first_match(F.col("t"), patterns))).collect() == []
    plain = F.coalesce(F.regexp_extract("t", fields.EXPERIENCE, 1).try_cast("int"), F.regexp_extract("t", fields.EXPERIENCE_LEAST, 1).try_cast("int"))
    assert df.filter(plain.isNotNull() & ~fields.experience_years(F.col("t")).eqNullSafe(plain)).collect() == []
    none = F.struct(F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    assert df.filter(~fields.salary_range(F.col("t")).eqNullSafe(F.when(F.col("t").rlike("(?i)€|eur"), fields._salary_of(F.col("t"))).otherwise(none))).collect() == []
    every = fields._best_levels(F.concat(*[fields._mentions(F.col("t"), p, g, level) for p, groups, level in fields.LANGUAGES for g in groups]))
    assert df.filter(~fields.languages(F.col("t")).eqNullSafe(every)).collect() == []


def test_a_text_is_folded_once(spark):
    df = spark.createDataFrame([(1, "Vollzeit")], "id long, text string")
    rows = df.select("id", F.concat("text", F.lit(" once")).alias("text"))
    steps = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(distinct, "written", lambda d: steps.append(d) or d)
        got = distinct.evaluate_once(rows, ["text"], fields.description_fields(), id_col="id", parts=fields.description_parts(F.col("text")))
    assert [r.regex_contract_type for r in got.collect()] == ["Full-time"] and got.columns == ["id", "text", *fields.description_fields()]
    assert steps[0]._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
