"""SQL names give what the Column functions give."""

import pytest
from pyspark.sql import functions as F

from jobtide import sql
from jobtide.functions import arrays, numbers, text
from jobtide.operators import filters

TEXTS = ["", " ", "a", "  a \n b  ", "NA", "nan", "None", "50.000", " 1.234.567,89 ", "12,5", "12.5", "99999999999", "aB" * 12, "x\n\n\n\ny  z", "Ünï CÖDE wörd wörd", "  padded  ", None]


@pytest.mark.parametrize("name, function", [
    ("jt_strip", text.strip), ("jt_squeeze", text.squeeze), ("jt_blank", text.blank), ("jt_null_if_sentinel", text.null_if_sentinel), ("jt_description_hash", text.description_hash), ("jt_clean_whitespace", text.normalize_whitespace),
    ("jt_german_int", numbers.german_int), ("jt_tokens", text.tokens), ("jt_description_quality", lambda c: F.when(c.isNull(), F.lit(None)).otherwise(text.concatenated(c))),
])
def test_texts(spark, name, function):
    sql.register(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    kept = df.filter("t IS NOT NULL") if name == "jt_description_quality" else df
    assert kept.filter(~F.expr(f"{name}(t)").eqNullSafe(function(F.col("t")))).select("t", F.expr(f"{name}(t)"), function(F.col("t"))).collect() == []


def test_numbers_lists_and_dates(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS) >= 20
    df = spark.createDataFrame([(x, x * 1.0, ["SQL", "sap", None], ["sql"], s, y) for x, s, y in [(9999, None, 2), (10_000, "Junior", None), (300_000, "Senior", 1), (300_001, None, None), (0, None, 3)]], "i int, d double, a array<string>, b array<string>, seniority string, experience_years int").withColumns({"work_modality": F.lit(None).cast("string"), "education_level": F.lit(None).cast("string")})
    pairs = {
        "jt_salary(i)": numbers.salary(F.col("i")), "jt_round_half_up(d / 2)": numbers.round_half_up(F.col("d") / 2), "jt_percent(d / 10000)": numbers.format_pct(F.col("d") / 10000), "jt_list_except(a, b)": arrays.ci_except(F.col("a"), F.col("b")),
        "jt_jaccard(a, b)": arrays.jaccard(F.col("a"), F.col("b")), "jt_persona_junior(seniority, experience_years)": filters.personas()["junior"], "jt_week(DATE'2025-10-05')": F.lit("2025-09-29"),
    }
    for name, column in pairs.items():
        assert df.filter(~F.expr(name).eqNullSafe(column)).select(F.expr(name), column).collect() == [], name
