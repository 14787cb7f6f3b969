"""The cube equals the row path for any filter and grouping."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators import analytics, filters
from jobtide.operators.cube import FilterCube

DIMS = ["family", "seniority", "city", "state", "work_modality", "site"]
VALUES = {"family": ["A", "B", "C", None], "seniority": ["Junior", "Senior", None], "city": ["x", "y", "z, w", None], "state": ["s", None], "work_modality": ["Remote", "On-site", None], "site": ["one", "two"]}


def postings(spark, n=400):
    rng = random.Random(7)
    rows = [(*[rng.choice(VALUES[d]) for d in DIMS], rng.choice(["c1", "c2", "c3", None]), rng.choice([None, rng.randrange(1000)])) for _ in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{d} string" for d in [*DIMS, "company"]) + ", pay int")


def measures():
    return {"n": ("count", F.lit(True)), "known": ("count", F.col("pay").isNotNull()), "paid": ("sum", F.col("pay")), "low": ("min", F.col("pay")), "high": ("max", F.col("pay"))}


def row_path(df, by, wanted):
    rows = filters.multi_filter(df, wanted)
    aggs = [F.count("*").alias("n"), F.count("pay").alias("known"), F.sum("pay").alias("paid"), F.min("pay").alias("low"), F.max("pay").alias("high")]
    return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def content(df):
    return sorted(map(repr, df.collect()))


QUESTIONS = [
    ([], {}), ([], {"family": "A"}), ([], {"family": "A, B", "site": "two", "city": ""}), (["family"], {}), (["family", "site"], {"seniority": "Junior,Senior", "state": "s"}),
    (DIMS, {}), (["state"], {"state": "s"}), (["city"], {"work_modality": "none such"}), ([], {"work_modality": "none such"}), (["work_modality"], {d: ",".join(v for v in VALUES[d] if v) for d in DIMS}),
]


@pytest.mark.parametrize("sets", [None, [["family", "site"], ["city"]], []])
def test_equals_the_row_path(spark, tmp_path, sets):
    df = postings(spark)
    cube = FilterCube.build(df, str(tmp_path / "cube"), DIMS, measures(), different=["company"], sets=sets)
    for by, wanted in QUESTIONS:
        assert content(cube.answer(by, wanted)) == content(row_path(df, by, wanted)), (by, wanted)
        companies = filters.multi_filter(df, wanted).agg(F.countDistinct("company").alias("n"))
        assert content(cube.different("company", wanted)) == content(companies)


def test_the_smallest_set_is_read(spark, tmp_path):
    df = postings(spark)
    path = str(tmp_path / "cube")
    FilterCube.build(df, path, DIMS, measures(), sets=[["family", "site"], ["family", "site", "state"], ["city"], []])
    cube = FilterCube(spark, path)
    assert cube.smallest([]) == 0 and cube.smallest(["site"]) == 0b100001 and cube.smallest(["state", "site"]) == 0b101001 and cube.smallest(["city", "site"]) == 0b111111
    assert {f.rsplit("/", 2)[1] for f in cube.cells(["family", "site"]).inputFiles()} == {"_set=33"} and cube.sizes[33] == 8
    with pytest.raises(ValueError):
        cube.answer(["pay"])
    with pytest.raises(ValueError):
        cube.different("company")
    with pytest.raises(ValueError):
        FilterCube.build(df, path, DIMS, {"m": ("median", F.col("pay"))})
    with pytest.raises(ValueError):
        FilterCube.build(df, path, DIMS, measures(), sets=[["pay"]])


def test_dashboard_numbers(spark, tmp_path):
    df = postings(spark)
    cube = FilterCube.build(df, str(tmp_path / "cube"), DIMS, measures(), different=["company"])
    wanted = {"family": "A,C", "seniority": "Senior"}
    rows = filters.multi_filter(df, wanted)
    assert content(cube.count_by("city", wanted)) == content(analytics.counts(rows, "city"))
    assert content(cube.crosstab("family", "city", wanted)) == content(analytics.crosstab(rows, "family", "city"))
    got = cube.overview(wanted, company="company", modality="work_modality", known_pay="known").first()
    every = [r.asDict() for r in rows.collect()]
    named = [r for r in every if r["work_modality"]]
    assert got.total == len(every) and got.companies == len({r["company"] for r in every if r["company"]})
    assert got.remote_pct == pytest.approx(100 * sum(r["work_modality"] == "Remote" for r in named) / len(named))
    assert got.salary_known_pct == pytest.approx(100 * sum(r["pay"] is not None for r in every) / len(every))
    none = cube.overview({"family": "nothing"}, company="company", modality="work_modality", known_pay="known").first()
    assert tuple(none) == (0, 0, 0.0, 0.0)


def test_empty_tables(spark, tmp_path):
    cube = FilterCube.build(postings(spark).limit(0), str(tmp_path / "cube"), DIMS, measures(), different=["company"])
    assert cube.answer(["family"]).collect() == [] and cube.answer().first().n == 0 and cube.different("company").first().n == 0
