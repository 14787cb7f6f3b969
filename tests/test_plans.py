import json

from pyspark.sql import functions as F

from jobtide.functions.locations import parse_location
from jobtide.plans import dashboard, reports


def postings(spark):
    rows = []
    for i in range(40):
        rows.append((
            str(i), f"T{i % 3}", f"C{i % 4}", ["Berlin", "Kiel"][i % 2], ["Berlin", "SH"][i % 2], f"2025-1{i % 3}-05", "Full-time", ["Remote", "Hybrid", None][i % 3], 50000 + i * 1000 if i % 4 else None, 70000 + i * 1000,
            i % 8, ["Junior", "Senior", None][i % 3], "Bachelor", ["Data Engineer", "Data Analyst"][i % 2], ["SQL", "Python"] if i % 2 else ["SQL", "SAS"], ["Spark"], ["team"], ["Urlaub"], ["time_off"], ["Teamwork"], [("German", "C1")] if i % 2 else [],
        ))
    schema = (
        "row_id string, title string, company_name string, city string, state string, date_posted string, contract_type string, work_modality string, salary_min int, salary_max int, experience_years int, seniority string, education_level string, "
        "job_family string, technical_skills array<string>, nice_to_have_skills array<string>, soft_skills array<string>, benefits array<string>, benefit_categories array<string>, soft_skill_categories array<string>, languages array<struct<language:string,level:string>>"
    )
    return spark.createDataFrame(rows, schema)


def test_every_dashboard_group_is_written(spark, tmp_path):
    paths = dashboard.write(postings(spark), str(tmp_path), ["overview", "salary", "languages", "personas", "role_dives"])
    found = {p.rsplit("/", 1)[1]: json.load(open(p, encoding="utf-8")) for p in paths}
    assert found["overview.json"]["totals"][0]["total"] == 40 and found["languages.json"]["german_levels"] == [{"level": "C1", "n": 20}]
    assert {r["grp"] for r in found["salary.json"]["job_family"]} == {"Data Engineer", "Data Analyst"}
    assert {r["persona"] for r in found["personas.json"]["stats"]} == {"junior", "senior", "remote", "career_changer"}
    assert len(dashboard.slim(postings(spark)).columns) == len(dashboard.SLIM_COLUMNS)


def test_reports(spark):
    df = postings(spark)
    tables = reports.quality_report(df, ["work_modality", "salary_min", "technical_skills"], categoricals=["seniority"], skills="technical_skills", salary="salary_max")
    coverage = {r.field: r.pct for r in tables["coverage"].collect()}
    assert coverage == {"work_modality": 67.5, "salary_min": 75.0, "technical_skills": 100.0} and tables["concerns"].count() == 1
    assert "| SQL | 40 |" in reports.to_markdown({"skills": tables["skills"]})
    places = spark.createDataFrame([("Kiel, DE",), ("x",)], "l string").select(parse_location(F.col("l")).alias("parsed"))
    assert reports.location_report(places)["nulls"].first().fallback_pct == 50.0
    groups = spark.createDataFrame([("a",), ("a",), ("b",)], "group_hash string")
    assert tuple(reports.group_report(groups).first()) == (2, 1, 1, 2)


FLAGS = "array<struct<field:string,rule:string,severity:string,message:string>>"


def test_report_sections(spark):
    flag = lambda rule, message="", severity="warning": ("f", rule, severity, message)
    rows = [
        ("1", [flag("skill_not_in_description", "'SQL' not grounded in description"), flag("skill_not_in_description", "'SAS' not grounded in description"), flag("high_hallucination_rate", severity="error")], ["Urlaub"], ["time_off"], "Kiel", True, "x"),
        ("2", [flag("skill_not_in_description", "'SQL' not grounded in description"), flag("skill_not_in_description", "no name here"), (None, None, None, None)], [], None, None, False, "x"),
        ("3", [], None, None, "Kiel", None, None), ("4", None, ["Bonus"], [], "Bonn", False, "x"),
    ]
    df = spark.createDataFrame(rows, f"row_id string, validation_flags {FLAGS}, benefits array<string>, benefit_categories array<string>, city string, cut boolean, job_family string")
    found = reports.quality_report(df, ["job_family"], flags="validation_flags", benefits="benefits", extracted="job_family", truncated="cut", salary=[])
    got = {k: [tuple(r) for r in t.collect()] for k, t in found.items()}
    assert got["summary"] == [(4, 75.0, 25.0, 1)] and got["coverage"] == [("job_family", 75.0)] and got["concerns"] == []
    assert got["hallucination:totals"] == [(4, 1)] and sorted(got["hallucination:skills"]) == [("SAS", 1), ("SQL", 2)]
    assert got["benefits"] == [(50.0, 25.0)] and sorted(got["places:cities"]) == [("Bonn", 1), ("Kiel", 2)] and got["places:no_city"] == [(25.0,)]
    assert got["validation:rows"] == [(2, 2, 50.0)] and sorted(got["validation:rules"]) == [("high_hallucination_rate", 1), ("skill_not_in_description", 4), ("unknown", 1)]
    assert dict(got["validation:severities"]) == {"warning": 4, "error": 1, "unknown": 1}
    text = reports.to_markdown({k: found[k] for k in ("benefits", "validation:rules")}, title="Report", max_rows=2)
    assert text.startswith("# Report") and "| 50.0 | 25.0 |" in text and "Only the first 2 rows" in text
    empty = reports.quality_report(df.limit(0), ["job_family"], flags="validation_flags", benefits="benefits")
    assert tuple(empty["benefits"].first()) == (0.0, 0.0) and tuple(empty["hallucination:totals"].first()) == (0, 0) and tuple(empty["validation:rows"].first()) == (0, 0, 0.0)


def test_pages_show_rows_by_totals(spark):
    from jobtide.operators import analytics

    cells = spark.createDataFrame([("x", "Master", 1), ("x", "PhD", 4), ("y", "Bachelor", 5), ("z", "PhD", 2), ("w", "Degree", 0), ("w", "Master", 1)], "a string, b string, n long")
    got = [tuple(r) for r in analytics.by_row_totals(cells, 3, levels=["Bachelor", "Master", "PhD", "Degree", "None"]).orderBy("rank", "level").collect()]
    assert got == [(1, 2, "x", "Master", 1, 5), (1, 3, "x", "PhD", 4, 5), (2, 1, "y", "Bachelor", 5, 5), (3, 3, "z", "PhD", 2, 2)]
    assert {r.level for r in analytics.by_row_totals(cells, 1).collect()} == {1, 2}
