"""The dashboard's tables: name to small DataFrame, and one JSON file for each group of them.

Columns are those of the finished posting table. Nothing is computed until a table is read.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics, filters
from ..sources.io import write_json_report

# Columns of the slim rows, roles with a page of their own, levels of the progression.
SLIM_COLUMNS = "row_id title company_name city state date_posted contract_type work_modality salary_min salary_max experience_years seniority education_level job_family technical_skills benefits languages".split()
ROLES = ("Data Engineer", "Data Scientist", "Data Analyst", "Software Developer", "Machine Learning Engineer", "DevOps Engineer")
LEVELS = ("Junior", "Mid", "Senior", "Lead")


def recent(df: DataFrame, cutoff: str = "2025-10-01") -> DataFrame:
    """Known dates from the cutoff on; unknown and NULL dates go."""
    return filters.not_before(filters.exclude_future_dates(df), "date_posted", cutoff, keep_null=False)


def slim(df: DataFrame, columns: Sequence[str] = SLIM_COLUMNS) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def overview(df: DataFrame) -> dict[str, DataFrame]:
    found = {"totals": analytics.overview(df, company="company_name", place="city", date="date_posted", low="salary_min", high="salary_max", modality="work_modality")}
    for column, n in (("job_family", 15), ("seniority", None), ("work_modality", None), ("contract_type", None), ("city", 15)):
        found[column] = analytics.counts(df, column, n)
    return found | {"per_month": analytics.per_period(df, "date_posted", "month")}


def skills(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "top": analytics.skill_counts(df, "technical_skills", 25), "by_family": analytics.skill_by_group(df, "technical_skills", "job_family", 15, 12), "cooccurrence": analytics.skill_cooccurrence(df, "technical_skills", 15),
        "required_vs_optional": analytics.required_vs_optional(df, "technical_skills", "nice_to_have_skills", 20), "soft": analytics.skill_counts(df, "soft_skills", 20),
    }


def salary(df: DataFrame) -> dict[str, DataFrame]:
    pay = filters.salary_df(df)
    return {g: analytics.quantiles_by_group(pay, g, "salary_mid", 5) for g in ("job_family", "seniority", "city")} | {"premium": analytics.skill_premium(pay, "technical_skills", "salary_mid", 5, 25)}


def location(df: DataFrame) -> dict[str, DataFrame]:
    return {"cities": analytics.counts(df, "city", 30), "states": analytics.counts(df, "state", 16), "modality_by_state": analytics.row_shares(df, "state", "work_modality", 12)}


def remote(df: DataFrame) -> dict[str, DataFrame]:
    return {g: analytics.crosstab(df, g, "work_modality", missing="Unspecified") for g in ("job_family", "seniority", "city")}


def seniority(df: DataFrame) -> dict[str, DataFrame]:
    return {"counts": analytics.counts(df, "seniority"), "by_family": analytics.crosstab(df, "job_family", "seniority", missing="Unspecified"), "experience": analytics.five_numbers(df, "seniority", "experience_years")}


def benefits(df: DataFrame) -> dict[str, DataFrame]:
    return {"top": analytics.skill_counts(df, "benefits", 30), "categories": analytics.skill_counts(df, "benefit_categories", None), "by_family": analytics.category_by_group(df, "benefit_categories", "job_family", 12)}


def languages(df: DataFrame) -> dict[str, DataFrame]:
    asked = df.withColumn("asked", F.to_json("languages"))
    mentions = df.select(F.inline("languages")).groupBy("language").agg(F.count("*").alias("n"))
    return {"by_family": analytics.text_share(asked, "job_family", F.col("asked"), ["german", "english"]), "german_levels": analytics.language_levels(df, "languages", "German"), "mentions": mentions}


def education(df: DataFrame) -> dict[str, DataFrame]:
    return {"counts": analytics.counts(df, "education_level"), "by_family": analytics.crosstab(df, "job_family", "education_level", missing="Unspecified"), "by_seniority": analytics.crosstab(df, "seniority", "education_level", missing="Unspecified"), "soft_by_family": analytics.category_by_group(df, "soft_skill_categories", "job_family", 10)}


def companies(df: DataFrame) -> dict[str, DataFrame]:
    return {"top": analytics.counts(df, "company_name", 20), "diversity": analytics.diversity(df, "company_name", "job_family", 5, 15)}


def role_dives(df: DataFrame, roles: Sequence[str] = ROLES) -> dict[str, DataFrame]:
    """All roles in one pass for each facet."""
    own = df.filter(F.col("job_family").isin(*roles))
    items = own.select("job_family", F.explode("technical_skills").alias("skill"))
    facets = {c: analytics.top_per_group(own, "job_family", c, n) for c, n in (("seniority", 10), ("work_modality", 5), ("city", 10))}
    pay = analytics.quantiles_by_group(filters.salary_df(own), "job_family", "salary_mid", 3)
    return {"counts": analytics.counts(own, "job_family"), "skills": analytics.top_per_group(items, "job_family", "skill", 15), "salary": pay, "progression": analytics.skill_progression(own, "technical_skills", "seniority", LEVELS, 10), **facets}


def personas(df: DataFrame) -> dict[str, DataFrame]:
    tags = filters.personas()
    pay = df.withColumn("salary_mid", F.floor((F.col("salary_min") + F.col("salary_max")) / 2))
    tagged = df.withColumn("persona", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tags.items()]))))
    items = tagged.select("persona", F.explode("technical_skills").alias("skill"))
    return {"stats": analytics.persona_stats(pay, tags, family="job_family", value="salary_mid"), "skills": analytics.top_per_group(items, "persona", "skill", 10), "cities": analytics.top_per_group(tagged, "persona", "city", 5)}


GROUPS = {f.__name__: f for f in (overview, skills, salary, location, remote, seniority, benefits, languages, education, companies, role_dives, personas)}


def write(df: DataFrame, folder: str, names: Sequence[str] = tuple(GROUPS)) -> list[str]:
    """One JSON file per group in a local folder; the tables are small by construction."""
    os.makedirs(folder, exist_ok=True)
    rows = recent(df).cache()
    paths = []
    for name in names:
        path = os.path.join(folder, f"{name}.json")
        write_json_report(GROUPS[name](rows), path)
        paths.append(path)
    rows.unpersist()
    return paths
