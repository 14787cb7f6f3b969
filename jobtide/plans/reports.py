"""Quality reports: small tables put together, as JSON or Markdown."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import analytics, evaluation

#: Coverage below which a field is a concern, and below which it is a serious one.
CONCERN, SERIOUS = 70.0, 50.0


def title_report(df: DataFrame, before: str = "title_original", after: str = "title_cleaned") -> DataFrame:
    """Rows changed, and different titles before and after."""
    return df.agg(F.count("*").alias("rows"), F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("changed"), F.countDistinct(before).alias("before"), F.countDistinct(after).alias("after"))


def location_report(df: DataFrame, parsed: str = "parsed") -> dict[str, DataFrame]:
    """Strategies, NULL counts and the most frequent places of a parsed location struct."""
    p = df.select(f"{parsed}.*")
    nulls = p.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("city", "state", "country")], F.round(F.avg((F.col("strategy") == "fallback").cast("int")) * 100, 2).alias("fallback_pct"))
    return {"strategies": analytics.counts(p, "strategy"), "nulls": nulls, "cities": analytics.counts(p, "city", 20), "states": analytics.counts(p, "state", 20)}


def group_report(groups: DataFrame) -> DataFrame:
    """Of description groups (group_hash, members): groups, those with several members, calls saved, the largest."""
    one = groups.groupBy("group_hash").agg(F.count("*").alias("members"))
    return one.agg(F.count("*").alias("groups"), F.count_if(F.col("members") > 1).alias("shared"), F.sum(F.col("members") - 1).alias("saved"), F.max("members").alias("largest"))


def concerns(coverage: DataFrame) -> DataFrame:
    return coverage.filter(F.col("pct") < CONCERN).withColumn("severity", F.when(F.col("pct") < SERIOUS, "serious").otherwise("concern"))


def _rule(flags: str, name: str) -> Column:
    return F.filter(F.coalesce(F.col(flags), F.array()), lambda f: f["rule"] == name)


def hallucination_summary(df: DataFrame, flags: str = "validation_flags", n: int = 10) -> dict[str, DataFrame]:
    """totals: flags of skills that the description does not have, and rows with too many of them; skills: those named most often in the messages."""
    ungrounded = _rule(flags, "skill_not_in_description")
    totals = df.agg(F.coalesce(F.sum(F.size(ungrounded)), F.lit(0)).cast("long").alias("total_skill_flags"), F.count_if(F.size(_rule(flags, "high_hallucination_rate")) > 0).alias("high_hallucination_rows"))
    named = df.select(F.explode(ungrounded).alias("f")).select(F.regexp_extract("f.message", r"'([^']+)'\s+not grounded", 1).alias("skill")).filter("skill <> ''")
    return {"totals": totals, "skills": analytics.counts(named, "skill", n, name="skill")}


def _filled(df: DataFrame, column: str, name: str) -> Column:
    """Percentage of rows whose list has an element, one decimal; 0 where there is no such column or no row."""
    if column not in df.columns:
        return F.lit(0.0).alias(name)
    return F.coalesce(F.round(F.avg((F.coalesce(F.size(column), F.lit(0)) > 0).cast("int")) * 100, 1), F.lit(0.0)).alias(name)


def benefit_coverage(df: DataFrame, benefits: str = "benefits", categories: str = "benefit_categories") -> DataFrame:
    return df.agg(_filled(df, benefits, "rows_with_benefits_pct"), _filled(df, categories, "rows_with_benefit_categories_pct"))


def place_statistics(df: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """cities, states (the n most frequent), countries, and the share of rows without a city; of the columns that there are."""
    found = {name: analytics.counts(df, column, most) for name, column, most in (("cities", "city", n), ("states", "state", n), ("countries", "country", None)) if column in df.columns}
    if "city" in df.columns:
        found["no_city"] = df.agg(F.coalesce(F.round(F.avg(F.col("city").isNull().cast("int")) * 100, 1), F.lit(0.0)).alias("na_city_pct"))
    return found


def validation_summary(df: DataFrame, flags: str = "validation_flags") -> dict[str, DataFrame]:
    """rows: with and without flags; rules, severities: how often each occurs."""
    some = F.coalesce(F.size(flags), F.lit(0)) > 0
    rows = df.agg(F.count_if(some).alias("rows_with_flags"), F.count_if(~some).alias("rows_clean"), F.coalesce(F.round(F.avg((~some).cast("int")) * 100, 1), F.lit(0.0)).alias("clean_pct"))
    each = df.select(F.explode(flags).alias("f"))
    known = lambda c: F.coalesce(F.col(f"f.{c}"), F.lit("unknown")).alias(c)
    return {"rows": rows, "rules": analytics.counts(each.select(known("rule")), "rule", name="rule"), "severities": analytics.counts(each.select(known("severity")), "severity", name="severity")}


def quality_report(
    df: DataFrame, fields: Sequence[str], *, categoricals: Sequence[str] = (), skills: str | None = None, soft_skills: str | None = None, flags: str | None = None, salary: str | Sequence[str] | None = None,
    benefits: str | None = None, extracted: str | None = None, truncated: str | None = None,
) -> dict[str, DataFrame]:
    """All sections of the report as small tables by name. `extracted` names a column that is NULL where extraction failed, `truncated` a flag of cut descriptions."""
    share = lambda c: F.coalesce(F.round(F.avg(c.cast("int")) * 100, 1), F.lit(0.0))
    summary = [F.count("*").alias("total_rows")]
    if extracted:
        summary.append(share(F.col(extracted).isNotNull()).alias("extraction_coverage_pct"))
    if truncated:
        cut = F.coalesce(F.col(truncated), F.lit(False))
        summary += [share(cut).alias("truncation_rate"), F.count_if(cut).alias("truncated_descriptions")]
    found = {"summary": df.agg(*summary), "coverage": evaluation.field_coverage(df, fields)}
    found["concerns"] = concerns(found["coverage"])
    found |= {f"distribution:{c}": evaluation.distribution(df, c) for c in categoricals}
    if skills:
        found["skills"] = analytics.skill_counts(df, skills, 50, trim=False)
    if soft_skills:
        found["soft_skills"] = analytics.skill_counts(df, soft_skills, 20, trim=False)
    if flags:
        found["flags"] = df.select(F.inline(flags)).groupBy("rule", "severity").agg(F.count("*").alias("n"))
        found |= {f"validation:{k}": t for k, t in validation_summary(df, flags).items()} | {f"hallucination:{k}": t for k, t in hallucination_summary(df, flags).items()}
    if salary:
        found |= {"salary" if isinstance(salary, str) else f"salary:{c}": evaluation.upper_median(df, c) for c in ([salary] if isinstance(salary, str) else salary)}
    if benefits:
        found["benefits"] = benefit_coverage(df, benefits)
    return found | {f"places:{k}": t for k, t in place_statistics(df).items()}


def to_markdown(tables: Mapping[str, DataFrame], *, title: str | None = None, max_rows: int = 1000) -> str:
    """Small tables one below the other. A longer one ends with a line that says so."""
    out: list[str] = [f"# {title}", ""] if title else []
    for name, table in tables.items():
        rows = table.limit(max_rows + 1).collect()
        out += [f"## {name}", "", "| " + " | ".join(table.columns) + " |", "|" + "-|" * len(table.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in rows[:max_rows]]
        out += ["", f"Only the first {max_rows} rows are shown."] if len(rows) > max_rows else []
        out.append("")
    return "\n".join(out)
