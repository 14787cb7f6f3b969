"""Cleaning and enrichment of merged postings, and the invariants of a finished table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import ci_distinct, parse_list
from ..functions.numbers import experience, salary
from ..functions.text import SENTINELS, let, strip
from ..functions.titles import GENDER_PAREN, strip_residual_gender

# Ordered categories with the lower-case parts that name them; the first that matches wins.
BENEFITS: dict[str, tuple[str, ...]] = {
    "time_off": ("urlaub", "vacation", "holiday", "pto", "days off", "paid time", "sabbatical", "sonderurlaub", "freistellung", "freizeitausgleich"),
    "flexible_hours": ("flexible", "gleitzeit", "flexitime", "arbeitszeitmodell", "vertrauensarbeitszeit", "flexible arbeitszeit", "teilzeit", "work-life", "worklife", "4-tage", "four-day", "4 day week"),
    "remote_work": ("remote", "homeoffice", "home office", "telearbeit", "mobiles arbeiten", "work from home", "hybrid", "ortsunabhängig"),
    "retirement": ("rente", "pension", "altersvorsorge", "betriebliche altersvorsorge", "bav", "vermögenswirksam", "vwl", "zukunftssicherung"),
    "health": ("health", "kranken", "wellness", "gym", "sport", "gesundheit", "fitness", "mental health", "ergonomie", "massage", "betriebsarzt", "yoga", "meditation"),
    "mobility": ("bahncard", "jobticket", "dienstwagen", "company car", "bike", "fahrrad", "mvv", "öpnv", "jobrad", "deutschlandticket", "firmenwagen", "fahrkostenzuschuss", "fahrtkostenzuschuss", "mobility budget", "leasing"),
    "education": ("weiterbildung", "schulung", "training", "certification", "konferenz", "conference", "learning", "fortbildung", "mentoring", "coaching", "development budget", "udemy", "coursera", "bildungsurlaub", "personal development"),
    "compensation": ("bonus", "prämie", "provision", "gewinnbeteiligung", "aktien", "stock", "esop", "mitarbeiterbeteiligung", "weihnachtsgeld", "urlaubsgeld", "13. gehalt", "13. monatsgehalt", "sonderzahlung", "equity", "rsus", "profit sharing"),
    "food": ("kantine", "canteen", "lunch", "mittagessen", "verpflegung", "essenszuschuss", "meal", "obstkorb", "getränke", "kaffee", "snack", "catering"),
    "social": ("team event", "teamevent", "offsite", "firmenfeier", "team building", "teambuilding", "sommerfest", "weihnachtsfeier", "firmenevent", "betriebsausflug", "after-work", "afterwork"),
    "perks": ("laptop", "equipment", "ausstattung", "handy", "phone", "stellplatz", "parkplatz", "parking", "rabatt", "discount", "corporate benefits", "mitarbeiterrabatt", "zuschuss", "kindergarten", "kinderbetreuung", "kita", "relocation", "umzug", "hund", "dog-friendly", "hundefreundlich"),
}
SOFT_SKILLS: dict[str, tuple[str, ...]] = {
    "Communication": ("kommunikation", "communication", "präsentation", "presentation", "verhandlung"),
    "Teamwork": ("team", "zusammenarbeit", "collaboration", "kooperation"),
    "Problem Solving": ("problemlösung", "problem solving", "analytisch", "analytical"),
    "Initiative": ("initiative", "eigenverantwortlich", "selbständig", "proaktiv", "proactive"),
    "Structured Work": ("strukturiert", "structured", "organisiert", "organized", "sorgfältig"),
    "Leadership": ("führung", "leadership", "mentoring", "coaching"),
    "Adaptability": ("flexibel", "flexible", "anpassungsfähig", "adaptable"),
    "Customer Focus": ("kundenorientiert", "customer", "service"),
}
CONTRACT_TYPES = ("Full-time", "Part-time", "Freelance", "Permanent", "Contract", "Working Student", "Internship")


def _has(c: Column, parts: Sequence[str]) -> Column:
    return c.rlike("|".join(p.replace(".", r"\.") for p in parts))


def standardize_missing(df: DataFrame, lists: Sequence[str] = (), strings: Sequence[str] = ()) -> DataFrame:
    """Lists without blanks and repeats (blind to case), strings stripped, sentinels NULL."""
    one = {c: ci_distinct(F.col(c) if df.schema[c].dataType.typeName() == "array" else parse_list(F.col(c))) for c in lists}
    text = {c: F.when(~strip(F.col(c)).isin(*SENTINELS), strip(F.col(c))) for c in strings}
    return df.withColumns(one | text) if one or text else df


def fix_numeric(df: DataFrame, salaries: Sequence[str] = ("salary_min", "salary_max"), years: str | None = "experience_years") -> DataFrame:
    return df.withColumns({c: salary(F.col(c)) for c in salaries} | ({years: experience(F.col(years))} if years else {}))


def remap(df: DataFrame, column: str, mapping: Mapping[str, str], *, valid: Sequence[str] | None = None, other: str = "Other") -> DataFrame:
    """Values through a map; with `valid`, what is then unknown becomes `other`. NULL stays."""
    value = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in mapping.items() for x in p]), F.col(column)), F.col(column)) if mapping else F.col(column)
    if valid is not None:
        value = F.when(value.isNull() | value.isin(*valid), value).otherwise(other)
    return df.withColumn(column, value)


def fix_company(df: DataFrame, column: str = "company_name") -> DataFrame:
    return df.withColumn(column, F.when(~strip(F.col(column)).isin(*SENTINELS), F.col(column)))


def fix_residual_gender(df: DataFrame, column: str = "title") -> DataFrame:
    return df.withColumn(column, strip_residual_gender(F.col(column)))


def fix_flags(c: Column) -> Column:
    """Validation flags in JSON or Python notation as a JSON list; anything else an empty one."""
    jsonish = F.replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false"), F.lit("'"), F.lit('"'))
    is_list = lambda x: F.coalesce(F.json_array_length(x), F.lit(-1)) >= 0
    return F.when(is_list(c), c).when(is_list(jsonish), jsonish).otherwise("[]")


def benefit_category(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(*[F.when(_has(low, parts), name) for name, parts in BENEFITS.items()], F.lit("other"))


def benefit_categories(c: Column) -> Column:
    """Sorted categories of a list's elements. The parts that name them are sought once in the whole list, elements are read only for those that are there."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(name).alias("name")) for name, every in BENEFITS.items() for p in every])

    def named(low: Column) -> Column:
        # no part holds a line break, so none spans two elements; an element's first part in the order of categories names it
        present = let(F.array_join(low, "\n"), lambda whole: F.filter(parts, lambda p: whole.contains(p["part"])))
        each = lambda there: F.transform(low, lambda x: F.coalesce(F.get(F.filter(there, lambda p: x.contains(p["part"])), F.lit(0))["name"], F.lit("other")))
        return let(present, lambda there: F.when(F.size(there) > 0, F.array_sort(F.array_distinct(each(there)))).when(F.size(low) > 0, F.array(F.lit("other"))).when(low.isNotNull(), F.array().cast("array<string>")))

    return let(F.transform(c, F.lower), named)


def soft_skill_categories(c: Column) -> Column:
    """All categories of a list's elements, sorted; language knowledge ('...kenntnisse') is no soft skill."""
    kept = F.filter(c, lambda x: ~F.lower(x).endswith("kenntnisse"))
    named = F.transform(kept, lambda x: F.array_compact(F.array(*[F.when(_has(F.lower(x), parts), name) for name, parts in SOFT_SKILLS.items()])))
    return F.array_sort(F.array_distinct(F.flatten(named)))


def invariants(df: DataFrame, *, id_col: str, categoricals: Sequence[str] = (), enums: Mapping[str, Sequence[str]] | None = None, json_lists: Sequence[str] = (), low: str | None = None, high: str | None = None, company: str | None = None, title: str | None = None, lists: Sequence[str] = ()) -> DataFrame:
    """rule, violations: all rules in one pass over the rows."""
    checks: dict[str, Column] = {f"blank:{c}": F.count_if(strip(F.col(c)) == "") for c in categoricals}
    checks |= {f"enum:{c}": F.count_if(~F.col(c).isin(*values)) for c, values in (enums or {}).items()}
    checks |= {f"json:{c}": F.count_if(F.col(c).isNotNull() & (F.coalesce(F.json_array_length(c), F.lit(-1)) < 0)) for c in json_lists}
    if low and high:
        checks["salary_order"] = F.count_if(F.col(low) > F.col(high))
    checks["unique:" + id_col] = F.count(id_col) - F.countDistinct(id_col)
    if company:
        checks["sentinel:" + company] = F.count_if(strip(F.col(company)).isin(*SENTINELS))
    if title:
        checks["gender:" + title] = F.count_if(F.col(title).rlike(GENDER_PAREN))
    for c in lists:
        checks[f"repeat:{c}"] = F.count_if(F.size(F.array_distinct(F.transform(c, F.lower))) < F.size(c))
        checks[f"blank_item:{c}"] = F.count_if(F.exists(c, lambda x: strip(x) == ""))
    counted = df.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(str(k)) for k, v in enumerate(checks.values())])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(str(k)).alias("violations")) for k, n in enumerate(checks)])))


def assert_invariants(df: DataFrame, **rules) -> DataFrame:
    broken = [f"{r['rule']}: {r['violations']}" for r in invariants(df, **rules).filter("violations > 0").collect()]
    if broken:
        raise ValueError("; ".join(broken))
    return df


# Columns of the finished table, in order.
FINAL_COLUMNS = (
    "row_id job_url site title company_name city state date_posted contract_type work_modality salary_min salary_max experience_years seniority education_level languages job_family job_summary "
    "technical_skills soft_skills nice_to_have_skills benefits tasks benefit_categories soft_skill_categories description_quality validation_flags description title_original"
).split()
HEAVY_COLUMNS = ("description", "job_summary", "tasks", "validation_flags")
DROPPED_COLUMNS = ("country", "location", "source_file")


def reorder(df: DataFrame, columns: Sequence[str] = FINAL_COLUMNS) -> DataFrame:
    """Known columns first and in order, others behind them."""
    return df.select(*[c for c in columns if c in df.columns], *[c for c in df.columns if c not in columns])


def light(df: DataFrame) -> DataFrame:
    return df.drop(*HEAVY_COLUMNS)
