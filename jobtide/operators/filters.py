"""Row filters over postings. Comparisons that keep NULL rows do so on purpose."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import ci_contains
from ..functions.numbers import UNKNOWN_DATE, salary_mid
from ..functions.text import strip


def exclude_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows other than `value`; NULL rows stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def exclude_future_dates(df: DataFrame, column: str = "date_posted") -> DataFrame:
    return df.filter(~F.col(column).cast("string").eqNullSafe(F.lit(UNKNOWN_DATE)))


def exclude_other_family(df: DataFrame, column: str = "job_family") -> DataFrame:
    return exclude_value(df, column, "Other")


def equals_ci(df: DataFrame, column: str, value: str) -> DataFrame:
    """Equality blind to case; NULL rows go. Family, seniority, modality, city and state filters are this."""
    return df.filter(F.lower(column) == value.lower())


def filter_remote(df: DataFrame, column: str = "work_modality") -> DataFrame:
    return equals_ci(df, column, "remote")


def filter_description_quality(df: DataFrame, quality: str = "clean", column: str = "description_quality") -> DataFrame:
    return df.filter(F.col(column) == quality)


def filter_salary_known(df: DataFrame, low: str = "salary_min", high: str = "salary_max") -> DataFrame:
    return df.filter(F.col(low).isNotNull() & F.col(high).isNotNull())


def salary_df(df: DataFrame, low: str = "salary_min", high: str = "salary_max") -> DataFrame:
    """Rows with both bounds, with salary_mid."""
    return filter_salary_known(df, low, high).withColumns({low: F.col(low).cast("int"), high: F.col(high).cast("int")}).withColumn("salary_mid", salary_mid(F.col(low), F.col(high)))


def rows_with_skill(df: DataFrame, skill: str, column: str, *, exact: bool = False) -> DataFrame:
    """Rows that list a skill: as a part of the list's text ("java" is in "JavaScript"), or `exact`ly."""
    hit = ci_contains(F.col(column), skill) if exact else F.lower(F.to_json(column)).contains(skill.lower())
    return df.filter(hit)


def explode_list(df: DataFrame, column: str, alias: str = "item") -> DataFrame:
    """One row per element that is neither NULL nor empty."""
    return df.withColumn(alias, F.explode(column)).filter(F.col(alias).isNotNull() & (F.col(alias) != ""))


def explode_flags(df: DataFrame, id_col: str = "row_id", column: str = "validation_flags") -> DataFrame:
    return df.select(id_col, F.inline(column))


def drop_flagged(df: DataFrame, flags: Iterable[str] = ("privacy_wall", "invalid_url"), column: str = "input_flags") -> DataFrame:
    return df.filter(~F.coalesce(F.arrays_overlap(column, F.array(*map(F.lit, flags))), F.lit(False)))


def flag_counts(df: DataFrame, flags: Iterable[str], column: str = "input_flags") -> DataFrame:
    return df.agg(*[F.count_if(F.array_contains(column, f)).alias(f) for f in flags])


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Without rows that are blank in a column; NULL stays."""
    return df.filter(F.col(column).isNull() | (strip(F.col(column)) != ""))


def not_before(df: DataFrame, column: str, cutoff: str, *, keep_null: bool = True) -> DataFrame:
    late = F.col(column) >= F.lit(cutoff).cast(df.schema[column].dataType)
    return df.filter(late | F.col(column).isNull() if keep_null else late)


def multi_filter(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Each named column is one of a comma-separated list; an empty list asks for nothing; NULL fails an active one."""
    for column, values in wanted.items():
        chosen = [v.strip() for v in values.split(",") if v.strip()]
        if chosen:
            df = df.filter(F.col(column).isin(*chosen))
    return df


JUNIOR, SENIOR = ("Junior",), ("Senior", "Lead", "Director", "C-Level")


def personas(seniority: str = "seniority", years: str = "experience_years", modality: str = "work_modality", education: str = "education_level") -> dict[str, Column]:
    """Boolean Columns of the dashboard's personas, NULL-safe."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    junior = yes(F.col(seniority).isin(*JUNIOR)) | (F.col(seniority).isNull() & yes(F.col(years) < 3))
    return {
        "junior": junior,
        "senior": yes(F.col(seniority).isin(*SENIOR)),
        "remote": yes(F.lower(modality) == "remote"),
        "career_changer": junior & yes(F.col(education).isin("Vocational", "Bachelor", "Degree")),
    }


def guide_personas(seniority: str = "seniority", family: str = "job_family") -> dict[str, Column]:
    """The job seeker guide's own definitions."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return {"junior": yes(F.col(seniority) == "Junior"), "senior": yes(F.col(seniority).isin("Senior", "Lead")), "career_changer": yes(F.col(family) == "Other")}


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the table is empty")
    return df
