"""Numbers and dates out of text, as Column expressions that never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import null_if_sentinel, strip

SALARY_FLOOR, SALARY_CEILING = 10_000, 300_000
MAX_EXPERIENCE = 10
UNKNOWN_DATE = "2027-01-01"


def german_int(c: Column) -> Column:
    """'50.000' is 50000; other text than digits with points between thousands is NULL."""
    text = strip(c)
    return F.when(text.rlike(r"^\d+(?:\.\d{3})*(?:,\d+)?$"), F.replace(F.regexp_replace(text, r",\d+$", ""), F.lit("."), F.lit(""))).try_cast("int")


def to_int(c: Column) -> Column:
    """Integers, decimals such as '3.0' and German thousands; NULL for anything else."""
    text = strip(c.cast("string"))
    plain = F.when(text.rlike(r"^[+-]?\d+(?:\.0*)?$"), text).try_cast("double").cast("int")
    return F.coalesce(german_int(F.when(text.rlike(r"^\d{1,3}(?:\.\d{3})+$"), text)), plain, F.when(text.rlike(r"^[+-]?\d+\.\d+$"), text).try_cast("double").cast("int"))


def salary(c: Column) -> Column:
    """An annual salary, or NULL outside the plausible range."""
    v = to_int(c)
    return F.when(v.between(SALARY_FLOOR, SALARY_CEILING), v)


def experience(c: Column) -> Column:
    v = to_int(c)
    return F.when(v <= MAX_EXPERIENCE, v)


def salary_mid(low: Column, high: Column) -> Column:
    """Floor of the mean of two integer bounds."""
    return F.floor((low.cast("long") + high.cast("long")) / 2).cast("long")


def round_half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("long")


def format_pct(n: Column) -> Column:
    """Shares up to one are percentages to be."""
    return F.when(n > 1, n).otherwise(n * 100)


def posted_date(value: Column, reference: Column) -> Column:
    """An exact ISO date from ISO text, epochs, and phrases such as 'yesterday' or '3 weeks ago', else NULL.

    ISO-prefixed text passes as it is, unvalidated: validity is checked by a later rule.
    """
    text = strip(null_if_sentinel(value, trimmed=True))
    low = F.lower(text)
    digits = F.when(text.rlike(r"^\d+$"), text).try_cast("double")
    epoch = F.when(digits.isNotNull(), F.timestamp_seconds(F.when(digits > 1e12, digits / 1000).otherwise(F.least(digits, F.lit(1e12)))))
    n = F.regexp_extract(low, r"(\d+)\s*\+?\s*(?:hour|day|week|month|minute)s?\s+ago", 1).try_cast("int")
    unit = F.regexp_extract(low, r"\d+\s*\+?\s*(hour|day|week|month|minute)s?\s+ago", 1)
    days = F.when(unit.isin("hour", "minute"), 0).when(unit == "day", n).when(unit == "week", n * 7).when(unit == "month", n * 30)
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10))
        .when(digits.isNotNull(), iso(epoch))
        .when(low.rlike("today|just now|just posted"), iso(reference))
        .when(low.contains("yesterday"), iso(F.date_sub(reference, 1)))
        .when(days.isNotNull(), iso(F.date_sub(reference, days)))
    )


def any_date(c: Column) -> Column:
    """A DATE from ISO, German or US notation, NULL if it is none of them."""
    return F.coalesce(*[F.try_to_timestamp(F.when(c.rlike(p), c), F.lit(f)).cast("date") for p, f in ((r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))])
