"""Job titles: gender markers, gendered endings, casing, translation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squeeze, strip

_SLASHED = r"(?<![A-Za-z0-9])[mwfdxip*]{1,3}(?:[/|*][mwfdxip*]{1,3})+(?![A-Za-z0-9])"
GENDER_PAREN = rf"(?iU)\([^)]*(?:{_SLASHED}|all\s+genders?|alle\s+geschlechter|\bmwd\b)[^)]*\)|\(\s*gn\s*\)|\(\s*[mwfxdi*],[mwfxdi*],[mwfd]\s*\)"
IN_SUFFIX = r"(?iU)(?<=[A-Za-z\x{00C0}-\x{024F}])[/*:]+-?in\b"
TRAILING_DASH = r"(?U)[\s\x{2013}\x{2014}-]+$"

# German titles and what they are called in English. Feminine forms in -in follow by rule.
TRANSLATIONS = {
    "Softwareentwickler": "Software Developer", "Webentwickler": "Web Developer", "Fachinformatiker": "IT Specialist", "Systemadministrator": "System Administrator",
    "Netzwerkadministrator": "Network Administrator", "Datenbankadministrator": "Database Administrator", "Projektingenieur": "Project Engineer", "Projektleiter": "Project Manager",
    "Abteilungsleiter": "Department Manager", "Teamleiter": "Team Lead", "Gruppenleiter": "Group Lead", "Auszubildende": "Apprentice", "Auszubildender": "Apprentice", "Entwickler": "Developer",
    "Ingenieur": "Engineer", "Architekt": "Architect", "Berater": "Consultant", "Leiter": "Lead", "Werkstudent": "Working Student", "Praktikant": "Intern", "Informatiker": "Computer Scientist",
    "Analytiker": "Analyst", "Wissenschaftler": "Scientist", "Forscher": "Researcher", "Tester": "Tester", "Designer": "Designer",
}
NO_FEMININE = ("Auszubildende", "Auszubildender")


def translations() -> dict[str, str]:
    return TRANSLATIONS | {de + "in": en for de, en in TRANSLATIONS.items() if de not in NO_FEMININE}


def strip_gender_parens(c: Column) -> Column:
    return F.regexp_replace(c, GENDER_PAREN, "")


def strip_in_suffix(c: Column) -> Column:
    return F.regexp_replace(c, IN_SUFFIX, "")


def strip_trailing_dash(c: Column) -> Column:
    return strip(F.regexp_replace(c, TRAILING_DASH, ""))


def title_case(c: Column) -> Column:
    """Each run of letters capitalised, as words of a title are (initcap() sees spaces only)."""
    runs = F.regexp_extract_all(c, F.lit(r"(?U)(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def fix_allcaps(c: Column) -> Column:
    letters = F.regexp_replace(c, r"(?U)\P{L}+", "")
    return F.when((F.length(letters) > 3) & (letters == F.upper(letters)), title_case(c)).otherwise(c)


def normalize_title(c: Column) -> Column:
    """Markers, endings, dashes and casing; NULL and blank pass through."""
    cleaned = fix_allcaps(squeeze(strip_trailing_dash(strip_in_suffix(strip_gender_parens(c)))))
    return F.when(strip(c) == "", c).otherwise(cleaned)


def translate_title(c: Column) -> Column:
    """Whole German words to English, the longest first."""
    for de, en in sorted(translations().items(), key=lambda x: -len(x[0])):
        c = F.regexp_replace(c, rf"(?iU)\b{de}\b", en)
    return c


def strip_residual_gender(c: Column) -> Column:
    """Markers that are left anywhere in a title; NULL stays NULL."""
    return squeeze(F.regexp_replace(strip_gender_parens(c), r"(?iU)(?<![\p{L}\d])[mwfdx](?:[/|][mwfdx]){1,3}(?![\p{L}\d])", ""))
