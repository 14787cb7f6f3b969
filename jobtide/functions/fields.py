"""Posting fields by pattern: contract, modality, salary, experience, seniority, languages, education.

Patterns are Unicode-aware and blind to case, as (?iU) says to Java.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let
from .numbers import SALARY_CEILING, SALARY_FLOOR
from .text import strip_markdown_escapes, unescape_entities

# Patterns with their field value, the first that matches wins.
CONTRACT = [
    (r"\bVollzeit\b|\bfull[- ]?time\b|\bFestanstellung\b", "Full-time"),
    (r"\bTeilzeit\b|\bpart[- ]?time\b", "Part-time"),
    (r"\bFreelance\b|\bfreelancer\b|\bFreiberufler\b", "Freelance"),
    (r"\bunbefristet(?:e[rsnm]?)?\b", "Permanent"),
    (r"\bContractor\b|\bAuftragnehmer\b|(?<!un)\bbefristet(?:e[rsnm]?)?\b", "Contract"),
    (r"\bWerkstudent(?:in)?\b", "Working Student"),
    (r"\bPraktik(?:um|ant(?:in)?)\b", "Internship"),
]
MODALITY = [
    (r"\bHybrid", "Hybrid"),
    (r"\bmobile[snmr]?\s+Arbeiten\b", "Hybrid"),
    (r"\bflexible[rns]?\s+Arbeitsort", "Hybrid"),
    (r"\bRemote\b|\bHome\s*Office\b|\bHomeoffice\b", "Remote"),
    (r"\bvor\s+Ort\b|\bon[- ]?site\b|\bOnsite\b|\bPräsenz", "On-site"),
]
EDUCATION = [
    (r"\bPromotion\b|\bPh\.?D\.?\b|\bDoktor", "PhD"),
    (r"\bMaster\b|\bM\.?\s?Sc\.?\b|\bDiplom", "Master"),
    (r"\bBachelor\b|\bB\.?\s?Sc\.?\b", "Bachelor"),
    (r"\bStudium\b|\bHochschulabschluss\b|\bdegree\b", "Degree"),
    (r"\bAusbildung\b|\bBerufsausbildung\b", "Vocational"),
]
SENIORITY = [
    ("Chief", "C-Level"), ("CTO", "C-Level"), ("CIO", "C-Level"), ("Vice President", "Director"), ("Director", "Director"), ("VP", "Director"), ("Head of", "Lead"), ("Principal", "Lead"), ("Staff", "Lead"),
    ("Tech Lead", "Lead"), ("Team Lead", "Lead"), ("Teamlead", "Lead"), ("Teamleiter", "Lead"), ("Lead", "Lead"), ("Senior", "Senior"), ("Junior", "Junior"), ("Trainee", "Junior"), ("Werkstudent", "Junior"),
    ("Werkstudentin", "Junior"), ("Intern", "Junior"), ("Praktikant", "Junior"), ("Praktikantin", "Junior"),
]
# Patterns of pay, experience and languages, and the names of levels.
SALARY_RANGE = r"(?iU)(\d{1,3}(?:\.\d{3})*)(?:,\d{2})?\s*(?:€|EUR|Euro)?\s*(?:bis|to|-|–|und|bis\s+zu)\s*(\d{1,3}(?:\.\d{3})*)(?:,\d{2})?\s*(?:€|EUR|Euro)"
SALARY_SINGLE = r"(?iU)(?:ab|bis\s+zu|from|up\s+to)?\s*(\d{1,3}(?:\.\d{3})+)(?:,\d{2})?\s*(?:€|EUR|Euro)"
SALARY_K_RANGE = r"(?U)€\s*(\d{2,4})\s*[kK]\s*(?:bis|to|-|–)\s*€?\s*(\d{2,4})\s*[kK]"
SALARY_K_SINGLE = r"(?U)€\s*(\d{2,4})\s*[kK]"
NOT_SALARY = r"(?iU)\b(?:Mitarbeiter|Kunden|Standorte|Bewerber|Kollegen|Beschäftigte|employees|users|customers)\b|/\s*Monat|pro\s+Monat|mtl|monthly|/\s*month"
EXPERIENCE = r"(?iU)(\d+)\+?\s*(?:Jahre?|years?)\s+(?:Berufserfahrung|Erfahrung|experience)"
EXPERIENCE_LEAST = r"(?iU)(?:mindestens|at\s+least|min\.?)\s*(\d+)\s*(?:Jahre?|years?)"
EXPERIENCE_WORDS = r"(?iU)\b(Mehrjährige|Langjährige|Erste|Einschlägige)\w*\s+(?:Berufs)?(?:erfahrung|Praxiserfahrung)\b"
EXPERIENCE_YEARS = {"mehrjährige": 3, "langjährige": 5, "erste": 1, "einschlägige": 3}
# Pattern, groups with a language, group with a level (0: required).
LANGUAGES = [
    (r"\b(Deutsch|Englisch|Fran[cç]ösisch|German|English|French)\s+(A1|A2|B1|B2|C1|C2)\b", (1,), 2),
    (r"\b(A1|A2|B1|B2|C1|C2)\s+(Deutsch|Englisch|Fran[cç]ösisch|German|English|French)\b", (2,), 1),
    (r"\b(fließend|fluent|verhandlungssicher|muttersprachlich|native)(?:e[rsnm]?)?\s+(?:in\s+)?(Deutsch|Englisch|Fran[cç]ösisch|German|English|French)(?:kenntnisse|sprachkenntnisse)?\b", (2,), 1),
    (r"\b(Deutsch|Englisch|Fran[cç]ösisch)(?:kenntnisse|sprachkenntnisse)\b", (1,), 0),
    (r"\b(Deutsch|Englisch|Fran[cç]ösisch)-?\s+und\s+(Deutsch|Englisch|Fran[cç]ösisch)(?:kenntnisse|sprachkenntnisse)\b", (1, 2), 0),
    (r"\b(?:sehr\s+)?(?:gute|sichere|solide)[rsnm]?\s+(Deutsch|Englisch|Fran[cç]ösisch|German|English|French)(?:kenntnisse|sprachkenntnisse)?\b", (1,), 0),
]
LANGUAGE_NAMES = {"english": "English", "englisch": "English", "deutsch": "German", "german": "German", "französisch": "French", "francösisch": "French", "french": "French"}
LEVEL_NAMES = {"fließend": "B2+", "fluent": "B2+", "verhandlungssicher": "C1+", "muttersprachlich": "C2", "native": "C2"}
LEVELS = ("required", "A1", "A2", "B1", "B2", "B2+", "C1", "C1+", "C2")
BOILERPLATE = r"(?iU)equal\s+opportunity|diversity|inclusive|chancengleichheit|vielfalt|diskriminierung|unabhängig\s+von|regardless\s+of|freuen\s+uns\s+auf\s+(?:Ihre|deine|alle)\b|welcome\s+applications?\b"


# For each pattern above what its matches begin with, in lower case. Texts are searched for these parts, which is many times
# cheaper, before a pattern is tried, from the first of them on. A sign that begins with (?U) is a pattern with plain letters in front.
CONTRACT_SIGNS = [("vollzeit", "fulltime", "full time", "full-time", "festanstellung"), ("teilzeit", "parttime", "part time", "part-time"), ("freelance", "freiberufler"), ("unbefristet",), ("contractor", "auftragnehmer", "befristet"), ("werkstudent",), ("praktik",)]
MODALITY_SIGNS = [("hybrid",), ("mobile",), ("flexible",), ("remote", "home"), (r"(?U)vor\s+ort", "onsite", "on site", "on-site", "präsenz")]
EDUCATION_SIGNS = [("promotion", "phd", "ph.d", "doktor"), ("master", r"(?U)m\.?\s?sc", "diplom"), ("bachelor", r"(?U)b\.?\s?sc"), ("studium", "hochschulabschluss", "degree"), ("ausbildung", "berufsausbildung")]
LANGUAGE_SIGNS = ("deutsch", "englisch", "francösisch", "françösisch", "german", "english", "french")
EXPERIENCE_SIGNS = ("jahr", "year")
EXPERIENCE_LEAST_SIGNS = ("min", r"(?U)at\s+least")
EXPERIENCE_WORD_SIGNS = ("erfahrung",)
#: Every pattern of pay has an amount beside a sign of euros.
PAY_SIGNS, PAY_SIGN = ("€", "eur"), r"(?U)\d\s*(?:€|eur)|€\s*\d"


def folded(c: Column) -> Column:
    """Lower case as patterns that are blind to case see it: four letters beyond ASCII count as s, i and k there."""
    return F.lower(F.when(holds(c, tuple("\u017f\u0130\u0131\u212a")), F.translate(c, "\u017f\u0130\u0131\u212a", "siik")).otherwise(c))


def holds(text: Column, signs: tuple[str, ...]) -> Column:
    one = lambda s: text.contains(re.match("[a-z]+", s[4:])[0]) & text.rlike(s) if s.startswith("(?U)") else text.contains(s)
    return reduce(lambda a, b: a | b, map(one, signs))


#: Characters before a sign that a pattern may look at.
_BEFORE = 100


def from_sign(c: Column, low: Column, signs: tuple[str, ...]) -> Column:
    """The text from a little before its first sign on. Folding keeps the number of characters."""
    none = F.length(c) + 1
    at = lambda s: F.length(F.get(F.split(low, s, 2), F.lit(0))) + 1 if s.startswith("(?U)") else F.pmod(F.instr(low, s) - 1, F.lit(1 << 30)) + 1
    first = F.least(none, *map(at, signs))
    return F.substring(c, F.greatest(F.lit(1), first - _BEFORE), F.length(c))


def first_match(c: Column, patterns: list[tuple[str, str]], signs: list[tuple[str, ...]] | None = None, low: Column | None = None) -> Column:
    """Value of the first pattern that the text has; NULL if none. A pattern is tried only where the text, `low` in its folded form, has one of its signs."""
    low = folded(c) if low is None else low
    return F.coalesce(*[F.when((holds(low, signs[k]) & from_sign(c, low, signs[k]).rlike("(?iU)" + p)) if signs else c.rlike("(?iU)" + p), v) for k, (p, v) in enumerate(patterns)])


def contract_type(description: Column, title: Column) -> Column:
    return F.coalesce(first_match(description, CONTRACT, CONTRACT_SIGNS), first_match(title, CONTRACT, CONTRACT_SIGNS))


def work_modality(description: Column, title: Column) -> Column:
    return F.coalesce(first_match(description, MODALITY, MODALITY_SIGNS), first_match(title, MODALITY, MODALITY_SIGNS))


def education_level(description: Column, low: Column | None = None) -> Column:
    return first_match(description, EDUCATION, EDUCATION_SIGNS, low)


def seniority(title: Column) -> Column:
    return first_match(title, [(rf"\b{k}\b", v) for k, v in SENIORITY])


def _amount(text: Column, pattern: str, group: int) -> Column:
    return F.replace(F.regexp_extract(text, pattern, group), F.lit("."), F.lit("")).try_cast("int")


def _salary_context(d: Column, found: Column) -> Column:
    """The first match, whose text is `found`, stands apart from head counts and monthly pay by 50 characters."""
    at, size = F.instr(d, found), F.length(found)
    start = F.greatest(F.lit(1), at - 50)
    return ~F.substring(d, start, at + size + 50 - start).rlike(NOT_SALARY)


def salary_range(d: Column, low: Column | None = None) -> Column:
    """STRUCT<low, high> by four patterns in turn, each judged by its first match; NULLs if none holds.

    Texts without an amount beside a sign of euros are not searched; each pattern is searched once, and its groups are read from the match.
    """
    none = F.struct(F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    low = folded(d) if low is None else low
    return F.when(holds(low, PAY_SIGNS) & low.rlike(PAY_SIGN), _salary_of(d)).otherwise(none)


def _salary_of(d: Column) -> Column:
    found = F.struct(*[F.regexp_substr(d, F.lit(p)).alias(n) for n, p in (("range", SALARY_RANGE), ("one", SALARY_SINGLE))], *[F.regexp_substr(d, F.lit(p)).alias(n) for n, p in (("k_range", SALARY_K_RANGE), ("k_one", SALARY_K_SINGLE))])

    def numbers(m: Column) -> Column:
        return F.struct(
            m.alias("m"), _amount(m["range"], SALARY_RANGE, 1).alias("lo"), _amount(m["range"], SALARY_RANGE, 2).alias("hi"), _amount(m["one"], SALARY_SINGLE, 1).alias("one"),
            (_amount(m["k_range"], SALARY_K_RANGE, 1) * 1000).alias("klo"), (_amount(m["k_range"], SALARY_K_RANGE, 2) * 1000).alias("khi"), (_amount(m["k_one"], SALARY_K_SINGLE, 1) * 1000).alias("kone"),
        )

    return let(found, lambda m: let(numbers(m), lambda v: _salary_choice(d, v)))


def _salary_choice(d: Column, v: Column) -> Column:
    inside = lambda v: v.between(SALARY_FLOOR, SALARY_CEILING)
    pair = lambda lo, hi: F.struct(lo.alias("low"), hi.cast("int").alias("high"))
    lo, hi, one, klo, khi, kone = (v[n] for n in ("lo", "hi", "one", "klo", "khi", "kone"))
    none = F.lit(None).cast("int")
    return (
        F.when(inside(lo) & inside(hi) & (lo <= hi) & _salary_context(d, v["m"]["range"]), pair(lo, hi))
        .when(inside(one) & _salary_context(d, v["m"]["one"]), pair(one, none))
        .when(inside(klo) & inside(khi) & (klo <= khi), pair(klo, khi))
        .when(inside(kone), pair(kone, none))
        .otherwise(pair(none, none))
    )


def experience_years(d: Column, low: Column | None = None) -> Column:
    low = folded(d) if low is None else low
    years = lambda p, text: F.when(holds(low, EXPERIENCE_SIGNS), F.regexp_extract(text, p, 1).try_cast("int"))
    least = F.when(holds(low, EXPERIENCE_LEAST_SIGNS), years(EXPERIENCE_LEAST, from_sign(d, low, EXPERIENCE_LEAST_SIGNS)))
    word = F.lower(F.regexp_extract(d, EXPERIENCE_WORDS, 1))
    named = reduce(lambda e, kv: e.when(word == kv[0], kv[1]), EXPERIENCE_YEARS.items(), F.when(F.lit(False), 0))
    return F.coalesce(years(EXPERIENCE, d), least, F.when(holds(low, EXPERIENCE_WORD_SIGNS), named))


def _named(c: Column, names: dict[str, str], other: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.lower(c)), other)


def languages(d: Column, low: Column | None = None) -> Column:
    """ARRAY<STRUCT<language, level>>, one per language with its highest level, sorted.

    The place of the n-th match of a pattern is the length of what splitting by it leaves before, and of the matches themselves;
    matches with diversity or greeting phrases within 200 characters do not count.
    """
    none = F.array().cast("array<struct<language:string,level:string>>")
    low = folded(d) if low is None else low
    return F.when(holds(low, LANGUAGE_SIGNS), let(F.concat(*[_mentions(d, p, g, level) for p, groups, level in LANGUAGES for g in groups]), _best_levels)).otherwise(none)


def _mentions(d: Column, pattern: str, group: int, level: int) -> Column:
    """ARRAY<STRUCT<language, rank>> of one group of one pattern."""
    p = F.lit("(?iU)" + pattern)
    size = lambda xs, n: F.aggregate(F.slice(xs, 1, n), F.lit(0), lambda a, x: a + F.length(x))
    # a group of a match is read from the match itself
    found = F.struct(F.regexp_extract_all(d, p, F.lit(0)).alias("whole"), F.split(d, "(?iU)" + pattern, -1).alias("rest"))

    def hits(m: Column) -> Column:
        def hit(w: Column, i: Column) -> Column:
            at = size(m["rest"], i + 1) + size(m["whole"], i)
            start = F.greatest(F.lit(0), at - 200)
            around = F.substring(d, start + 1, at + 200 - start)
            lang, own = F.regexp_extract(w, "(?iU)" + pattern, group), F.regexp_extract(w, "(?iU)" + pattern, level) if level else None
            name = _named(lang, LANGUAGE_NAMES, F.initcap(lang))
            rank = _named(own, LEVEL_NAMES, F.upper(own)) if level else F.lit("required")
            return F.when(~around.rlike(BOILERPLATE), F.struct(name.alias("language"), F.array_position(F.array(*map(F.lit, LEVELS)), rank).cast("int").alias("rank")))

        return F.filter(F.transform(m["whole"], hit), lambda x: x.isNotNull())

    nothing = F.array().cast("array<struct<language:string,rank:int>>")
    return F.when(d.rlike("(?iU)" + pattern), let(found, hits)).otherwise(nothing)


def _best_levels(every: Column) -> Column:
    names = F.array_sort(F.array_distinct(F.transform(every, lambda x: x["language"])))
    best = lambda n: F.array_max(F.transform(F.filter(every, lambda x: x["language"] == n), lambda x: x["rank"]))
    return F.transform(names, lambda n: F.struct(n.alias("language"), F.element_at(F.array(*map(F.lit, LEVELS)), best(n)).alias("level")))


def description_parts(description: Column) -> dict[str, Column]:
    """What all fields of a description read: the text without escapes and its folded form. As columns of a step before they are computed once a row."""
    d = strip_markdown_escapes(F.coalesce(description, F.lit("")))
    return {"_text": d, "_low": folded(d)}


def description_fields(description: Column | None = None) -> dict[str, Column]:
    """What the description alone says; two of the fields fall back on the title. Without one, the fields read the columns of `description_parts`."""
    d, low = (F.col("_text"), F.col("_low")) if description is None else description_parts(description).values()
    pay = salary_range(d, low)
    return {
        "regex_contract_type": first_match(d, CONTRACT, CONTRACT_SIGNS, low), "regex_work_modality": first_match(d, MODALITY, MODALITY_SIGNS, low), "regex_salary_min": pay["low"], "regex_salary_max": pay["high"],
        "regex_experience_years": experience_years(d, low), "regex_languages": languages(d, low), "regex_education_level": education_level(d, low),
    }


def title_fields(title: Column, *, unescape: bool = True) -> dict[str, Column]:
    """What the title alone says. The cleaned title is computed once for each of the fields."""
    t = F.coalesce(title, F.lit(""))
    t = strip_markdown_escapes(unescape_entities(t) if unescape else t)
    return {"regex_contract_type": let(t, lambda x: first_match(x, CONTRACT, CONTRACT_SIGNS)), "regex_work_modality": let(t, lambda x: first_match(x, MODALITY, MODALITY_SIGNS)), "regex_seniority_from_title": let(t, seniority)}


def regex_fields(description: Column, title: Column, *, unescape: bool = True) -> dict[str, Column]:
    """The eight regex_* columns of a posting."""
    own, named = description_fields(description), title_fields(title, unescape=unescape)
    return {
        "regex_contract_type": F.coalesce(own["regex_contract_type"], named["regex_contract_type"]), "regex_work_modality": F.coalesce(own["regex_work_modality"], named["regex_work_modality"]),
        "regex_salary_min": own["regex_salary_min"], "regex_salary_max": own["regex_salary_max"], "regex_experience_years": own["regex_experience_years"],
        "regex_seniority_from_title": named["regex_seniority_from_title"], "regex_languages": own["regex_languages"], "regex_education_level": own["regex_education_level"],
    }
