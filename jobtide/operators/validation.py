"""Input flags, evidence checks, cross-field and salary flags, skill normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import ci_distinct, ci_except, first_of_each
from ..functions.numbers import any_date
from ..functions.text import SENTINELS, squeeze, strip, strip_four_escapes
from ..scratch import written

# Markers of placeholder pages, thresholds, key words.
PRIVACY_WALLS = ("datenschutz einstellungen", "cookie-einstellungen", "privacy settings", "bitte aktivieren sie javascript", "please enable javascript", "diese seite benötigt javascript")
MIN_DESCRIPTION, DATE_CUTOFF = 250, "2024-01-01"
SALARY_FLOOR, SALARY_CEILING, SALARY_MONTHLY = 15_000, 300_000, 5_000
UNVERIFIED_SHARE = 0.3
SOURCE_OVERLAP = 0.8
INTERN_TITLES, INTERN_CONTRACTS = ("intern", "praktik", "werkstudent", "working student"), ("Internship", "Working Student")
ONSITE_WORDS, REMOTE_WORDS = ("vor ort", "on-site", "onsite", "präsenzpflicht"), ("100% remote", "fully remote", "full remote", "remote-first")
FLAG = "struct<field:string,rule:string,severity:string,message:string>"


def input_flags(*, title: str = "title", company: str = "company_name", url: str = "job_url", description: str = "description", date: str = "date_posted", min_length: int = MIN_DESCRIPTION, cutoff: str = DATE_CUTOFF, flag_nulls: bool = True) -> Column:
    """ARRAY<STRING> of the rules a posting breaks. `flag_nulls`: a NULL title or company is missing too."""
    empty = lambda c: (F.col(c).isNull() if flag_nulls else F.lit(False)) | (strip(F.col(c)) == "")
    text = F.coalesce(F.col(description), F.lit(""))
    wall = F.lower(text).rlike("|".join(PRIVACY_WALLS))
    posted = F.col(date).cast("string")
    day = any_date(posted)
    return F.array_compact(F.array(
        F.when(empty(title), "missing_title"), F.when(empty(company), "missing_company"), F.when(~F.coalesce(F.startswith(F.col(url), F.lit("http")), F.lit(False)), "invalid_url"),
        F.when(wall, "privacy_wall").when(F.length(text) < min_length, "short_description"),
        F.when(day.isNull() & posted.isNotNull() & ~posted.isin(*SENTINELS), "invalid_date").when(day < F.lit(cutoff).cast("date"), "date_anomaly"),
    ))


def validate_input(df: DataFrame, **names) -> DataFrame:
    """With input_flags; a date that is an anomaly becomes NULL."""
    date = names.get("date", "date_posted")
    flagged = df.withColumn("input_flags", input_flags(**names))
    return flagged.withColumn(date, F.when(~F.array_contains("input_flags", "date_anomaly"), F.col(date)))


def _flag(field: str, rule: str, severity: str, message: Column | str) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), text.alias("message"))


def salary_flags(low: Column, high: Column, *, floor: int = SALARY_FLOOR, ceiling: int = SALARY_CEILING, monthly: int = SALARY_MONTHLY) -> Column:
    """ARRAY of flags: possibly monthly, possibly a revenue, below the floor, minimum above maximum."""

    def one(field: str, v: Column) -> Column:
        return (
            F.when(v < monthly, _flag(field, "possible_monthly", "warning", f"{field} may be a monthly salary"))
            .when(v > ceiling, _flag(field, "possible_revenue", "error", f"{field} exceeds {ceiling}"))
            .when(v < floor, _flag(field, "below_floor", "warning", f"{field} is below {floor}"))
        )

    return F.array_compact(F.array(one("salary_min", low), one("salary_max", high), F.when(low > high, _flag("salary_min", "min_greater_than_max", "error", "salary_min is above salary_max"))))


def cross_field_flags(*, title: Column, description: Column, contract: Column, modality: Column, years: Column, skills: Column, title_seniority: Column | None = None, seniority: Column | None = None) -> Column:
    """ARRAY of flags where fields contradict each other or the text. The two seniority rules need a seniority from elsewhere."""
    low_title, text, mode = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(description, F.lit(""))), F.lower(F.coalesce(modality, F.lit("")))
    any_of = lambda c, words: c.rlike("|".join(words))
    other = F.lower(F.coalesce(seniority, F.lit(""))) if seniority is not None else F.lit("")
    own = F.lower(F.coalesce(title_seniority, F.lit(""))) if title_seniority is not None else F.lit("")
    return F.array_compact(F.array(
        F.when(low_title.contains("junior") & (other == "senior"), _flag("seniority", "title_seniority_mismatch", "warning", "a junior title with senior seniority")),
        F.when(any_of(low_title, INTERN_TITLES) & (contract != "") & ~contract.isin(*INTERN_CONTRACTS), _flag("contract_type", "intern_contract_mismatch", "warning", "an intern title with another contract")),
        F.when(~own.isin("", "unknown") & (other != "") & (own != other), _flag("seniority", "seniority_source_mismatch", "info", "title and extraction differ")),
        F.when(years > 10, _flag("experience_years", "experience_unrealistic", "warning", "more than 10 years")),
        F.when((F.coalesce(F.size(skills), F.lit(0)) <= 0) & (F.length(text) > 500), _flag("technical_skills", "no_skills_long_description", "info", "a long description without skills")),
        F.when((mode == "remote") & any_of(text, ONSITE_WORDS), _flag("work_modality", "remote_but_onsite_text", "warning", "remote, but the text speaks of on-site work")),
        F.when(mode.isin("on-site", "onsite") & any_of(text, REMOTE_WORDS), _flag("work_modality", "onsite_but_remote_text", "warning", "on-site, but the text speaks of remote work")),
    ))


# ------------------------------------------------------------ evidence


def word_match(term: Column, text: Column) -> Column:
    """The term stands in the text with no ASCII letter or digit beside it; the term's signs are plain."""
    quoted = F.concat(F.lit(r"(?<![a-zA-Z0-9])\Q"), F.replace(F.lower(term), F.lit(r"\E"), F.lit("")), F.lit(r"\E(?![a-zA-Z0-9])"))
    return F.regexp_like(F.lower(text), quoted)


def skill_grounded(term: Column, text: Column, variants: Column) -> Column:
    """A skill is in a text as a word, as one of its spellings anywhere, or with spaces for hyphens."""
    low = F.lower(strip_four_escapes(text))
    plain = F.replace(F.lower(term), F.lit("-"), F.lit(" "))
    return word_match(term, low) | F.coalesce(F.exists(variants, lambda v: low.contains(v)), F.lit(False)) | ((plain != F.lower(term)) & low.contains(plain))


def source_grounded(source: Column, text: Column, share: float = SOURCE_OVERLAP) -> Column:
    """A quotation is in a text: as it is, with other white space, or with at least `share` of its words."""
    s, t = F.lower(source), F.lower(text)
    words = lambda c: F.array_distinct(F.filter(F.split(squeeze(c), " "), lambda x: x != ""))
    overlap = F.try_divide(F.size(F.array_intersect(words(s), words(t))).cast("double"), F.size(words(s)))
    return F.coalesce((s != "") & (t != "") & (t.contains(s) | t.contains(squeeze(s)) | squeeze(t).contains(squeeze(s)) | F.coalesce(overlap >= share, F.lit(False))), F.lit(False))


def verify_evidence(df: DataFrame, items: str, text: str, id_col: str, variants: DataFrame) -> DataFrame:
    """id, name, source, verdict of each evidence item. `variants` has name, spellings (lower-case list).

    Spellings are looked up by names without texts, then meet the texts by id, so that a frequent name does not bring the texts of all its rows into one task.
    A name that comes more than once in `variants` has the spellings of all its rows. The table is written once, so that Spark knows its size and need not shuffle for a small one.
    """
    known = written(variants.select(F.lower("name").alias("_k"), "spellings").filter("_k IS NOT NULL"))
    asked = df.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(F.transform(items, lambda x: F.lower(x["name"])))).alias("_k"))
    found = asked.join(known, "_k").groupBy("_id").agg(F.collect_set(F.struct("_k", "spellings")).alias("_known"))
    rows = df.select(id_col, text, items).join(found, F.col(id_col).eqNullSafe(F.col("_id")), "left").select(id_col, text, "_known", F.inline(items))
    spellings = F.flatten(F.transform(F.filter("_known", lambda k: (k["_k"] == F.lower("name")) & k["spellings"].isNotNull()), lambda k: k["spellings"]))
    verdict = F.when(source_grounded(F.col("source"), F.col(text)), "source_verified").when(skill_grounded(F.col("name"), F.col(text), spellings), "name_verified").otherwise("unverified")
    return rows.select(id_col, "name", "source", verdict.alias("verdict"))


def grounding_flags(verdicts: DataFrame, id_col: str, share: float = UNVERIFIED_SHARE) -> DataFrame:
    """Rows of which more than `share` of the items are unverified."""
    found = verdicts.groupBy(id_col).agg(F.count("*").alias("items"), F.count_if(F.col("verdict") == "unverified").alias("unverified"))
    return found.withColumn("flagged", F.col("unverified") > F.col("items") * share)


# ------------------------------------------------------------ skills


def alias_skills(c: Column, aliases: Column) -> Column:
    """Evidence structs with canonical names (a literal map of lower-case aliases), the first of each name, sorted by name."""
    named = F.transform(c, lambda x: F.struct(F.coalesce(F.element_at(aliases, F.lower(strip(x["name"]))), strip(x["name"])).alias("name"), x["source"].alias("source")))
    named = F.filter(named, lambda x: x["name"] != "")
    return F.array_sort(first_of_each(named, lambda x: F.lower(x["name"])))


def reconcile(required: Column, optional: Column) -> Column:
    """Optional items that are not required."""
    return ci_except(optional, required, lambda x: x["name"])


def soft_skills(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(c, strip), lambda x: x != "")))


def fix_c_inference(skills: Column, description: Column) -> Column:
    """'C++' where the text names it; 'C' where a bare C stands in the text; else it goes."""
    low = F.lower(F.coalesce(description, F.lit("")))
    return F.filter(F.transform(skills, lambda s: F.when(F.lower(s) != "c++", s).when(low.contains("c++"), s).when(F.coalesce(description, F.lit("")).rlike(r"(?<![\w+#])C(?![\w+#])"), F.lit("C"))), lambda s: s.isNotNull())


def validation_report(flags: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """kind, value, n: flags by rule and by severity, and rows with any."""
    by = flags.groupBy(F.explode(F.array(F.struct(F.lit("rule").alias("kind"), F.col("rule").alias("value")), F.struct(F.lit("severity").alias("kind"), F.col("severity").alias("value")))).alias("k")).agg(F.count("*").alias("n")).select("k.kind", "k.value", "n")
    flagged = flags.agg(F.countDistinct(id_col).alias("n")).select(F.lit("rows").alias("kind"), F.lit("flagged").alias("value"), "n")
    return by.unionByName(flagged).unionByName(rows.agg(F.count("*").alias("n")).select(F.lit("rows").alias("kind"), F.lit("all").alias("value"), "n"))


def normalise_list(c: Column) -> Column:
    return ci_distinct(c)


def latest(df: DataFrame, key: str, *order) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


# ------------------------------------------------------------ all validators in their order

SKILL_FIELDS = ("technical_skills", "nice_to_have_skills")
SKILL_RULES = ("skill_not_in_description", "high_hallucination_rate")
_EVIDENCE = "array<struct<name:string,source:string>>"


def literal_map(values: Mapping[str, str | Sequence[str]], kind: str) -> Column:
    """A bounded dictionary as a literal, keys in lower case."""
    cells = [x for k, v in values.items() for x in (F.lit(k.lower()), F.lit(v) if isinstance(v, str) else F.array(*[F.lit(s.lower()) for s in v]))]
    return F.create_map(*cells) if cells else F.create_map().cast(f"map<string,{kind}>")


def item_verdict(item: Column, text: Column, variants: Column) -> Column:
    """source_verified, name_verified or unverified."""
    spellings = F.coalesce(F.element_at(variants, F.lower(item["name"])), F.array().cast("array<string>"))
    return F.when(source_grounded(item["source"], text), "source_verified").when(skill_grounded(item["name"], text, spellings), "name_verified").otherwise("unverified")


def _skill_flags(field: str, names: Column, total: Column, share: float) -> Column:
    each = F.transform(names, lambda n: _flag(field, SKILL_RULES[0], "warning", F.concat(F.lit("'"), n, F.lit("' not found in description"))))
    many = F.when(F.size(names) > total * share, _flag(field, SKILL_RULES[1], "error", f"more than {share:.0%} of {field} not found in description"))
    return F.concat(each, F.array_compact(F.array(many)))


def run_validators(df: DataFrame, *, aliases: Mapping[str, str] | None = None, variants: Mapping[str, Sequence[str]] | None = None, share: float = UNVERIFIED_SHARE, text: str = "description", title: str = "title_cleaned", prefix: str = "regex_") -> DataFrame:
    """Skill lists (evidence structs) checked in this order: names through aliases, each once, sorted, optional ones without the required
    ones; verdicts by source and name; ungrounded items go; lists become names beside *_evidence; flags across fields; pay;
    truncated texts and lists (columns was_truncated and list_truncated, where there are any). Flags of all steps
    are in validation_flags, in that order. NULL lists count as empty."""
    known, spelt = literal_map(aliases or {}, "string"), literal_map(variants or {}, "array<string>")
    body = F.coalesce(F.col(text), F.lit(""))
    full = lambda c: F.coalesce(F.col(c), F.array().cast(_EVIDENCE))
    out = df.withColumns({f: alias_skills(full(f), known) for f in SKILL_FIELDS})
    out = out.withColumn(SKILL_FIELDS[1], reconcile(F.col(SKILL_FIELDS[0]), F.col(SKILL_FIELDS[1])))
    if "soft_skills" in df.columns:
        out = out.withColumn("soft_skills", soft_skills(F.coalesce("soft_skills", F.array().cast("array<string>"))))
    judged = lambda f: F.transform(F.col(f), lambda x: F.struct(x.alias("item"), item_verdict(x, body, spelt).alias("verdict")))
    out = out.withColumns({f"_{f}": judged(f) for f in SKILL_FIELDS})
    lost = lambda f: F.transform(F.filter(F.col(f"_{f}"), lambda v: v["verdict"] == "unverified"), lambda v: v["item"]["name"])
    flags = [_skill_flags(f, lost(f), F.size(f"_{f}"), share) for f in SKILL_FIELDS]
    out = out.withColumns({f"{f}_evidence": F.transform(F.filter(F.col(f"_{f}"), lambda v: v["verdict"] != "unverified"), lambda v: v["item"]) for f in SKILL_FIELDS} | {"_skill_flags": F.concat(*flags)})
    if "benefits" in df.columns and df.schema["benefits"].dataType.simpleString().startswith("array<struct"):
        out = out.withColumn("benefits_evidence", full("benefits")).withColumn("benefits", F.transform(full("benefits"), lambda x: x["name"]))
    out = out.withColumns({f: F.transform(f"{f}_evidence", lambda x: x["name"]) for f in SKILL_FIELDS})
    of = lambda name, kind="string": F.col(prefix + name) if prefix + name in df.columns else F.lit(None).cast(kind)
    more = [
        cross_field_flags(title=F.col(title), description=F.col(text), contract=of("contract_type"), modality=of("work_modality"), years=of("experience_years", "int"), skills=F.col("technical_skills"), title_seniority=of("seniority_from_title")),
        salary_flags(of("salary_min", "int"), of("salary_max", "int")),
    ]
    for column, field, rule in (("was_truncated", text, "description_truncated"), ("list_truncated", "tasks", "list_truncated")):
        if column in df.columns:
            more.append(F.array_compact(F.array(F.when(F.col(column), _flag(field, rule, "info", f"{field} was cut")))))
    return out.withColumn("validation_flags", F.concat("_skill_flags", *more)).drop("_skill_flags", *[f"_{f}" for f in SKILL_FIELDS])


def reverify_skills(df: DataFrame, *, variants: Mapping[str, Sequence[str]] | None = None, text: str = "description", flags: str = "validation_flags", fields: Sequence[str] = SKILL_FIELDS) -> DataFrame:
    """After cleaning: flags of skills are made anew from the names as they are now, all other flags stay in front of them."""
    spelt, body = literal_map(variants or {}, "array<string>"), F.coalesce(F.col(text), F.lit(""))
    kept = F.filter(F.coalesce(F.col(flags), F.array().cast(f"array<{FLAG}>")), lambda x: ~x["rule"].isin(*SKILL_RULES))

    def fresh(field: str) -> Column:
        names = F.filter(F.coalesce(F.col(field), F.array().cast("array<string>")), lambda n: ~skill_grounded(n, body, F.coalesce(F.element_at(spelt, F.lower(n)), F.array().cast("array<string>"))))
        return F.transform(names, lambda n: _flag(field, SKILL_RULES[0], "warning", F.concat(F.lit("'"), n, F.lit("' not found in description (post-clean check)"))))

    return df.withColumn(flags, F.concat(kept, *[fresh(f) for f in fields if f in df.columns]))
