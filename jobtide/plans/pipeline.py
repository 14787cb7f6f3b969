"""The posting pipeline as DataFrame stages, and a small command line over them.

Each stage is a function of a table and settings. Between stages the command line writes Parquet under the work
folder, so a run resumes at the first stage whose table is not there.
"""

from __future__ import annotations

import argparse
import json
import os
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import description_fields, description_parts, title_fields
from ..functions.locations import is_non_german, normalize_city, parse_location
from ..functions.text import concatenated
from ..functions.titles import normalize_title, translate_title
from ..operators import analytics, cleaning, dedup, filters, validation
from ..operators.distinct import evaluate_once
from ..sources import io
from ..sources.state import merge_results
from .extraction import Extractor, extract, extract_resumable, rule_based


@dataclass(frozen=True)
class Settings:
    """What a run can be told; bounds are checked."""

    sources: Sequence[io.Source] = ()
    scrape_date: str = "2026-02-15"
    export_cutoff: str = "2025-10-01"
    near_threshold: float = 0.95
    batch_size: int = 100
    retries: int = 3
    temperature: float = 0.0
    substring_countries: bool = False
    keep_unresolved_country: bool = True
    families: Mapping[str, str] = field(default_factory=lambda: {"Data Engineer": "data engineer", "Software Developer": "developer"})
    skills: Mapping[str, str] = field(default_factory=lambda: {"Python": "python", "SQL": "sql", "Java": "java "})
    extractor: Extractor | None = None
    aliases: Mapping[str, str] = field(default_factory=dict)
    variants: Mapping[str, Sequence[str]] = field(default_factory=dict)
    limit: int | None = None
    #: Column -> values and what they become; families that are then unknown become Other where `known_families` are given.
    remaps: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    known_families: Sequence[str] = ()
    #: Folder of answers, by which extraction goes on where it was stopped; `run` sets it. Rows between two commits of answers.
    answers: str | None = None
    commit_rows: int = 10_000

    def __post_init__(self):
        for name, low, high in (("batch_size", 1, 10_000), ("commit_rows", 1, 10_000_000), ("retries", 1, 20), ("temperature", 0, 2), ("near_threshold", 0, 1)):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must be from {low} to {high}")


def ingest(spark: SparkSession, _: DataFrame | None, s: Settings) -> DataFrame:
    return io.ingest_contract(io.ingest(spark, s.sources, s.scrape_date, limit=s.limit))


def prepare(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    """Input flags, places, cleaned titles; postings outside Germany go."""
    checked = validation.validate_input(df)
    placed = checked.withColumn("_p", parse_location(F.col("location"))).select("*", "_p.city", "_p.state", "_p.country").drop("_p")
    abroad = is_non_german(F.col("location"), F.col("state"), F.col("country"), substring_keywords=s.substring_countries)
    if not s.keep_unresolved_country:
        abroad |= F.col("country").isNull()
    title = F.coalesce("title", F.lit(""))
    return placed.filter(~abroad).withColumns({"title_original": title, "title_cleaned": translate_title(normalize_title(title))})


def deduplicate(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    """Flagged rows and key duplicates go; equal and near-equal descriptions get one representative."""
    rows = dedup.written(dedup.dedup_rows(filters.drop_flagged(df)))
    groups = dedup.description_groups(rows)
    reps = rows.join(groups.filter("id = representative").select(F.col("id").alias("row_id")), "row_id", "left_semi")
    tokens = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("description", F.lit(""))), r"(?U)\s+"), lambda x: x != ""))
    led = dedup.similar_leaders(reps.select(F.col("row_id").alias("id"), tokens.alias("tokens")), "tokens", s.near_threshold)
    merged = dedup.merge_groups(groups, led).select(F.col("id").alias("row_id"), "representative")
    return rows.join(merged, "row_id")


def regex_extract(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    """Fields by pattern: once for each different description, and by row what titles say."""
    filters.require_columns(df, ("title_cleaned", "description"))
    found = evaluate_once(df, ["description"], description_fields(), id_col="row_id", parts=description_parts(F.col("description")))
    named = title_fields(F.coalesce("title_cleaned", "title"))
    return found.withColumns({n: F.coalesce(F.col(n), c) if n in found.columns else c for n, c in named.items()})


def semantic_extract(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    """One extraction per representative, given to all members. Answers are kept in `s.answers`, so a stopped run goes on with what is missing."""
    reps = df.filter("row_id = representative").select("row_id", F.col("title_cleaned").alias("title"), "description")
    run = s.extractor or rule_based(s.families, s.skills)
    if s.answers:
        commits = max(1, -(-reps.count() // s.commit_rows))
        found = extract_resumable(reps, s.answers, run, attempts=s.retries, batches=commits).join(reps.select("row_id"), "row_id", "left_semi")
    else:
        found = extract(reps, None, run)
    by_rep = found.filter("parsed.data IS NOT NULL").select(F.col("row_id").alias("representative"), "parsed.data.*")
    return df.join(by_rep, "representative", "left")


def validate(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    """Names through aliases, ungrounded skills out, lists to names, flags attached; see `validation.run_validators`."""
    return validation.run_validators(df, aliases=s.aliases, variants=s.variants)


def clean_enrich(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    merged = merge_results(df.withColumnRenamed("regex_seniority_from_title", "regex_seniority"), df.select("row_id"))
    # a run without extraction has no lists and no family
    absent = {c: "array<string>" for c in ("benefits", "soft_skills")} | {"job_family": "string"}
    merged = merged.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in merged.columns})
    lists = [c for c in ("technical_skills", "soft_skills", "nice_to_have_skills", "benefits", "tasks") if c in merged.columns]
    out = cleaning.standardize_missing(merged, lists, ["job_family", "contract_type", "work_modality"])
    out = cleaning.fix_company(cleaning.fix_numeric(out))
    for column, mapping in s.remaps.items():
        if column in out.columns:
            out = cleaning.remap(out, column, mapping)
    if s.known_families:
        out = cleaning.remap(out, "job_family", {}, valid=s.known_families)
    if "company_name" in out.columns:
        out = analytics.apply_casing(out, "company_name", analytics.casing_map(out, "company_name", order="_ord" if "_ord" in out.columns else None))
    out = out.withColumn("city", normalize_city(F.col("city"), F.col("state"))).withColumn("title", cleaning.strip_residual_gender(F.col("title_cleaned")))
    out = out.withColumns({"benefit_categories": cleaning.benefit_categories(F.col("benefits")), "soft_skill_categories": cleaning.soft_skill_categories(F.col("soft_skills")), "description_quality": concatenated(F.col("description"))})
    if "validation_flags" in out.columns:
        out = validation.reverify_skills(out, variants=s.variants)
    return filters.drop_blank(out, "job_family")


def export(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    recent = filters.not_before(df, "date_posted", s.export_cutoff)
    final = cleaning.reorder(recent.select(*[c for c in cleaning.FINAL_COLUMNS if c in recent.columns]))
    return cleaning.assert_invariants(final, id_col="row_id", categoricals=["job_family", "contract_type", "work_modality"], enums={"contract_type": cleaning.CONTRACT_TYPES}, low="salary_min", high="salary_max", company="company_name", title="title", lists=["technical_skills", "benefits"])


def export_light(spark: SparkSession, df: DataFrame, s: Settings) -> DataFrame:
    return cleaning.light(df)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame | None, Settings], DataFrame]]] = [
    ("ingest", ingest), ("prepare", prepare), ("deduplicate", deduplicate), ("regex_extract", regex_extract), ("extract", semantic_extract),
    ("validate", validate), ("clean_enrich", clean_enrich), ("export", export), ("export_light", export_light),
]
NAMES = [n for n, _ in STAGES]
#: Folder of the answers of the extraction, under the work folder.
ANSWERS = "answers"


def plan(*, step: str | None = None, start: str | None = None, only: Sequence[str] = (), done: Sequence[str] = (), no_llm: bool = False) -> list[str]:
    """Stages to run: the one, from one on, the named ones, or all that are not done; without extraction and validation if so asked."""
    if no_llm:
        return [n for n in plan(step=step, start=start, only=only, done=done) if n not in ("extract", "validate")]
    for n in [x for x in (step, start, *only) if x]:
        if n not in NAMES:
            raise ValueError(f"no stage {n}; there are {', '.join(NAMES)}")
    if step:
        return [step]
    if start:
        return NAMES[NAMES.index(start) :]
    return [n for n in NAMES if n in only] if only else [n for n in NAMES if n not in done]


def run(spark: SparkSession, settings: Settings, work: str, stages: Sequence[str] | None = None) -> DataFrame:
    """Run stages in order; each table is published under `work` as a whole and read back. Answers of the extraction are kept there as well."""
    df, last = None, None
    if settings.answers is None:
        settings = replace(settings, answers=f"{work}/{ANSWERS}")
    for name, stage in STAGES:
        path = f"{work}/{name}"
        io.restore(spark, path)
        if stages is None or name in stages:
            if df is None and last:
                df = spark.read.parquet(last)
            began = time.time()
            io.publish(stage(spark, df, settings), path)
            _note(work, name, time.time() - began)
            df = spark.read.parquet(path)
        elif not io.exists(spark, path):
            continue  # left out: the next stage reads the last table there is
        else:
            df = None
        last = path
    return df


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _note(work: str, name: str, seconds: float) -> None:
    """Progress beside the tables where the work folder is local."""
    local = work.removeprefix("file://")
    if os.path.isdir(local):
        path = os.path.join(local, "progress.json")
        known = json.load(open(path, encoding="utf-8")) if os.path.exists(path) else {}
        known[name] = {"status": "complete", "elapsed_s": round(seconds, 1)}
        with open(path, "w", encoding="utf-8") as out:
            json.dump(known, out, indent=1)


def main(args: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config", help="JSON with sources (name, path, site, columns) and settings")
    p.add_argument("--work", help="folder that driver and executors share")
    p.add_argument("--reset", action="store_true", help="delete all tables of the work folder first")
    p.add_argument("--clean", action="store_true", help="delete the tables of the stages that will run first")
    p.add_argument("--limit", type=int, help="rows to ingest")
    p.add_argument("--no-llm", action="store_true", help="without extraction and validation")
    p.add_argument("--step")
    p.add_argument("--from", dest="start")
    p.add_argument("--only", nargs="*", default=[])
    p.add_argument("--list", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(args)
    steps = plan(step=a.step, start=a.start, only=a.only, no_llm=a.no_llm)
    if a.list or a.dry_run:
        print("\n".join(NAMES if a.list else steps))
        return 0
    if not a.config or not a.work:
        p.error("--config and --work are needed")
    raw = json.load(open(a.config, encoding="utf-8"))
    settings = Settings(**(raw | {"sources": [io.Source(**x) for x in raw.get("sources", [])]} | ({"limit": a.limit} if a.limit is not None else {})))
    from ..session import session

    spark = session()
    for name in NAMES if a.reset else steps if a.clean else ():
        delete(spark, f"{a.work}/{name}")
        if name == "extract":
            delete(spark, f"{a.work}/{ANSWERS}")
    run(spark, settings, a.work, steps)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
