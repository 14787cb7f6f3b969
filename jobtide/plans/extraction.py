"""Semantic extraction: messages, responses as text, and pluggable extractors.

No model is called from here. An extractor is a function from pending rows to (row_id, raw); `replay` reads
answers from a table, `rule_based` makes deterministic ones, and any other may do its calls in mapInArrow.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.json_schema import compile_schema
from ..functions.text import strip, truncate_description
from ..shipping import ship
from ..sources.io import exists

Extractor = Callable[[DataFrame], DataFrame]
EVIDENCE = "array<struct<name:string,source:string>>"
FIELDS = f"job_family string, job_summary string, technical_skills {EVIDENCE}, nice_to_have_skills {EVIDENCE}, soft_skills array<string>, benefits {EVIDENCE}, tasks array<string>"
REQUIRED = ("job_family", "job_summary", "technical_skills", "nice_to_have_skills", "benefits", "tasks")
# Misspelt keys that answers have had.
TYPOS: Mapping[str, str] = {"technical_skils": "technical_skills", "tecnical_skills": "technical_skills", "nice_to_have": "nice_to_have_skills", "job_familiy": "job_family", "job_sumary": "job_summary", "softskills": "soft_skills", "benefit": "benefits", "task": "tasks"}
MIN_ANSWER, MAX_TASKS = 30, 10


def message(template: str, title: Column, company: Column, description: Column, max_tokens: int = 4000) -> Column:
    """The template with its {title}, {company} and {description}."""
    text = F.lit(template)
    for name, value in (("title", title), ("company", company), ("description", truncate_description(F.coalesce(description, F.lit("")), max_tokens))):
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return text


def prompt_version(template: str) -> Column:
    return F.substring(F.md5(F.lit(template)), 1, 8)


def readable(raw: Column) -> Column:
    """STRUCT<strategy, text>: an answer in the first of four ways of reading it that gives an object; NULL if none does, or if it is short.

    A way is made only where those before it failed, and parsed only where it begins as an object and differs from what has failed. All are linear in the text.
    """
    is_object = lambda c: c.startswith("{") & F.try_parse_json(c).isNotNull()
    no_commas = lambda c: F.regexp_replace(c, r",\s*([}\]])", "$1")

    def way(name: str, text: Column, *failed: Column) -> Column:
        return F.when(reduce(lambda a, f: a & (text != f), failed, F.lit(True)) & is_object(text), F.struct(F.lit(name).alias("strategy"), text.alias("text")))

    def bare(text: Column) -> Column:
        """Without a fence around it."""
        inner = F.regexp_replace(text, r"(?i)^```(?:json)?", "")
        return F.when(text.contains("```"), strip(let(inner, lambda x: F.when(x.endswith("```"), F.substring(x, F.lit(1), F.length(x) - 3)).otherwise(x)))).otherwise(text)

    def braces(text: Column) -> Column:
        """From the first opening brace to the last closing one."""
        first, last = F.instr(text, "{"), F.length(text) - F.length(F.substring_index(text, "}", -1))
        return F.when((first > 0) & (last > first), no_commas(F.substring(text, first, last - first + 1))).otherwise("")

    def tries(text: Column) -> Column:
        cut = lambda fenced, commas: let(braces(text), lambda x: way("extract_braces", x, text, fenced, commas))
        tidied = lambda fenced: let(no_commas(fenced), lambda x: F.coalesce(way("fix_commas", x, text, fenced), cut(fenced, x)))
        return F.when(F.length(text) >= MIN_ANSWER, F.coalesce(way("direct", text), let(bare(text), lambda x: F.coalesce(way("strip_fences", x, text), tidied(x)))))

    return let(strip(F.coalesce(raw, F.lit(""))), tries)


def mended(text: Column) -> Column:
    """Misspelt keys replaced, in texts that have one."""
    named = reduce(lambda t, kv: F.replace(t, F.lit(f'"{kv[0]}"'), F.lit(f'"{kv[1]}"')), TYPOS.items(), text)
    return F.when(text.rlike('"(?:' + "|".join(TYPOS) + ')"'), named).otherwise(text)


def parse_response(raw: Column, max_tasks: int = MAX_TASKS) -> Column:
    """STRUCT<data, strategy, missing, truncated> of an answer; strategy 'failed' has NULL data."""
    none, strings = F.array().cast(EVIDENCE), F.array().cast("array<string>")

    def read(pick: Column) -> Column:
        return let(F.struct(pick["strategy"].alias("strategy"), F.from_json(mended(pick["text"]), FIELDS).alias("data")), shape)

    def shape(r: Column) -> Column:
        data, ok = r["data"], r["strategy"].isNotNull()
        named = lambda c: F.filter(F.coalesce(c, none), lambda x: strip(x["name"]) != "")
        tasks = F.coalesce(data["tasks"], strings)
        clean = F.struct(
            data["job_family"].alias("job_family"), data["job_summary"].alias("job_summary"), named(data["technical_skills"]).alias("technical_skills"), named(data["nice_to_have_skills"]).alias("nice_to_have_skills"),
            F.coalesce(data["soft_skills"], strings).alias("soft_skills"), named(data["benefits"]).alias("benefits"), F.slice(tasks, 1, max_tasks).alias("tasks"),
        )
        missing = F.array_compact(F.array(*[F.when(data[f].isNull(), f) for f in REQUIRED]))
        return F.struct(F.when(ok, clean).alias("data"), F.coalesce(r["strategy"], F.lit("failed")).alias("strategy"), F.when(ok, missing).alias("missing"), F.when(ok, F.size(tasks) > max_tasks).alias("truncated"))

    return let(readable(raw), read)


#: What an answer must be (draft 7). The fields and their rules.
_EVIDENCE_LIST = {"type": "array", "items": {"$ref": "#/definitions/evidence_item"}}
OUTPUT_SCHEMA: Mapping = {
    "definitions": {"evidence_item": {"type": "object", "properties": {"name": {"type": "string", "minLength": 1}, "source": {"type": "string"}}, "required": ["name", "source"], "additionalProperties": False}},
    "type": "object",
    "properties": {
        "technical_skills": _EVIDENCE_LIST, "soft_skills": {"type": "array", "items": {"type": "string", "minLength": 1}, "uniqueItems": True}, "nice_to_have_skills": _EVIDENCE_LIST, "benefits": _EVIDENCE_LIST, "tasks": _EVIDENCE_LIST,
        "job_family": {"type": "string", "minLength": 1}, "job_summary": {"oneOf": [{"type": "string", "minLength": 1}, {"type": "null"}]},
    },
    "required": ["technical_skills", "soft_skills", "nice_to_have_skills", "benefits", "tasks", "job_family"],
    "additionalProperties": False,
}


def schema_errors(raw: Column, schema: Mapping = OUTPUT_SCHEMA) -> Column:
    """Every error (path, rule, message) of an answer under a schema, in the first of the ways of reading it that gives an object; misspelt keys are mended
    before. An answer that cannot be read has one error of the rule `json`."""
    return compile_schema(schema)(F.try_parse_json(let(readable(raw)["text"], mended)))


def schema_report(found: DataFrame, errors: str = "errors") -> DataFrame:
    """path (places of items as *), rule, n, rows: how often each rule is broken, and in how many answers."""
    each = found.select(F.monotonically_increasing_id().alias("_i"), F.explode(errors).alias("e")).select("_i", F.regexp_replace("e.path", r"(?<= )\d+(?= |$)", "*").alias("path"), "e.rule")
    return each.groupBy("path", "rule").agg(F.count("*").alias("n"), F.countDistinct("_i").alias("rows"))


def replay(answers: DataFrame) -> Extractor:
    """Answers from a table of row_id, raw."""
    return lambda rows: rows.select("row_id").join(answers.select("row_id", "raw"), "row_id")


def rule_based(families: Mapping[str, str], skills: Mapping[str, str]) -> Extractor:
    """Answers made of the first family whose part is in the title, and the skills whose part is in the description."""

    def run(rows: DataFrame) -> DataFrame:
        title, text = F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("description", F.lit("")))
        family = F.coalesce(*[F.when(title.contains(p), n) for n, p in families.items()], F.lit("Other"))
        found = F.array_compact(F.array(*[F.when(text.contains(p), F.struct(F.lit(n).alias("name"), F.lit(p).alias("source"))) for n, p in skills.items()]))
        empty = F.array().cast(EVIDENCE)
        data = F.struct(family.alias("job_family"), F.substring(F.coalesce("description", F.lit("")), 1, 200).alias("job_summary"), found.alias("technical_skills"), empty.alias("nice_to_have_skills"), empty.alias("benefits"), F.array().cast("array<string>").alias("tasks"))
        return rows.select("row_id", F.to_json(data).alias("raw"))

    return run


def extract(rows: DataFrame, done: DataFrame | None, extractor: Extractor) -> DataFrame:
    """row_id and parsed answer of the rows that have none yet, together with the earlier ones."""
    todo = rows if done is None else rows.join(done.select("row_id"), "row_id", "left_anti")
    fresh = extractor(todo).select("row_id", parse_response(F.col("raw")).alias("parsed"))
    return fresh if done is None else fresh.unionByName(done.select("row_id", "parsed"))


def parse_summary(found: DataFrame) -> DataFrame:
    """strategy, n: how the answers could be read."""
    return found.groupBy(F.col("parsed.strategy").alias("strategy")).agg(F.count("*").alias("n"))


def failures(found: DataFrame) -> DataFrame:
    """row_id of answers that could not be read in any way."""
    return found.filter("parsed.data IS NULL").select("row_id", F.col("parsed.strategy").alias("strategy"))


class TokenBucket:
    """At most `rate` calls a second on average and `burst` at once; `take` waits for its turn. For threads of one task."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if rate <= 0 or burst < 1:
            raise ValueError("rate must be above 0 and burst at least 1")
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.lock, self.held, self.at = threading.Lock(), float(burst), clock()

    def take(self) -> None:
        with self.lock:
            now = self.clock()
            self.held = min(self.burst, self.held + (now - self.at) * self.rate) - 1
            self.at = now
            wait = -self.held / self.rate
        if wait > 0:
            self.sleep(wait)  # the place is taken, so others queue up behind it


def _busy(e: Exception) -> bool:
    return getattr(e, "status", 0) == 429 or getattr(e, "status", 0) >= 500


def remote(
    call: Callable[[str, str], tuple[str, int, int]], *, attempts: int = 3, pause: float = 1.0, may_repeat: Callable[[Exception], bool] = _busy,
    in_flight: int = 1, rate: float | None = None, burst: int = 1, tasks: int | None = None,
) -> Extractor:
    """`call(title, description)` gives (answer, tokens in, tokens out). Overload and server errors are tried again after 1, 2, 4 ... pauses;
    what still fails is an empty answer with the error beside it, so one row never ends the job.

    A task keeps a window of at most `in_flight` calls and gives answers in the order of its rows. `rate` bounds the calls a second of all tasks together,
    tries included, where `tasks` says how many tasks there are: rows are then dealt over as many, and each has its share. Without `tasks`
    the bound is one of each task.
    """
    if in_flight < 1 or tasks is not None and tasks < 1:
        raise ValueError("in_flight and tasks must be at least 1")
    share = rate / (tasks or 1) if rate is not None else None

    def run(batches):
        import pyarrow as pa

        bucket = TokenBucket(share, burst) if share is not None else None

        def one(key: str, title: str | None, text: str | None) -> tuple:
            answer, tokens, error = "", (0, 0), None
            for k in range(attempts):
                if bucket:
                    bucket.take()
                try:
                    answer, *tokens = call(title or "", text or "")
                    return (key, answer, *tokens, None)
                except Exception as e:  # any failure of the service is a result of the row
                    error = f"{type(e).__name__}: {e}"
                    if not may_repeat(e):
                        break
                    if k + 1 < attempts:
                        time.sleep(pause * 2**k)
            return (key, "", *tokens, error)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["row_id", "raw", "tokens_in", "tokens_out", "error"])

        pool, waiting = ThreadPoolExecutor(in_flight), deque()
        try:
            for batch in batches:
                done: list[tuple] = []
                for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    waiting.append(pool.submit(one, *row))
                    if len(waiting) >= in_flight:
                        done.append(waiting.popleft().result())
                yield batch_of(done)
            yield batch_of([f.result() for f in waiting])
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    def extractor(rows: DataFrame) -> DataFrame:
        ship(rows.sparkSession)
        asked = rows.select("row_id", "title", "description")
        return (asked.repartition(tasks) if tasks else asked).mapInArrow(run, "row_id string, raw string, tokens_in long, tokens_out long, error string")

    return extractor


def extract_resumable(rows: DataFrame, path: str, extractor: Extractor, *, attempts: int = 3, batches: int = 1) -> DataFrame:
    """row_id, parsed, attempt: the best answer of each row, from the store at `path` and from calls for rows that lack one.

    Each batch of rows is committed to the store before the next is begun, so a run that was stopped goes on with what is
    missing. Rows that failed are tried again up to `attempts` times over all runs. Earlier answers are never lost.
    """
    spark = rows.sparkSession
    for _ in range(attempts):
        todo = rows.withColumn("_n", F.lit(1))
        if exists(spark, path):
            seen = spark.read.parquet(path).groupBy("row_id").agg(F.max("attempt").alias("_n"), F.max(F.col("parsed.data").isNotNull()).alias("_ok"))
            todo = rows.join(seen, "row_id", "left").filter(~F.coalesce("_ok", F.lit(False)) & (F.coalesce("_n", F.lit(0)) < attempts)).drop("_ok").withColumn("_n", F.coalesce("_n", F.lit(0)) + 1)
        if todo.isEmpty():
            break
        numbers = todo.select("row_id", F.col("_n").alias("attempt"))
        for b in range(batches):
            part = todo.filter(F.pmod(F.xxhash64("row_id"), F.lit(batches)) == b).drop("_n")
            answers = extractor(part).select("row_id", parse_response(F.col("raw")).alias("parsed")).join(numbers, "row_id")
            answers.write.mode("append").parquet(path)
    best = F.min_by(F.struct("parsed", "attempt"), F.struct(F.col("parsed.data").isNull().alias("bad"), (-F.col("attempt")).alias("late")))
    return spark.read.parquet(path).groupBy("row_id").agg(best.alias("best")).select("row_id", "best.*")
