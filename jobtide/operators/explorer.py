"""What an interactive explorer asks: profiles, recommendations, estimates, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import pairs
from ..functions.numbers import round_half_up
from .analytics import salary_stats, skill_counts, top, top_per_group
from .filters import multi_filter


def profile(df: DataFrame, role: str, facets: dict[str, int], low: str, high: str) -> tuple[DataFrame, DataFrame]:
    """Per role: salary statistics, and the most frequent values of each facet (facet, grp, value, n, rank)."""
    parts = None
    for facet, n in facets.items():
        part = top_per_group(df, role, facet, n).withColumn("facet", F.lit(facet))
        parts = part if parts is None else parts.unionByName(part)
    return salary_stats(df, low, high, role), parts


def recommend(df: DataFrame, skills: Sequence[str], *, column: str, role: str, n: int = 15, n_missing: int = 5, min_overlap: int = 1) -> DataFrame:
    """Roles by the share of their rows that list at least one of the skills: total, matching, match_pct, avg_overlap, missing.

    A row without a role counts under 'Other'. avg_overlap is the mean share of the skills that matching rows list, missing the
    elements that matching rows list most and the skills do not have.
    """
    wanted = [s.lower() for s in skills]
    low = F.array_distinct(F.transform(column, F.lower))
    rows = df.select(F.coalesce(role, F.lit("Other")).alias("role"), F.filter(low, lambda x: x.isin(*wanted)).alias("own"), F.filter(low, lambda x: ~x.isin(*wanted)).alias("others"))
    hit = F.size("own") >= min_overlap
    stats = rows.groupBy("role").agg(F.count("*").alias("total"), F.count_if(hit).alias("matching"), F.avg(F.when(hit, F.size("own") / len(wanted))).alias("avg_overlap")).filter("matching > 0")
    chosen = top(stats.withColumn("match_pct", F.round(F.col("matching") * 100.0 / F.col("total"), 4)), n, F.desc("match_pct"), "role")
    missing = top_per_group(rows.filter(hit).select("role", F.explode("others").alias("item")), "role", "item", n_missing)
    lists = missing.groupBy(F.col("grp").alias("role")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]), ",").alias("missing"))
    return chosen.join(lists, "role", "left").select("role", "total", "matching", "match_pct", F.round("avg_overlap", 4).alias("avg_overlap"), F.coalesce("missing", F.lit("")).alias("missing"))


def estimate_salary(df: DataFrame, wanted: dict[str, str], low: str, high: str) -> DataFrame:
    return salary_stats(multi_filter(df, wanted), low, high)


def without_language(df: DataFrame, column: str = "languages", names: Sequence[str] = ("german", "deutsch")) -> DataFrame:
    """Rows that ask for none of the languages; a NULL list asks for nothing."""
    return df.filter(~F.coalesce(F.exists(column, lambda x: F.lower(x["language"]).isin(*names)), F.lit(False)))


def skill_combos(df: DataFrame, column: str, value: str, n_items: int = 40, n: int = 30) -> DataFrame:
    """Most frequent pairs among the n_items most frequent elements, with the median of a value (rounded half up)."""
    items = [r["item"] for r in skill_counts(df, column, n_items).collect()]
    rows = df.select(F.filter(column, lambda x: x.isin(*items)).alias("kept"), F.col(value).alias("v"))
    found = rows.select(F.explode(pairs(F.col("kept"))).alias("p"), "v").groupBy("p.a", "p.b").agg(F.count("*").alias("n"), round_half_up(F.percentile("v", 0.5)).alias("median"))
    return top(found, n, F.desc("n"), "a", "b")


def compare_roles(df: DataFrame, role: str, column: str, a: str, b: str, n: int = 15) -> DataFrame:
    """One row: shared, only_a and only_b among the n most frequent elements of two roles, sorted and joined by commas."""
    rows = df.filter(F.col(role).isin(a, b)).select(role, F.explode(column).alias("item"))
    # at most n elements a role
    sets = top_per_group(rows, role, "item", n).groupBy().pivot("grp", [a, b]).agg(F.collect_set("value"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    return sets.select(joined(F.array_intersect(x, y)).alias("shared"), joined(F.array_except(x, y)).alias("only_a"), joined(F.array_except(y, x)).alias("only_b"))


def available(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """Values with at least min_count rows."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def available_skills(df: DataFrame, column: str, min_count: int) -> DataFrame:
    return skill_counts(df, column, None).filter(F.col("n") >= min_count)


def ranked(df: DataFrame, partition: str, *order) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(partition).orderBy(*order)).cast("long"))
