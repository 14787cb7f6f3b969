"""Agreement with a labelled set, quality reports, cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import jaccard

PRICE_IN, PRICE_OUT = 0.27, 1.10


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """truth, predicted, n; NULL is the value "null"."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    return df.groupBy(text(truth).alias("truth"), text(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def categorical_accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    same = F.col(truth).eqNullSafe(F.col(predicted))
    return df.agg(F.count("*").alias("n"), F.count_if(same).alias("exact"), F.round(F.avg(same.cast("int")) * 100, 2).alias("accuracy"))


def numeric_accuracy(df: DataFrame, truth: str, predicted: str, tolerance: float = 0.1) -> DataFrame:
    """n, exact, close (within the tolerance), both_null. Two NULLs agree, one is a miss; a truth of zero is met exactly only."""
    g, p = F.col(truth), F.col(predicted)
    none = g.isNull() & p.isNull()
    exact = none | F.coalesce(g == p, F.lit(False))
    close = exact | F.coalesce((g != 0) & (F.abs(p - g) <= F.abs(g) * tolerance), F.lit(False))
    return df.agg(F.count("*").alias("n"), F.count_if(exact).alias("exact"), F.count_if(close).alias("close"), F.count_if(none).alias("both_null"))


def list_accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Mean Jaccard, precision and recall of lower-case sets; two empty sets agree wholly."""
    low = lambda c: F.array_distinct(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), F.lower))
    g, p = low(truth), low(predicted)
    common = F.size(F.array_intersect(g, p))
    share = lambda of: F.when((F.size(g) == 0) & (F.size(p) == 0), F.lit(1.0)).when(F.size(of) == 0, F.lit(0.0)).otherwise(common / F.greatest(F.size(of), F.lit(1)))
    return df.agg(F.count("*").alias("n"), F.round(F.avg(jaccard(g, p)), 4).alias("jaccard"), F.round(F.avg(share(p)), 4).alias("precision"), F.round(F.avg(share(g)), 4).alias("recall"))


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """field, pct: share of rows that are neither NULL nor empty, one decimal."""

    def full(c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        return F.col(c).isNotNull() & ((F.size(c) > 0) if kind == "array" else (F.col(c) != "") if kind == "string" else F.lit(True))

    cells = df.agg(*[F.round(F.avg(full(c).cast("int")) * 100, 1).alias(str(k)) for k, c in enumerate(fields)])
    return cells.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(str(k)).alias("pct")) for k, c in enumerate(fields)])))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("value")).agg(F.count("*").alias("n"))


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """count, low, high, mean and the upper of the middle values, as whole numbers. The rank is found on counts, not on a collected list."""
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    total = df.agg(F.count(column).alias("n"), F.min(column).cast("long").alias("low"), F.max(column).cast("long").alias("high"), F.floor(F.avg(column)).cast("long").alias("mean"))
    median = df.filter(F.col(column).isNotNull()).agg(F.percentile(column, 0.5).alias("m"))
    above = values.crossJoin(F.broadcast(median)).filter(F.col("v") >= F.col("m")).agg(F.min("v").cast("long").alias("median"))
    return total.crossJoin(above)


def token_cost(df: DataFrame, tokens_in: Column, tokens_out: Column) -> DataFrame:
    """Token totals and their price."""
    sums = df.agg(F.count("*").alias("calls"), F.sum(tokens_in).cast("long").alias("tokens_in"), F.sum(tokens_out).cast("long").alias("tokens_out"))
    return sums.withColumn("usd", F.round(F.col("tokens_in") / 1e6 * PRICE_IN + F.col("tokens_out") / 1e6 * PRICE_OUT, 6))


def length_report(df: DataFrame, text: str, company: str) -> DataFrame:
    """Lengths and companies of an input in one pass."""
    n = F.length(text)
    return df.agg(F.count("*").alias("rows"), F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"), F.round(F.avg(n), 2).alias("mean"), F.percentile(n, 0.5).alias("median"), F.countDistinct(company).alias("companies"))


# The fields that are compared with a labelled set.
CATEGORICAL_FIELDS = ("contract_type", "work_modality", "seniority")
NUMERIC_FIELDS = ("salary_min", "salary_max", "experience_years")
LIST_FIELDS = ("technical_skills", "soft_skills", "nice_to_have_skills", "benefits", "tasks")


def golden_join(results: DataFrame, golden: DataFrame, fields: Sequence[str], *, tier1: DataFrame | None = None, id_col: str = "row_id") -> DataFrame:
    """Rows of both sides: id, g_<field>, p_<field>. The fields of `tier1` replace those of the results for its rows, NULLs too."""
    prefixed = lambda df, mark: df.select(id_col, *[F.col(f).alias(mark + f) for f in fields if f in df.columns])
    joined = prefixed(golden, "g_").join(prefixed(results, "p_"), id_col)
    if tier1 is None:
        return joined
    joined = joined.join(prefixed(tier1, "t_").withColumn("_hit", F.lit(True)), id_col, "left")
    over = {f"p_{f}": F.when(F.col("_hit"), F.col(f"t_{f}")).otherwise(F.col(f"p_{f}") if f"p_{f}" in joined.columns else F.lit(None)) for f in fields if f in tier1.columns}
    return joined.withColumns(over).drop("_hit", *[f"t_{f}" for f in fields])


def evaluate(results: DataFrame, golden: DataFrame, *, tier1: DataFrame | None = None, id_col: str = "row_id", categoricals: Sequence[str] = CATEGORICAL_FIELDS, numerics: Sequence[str] = NUMERIC_FIELDS, lists: Sequence[str] = LIST_FIELDS, tolerance: float = 0.1) -> DataFrame:
    """field, kind, n, exact, close, jaccard, precision, recall over the rows that both sides have: one join, one pass."""
    rows = golden_join(results, golden, [*categoricals, *numerics, *lists], tier1=tier1, id_col=id_col)
    cells: list[tuple[str, str, dict[str, Column]]] = []
    for f in categoricals:
        cells.append((f, "categorical", {"exact": F.count_if(F.col(f"g_{f}").eqNullSafe(F.col(f"p_{f}")))}))
    for f in numerics:
        g, p = F.col(f"g_{f}"), F.col(f"p_{f}")
        exact = g.eqNullSafe(p)
        cells.append((f, "numeric", {"exact": F.count_if(exact), "close": F.count_if(exact | F.coalesce((g != 0) & (F.abs(p - g) <= F.abs(g) * tolerance), F.lit(False)))}))
    low = lambda c: F.array_distinct(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), F.lower))
    for f in lists:
        g, p = low(f"g_{f}"), low(f"p_{f}")
        common, none = F.size(F.array_intersect(g, p)), (F.size(g) == 0) & (F.size(p) == 0)
        share = lambda of, none=none, common=common: F.round(F.avg(F.when(none, 1.0).when(F.size(of) == 0, 0.0).otherwise(common / F.greatest(F.size(of), F.lit(1)))), 4)
        cells.append((f, "list", {"jaccard": F.round(F.avg(jaccard(g, p)), 4), "precision": share(p), "recall": share(g)}))
    counted = rows.agg(F.count("*").alias("n"), *[c.alias(f"{k}_{m}") for k, (_, _, ms) in enumerate(cells) for m, c in ms.items()])
    kinds = {"exact": "long", "close": "long", "jaccard": "double", "precision": "double", "recall": "double"}
    made = [F.struct(F.lit(f).alias("field"), F.lit(kind).alias("kind"), F.col("n"), *[(F.col(f"{k}_{m}") if m in ms else F.lit(None)).cast(t).alias(m) for m, t in kinds.items()]) for k, (f, kind, ms) in enumerate(cells)]
    return counted.select(F.inline(F.array(*made)))


def token_usage(answers: DataFrame, tokens_in: str = "tokens_in", tokens_out: str = "tokens_out") -> DataFrame:
    """Totals and price of a table of answers; rows without counts count as none."""
    return token_cost(answers, F.coalesce(F.col(tokens_in), F.lit(0)), F.coalesce(F.col(tokens_out), F.lit(0)))
