"""Aggregations over postings, parametrised by column. Results are long form; pivots are for presentation.

Ties of every top list fall to the smaller key, so results do not depend on row order; an order
column can be given where the first seen is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import pairs
from ..functions.numbers import round_half_up
from ..functions.text import strip
from ..scratch import written
from .quantiles import quantiles


def top(df: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """The first n rows: a sort and limit that Spark runs as one top-n, never a full sort."""
    return df.orderBy(*order).limit(n) if n is not None else df


def _items(df: DataFrame, column: str, *, trim: bool = True) -> DataFrame:
    item = strip(F.col("item")) if trim else F.col("item")
    return df.withColumn("item", F.explode(column)).withColumn("item", item).filter("item IS NOT NULL AND item <> ''")


def counts(df: DataFrame, column: str, n: int | None = None, *, name: str = "value") -> DataFrame:
    """How often each value occurs, NULL left out."""
    found = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(F.count("*").alias("n"))
    return top(found, n, F.desc("n"), name)


def skill_counts(df: DataFrame, column: str, n: int | None = 30, *, order: str | None = None, trim: bool = True) -> DataFrame:
    """Occurrences of list elements: item, n. With `order`, ties fall to the first seen."""
    items = _items(df, column, trim=trim)
    if order is None:
        return top(items.groupBy("item").agg(F.count("*").alias("n")), n, F.desc("n"), "item")
    found = items.groupBy("item").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return top(found, n, F.desc("n"), "first", "item").drop("first")


def skill_frequencies(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    """Counts with the percentage of rows, one decimal."""
    return skill_counts(df, column, n).crossJoin(F.broadcast(df.agg(F.count("*").alias("rows")))).select("item", "n", F.round(F.col("n") * 100.0 / F.col("rows"), 1).alias("pct"))


def _restricted(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows with `kept`, the set of their elements that are among the n most frequent. The list is n values, so a literal of the plan."""
    chosen = [r["item"] for r in skill_counts(df, column, n).collect()]
    return df.withColumn("kept", F.array_distinct(F.filter(F.transform(column, strip), lambda x: x.isin(*chosen))) if chosen else F.array().cast("array<string>"))


def skill_cooccurrence(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """a, b, n for pairs of the n most frequent elements in one row; both directions, no diagonal."""
    half = _restricted(df, column, n).select(F.inline(pairs(F.col("kept")))).groupBy("a", "b").agg(F.count("*").alias("n"))
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return half.select(F.explode(both).alias("p"), "n").select("p.a", "p.b", "n")


def skill_by_group(df: DataFrame, column: str, group: str, n_items: int = 15, n_groups: int | None = 10) -> DataFrame:
    """Percentage of a group's rows that list an element: grp, item, pct; all n_items x n_groups cells."""
    items = [r["item"] for r in skill_counts(df, column, n_items).collect()]
    groups = [r["value"] for r in counts(df, group, n_groups).collect()] if n_groups is not None else None
    rows = df.filter(F.col(group).isNotNull()) if groups is None else df.filter(F.col(group).isin(*groups))
    cells = rows.groupBy(F.col(group).alias("grp")).agg(*[F.round(F.avg(F.coalesce(F.array_contains(column, i), F.lit(False)).cast("int")) * 100, 4).alias(str(k)) for k, i in enumerate(items)])
    return _unpivot(cells, items, "item", "pct")


def _unpivot(cells: DataFrame, names: Sequence[str], name: str, value: str, key: str = "grp") -> DataFrame:
    if not names:
        return cells.select(key, F.lit("").alias(name), F.lit(0.0).alias(value)).limit(0)
    pairs_ = F.array(*[F.struct(F.lit(i).alias(name), F.col(str(k)).alias(value)) for k, i in enumerate(names)])
    return cells.select(key, F.inline(pairs_))


def required_vs_optional(df: DataFrame, required: str, optional: str, n: int = 20, n_optional: int | None = None) -> DataFrame:
    """item, required, optional and the required share, for the n most required. With n_optional, optional counts are looked up among that many first ones only, and others count as 0."""
    req, opt = skill_counts(df, required, n).withColumnRenamed("n", "required"), skill_counts(df, optional, n_optional).withColumnRenamed("n", "optional")
    joined = req.join(opt, "item", "left").fillna(0, ["optional"])
    return joined.withColumn("ratio", F.round(F.col("required") / F.greatest(F.col("required") + F.col("optional"), F.lit(1)), 4))


def share_over_time(df: DataFrame, column: str, values: Sequence[str], date: str, unit: str = "month") -> DataFrame:
    """Share of a period's rows that list each value: period, item, share; periods without rows have none."""
    fmt = "yyyy-MM" if unit == "month" else "yyyy-MM-dd"
    cells = df.filter(F.col(date).isNotNull()).groupBy(F.date_format(F.date_trunc(unit, date), fmt).alias("period")).agg(*[F.round(F.avg(F.coalesce(F.array_contains(column, v), F.lit(False)).cast("int")), 4).alias(str(k)) for k, v in enumerate(values)])
    return _unpivot(cells, values, "item", "share", "period")


def quantiles_by_group(df: DataFrame, group: str, value: str, min_count: int = 10, n: int | None = None, *, accuracy: int | None = None, bounded: bool = False) -> DataFrame:
    """count, median and quartiles (exact, linear between ranks) of groups with min_count rows; the highest medians first where n cuts.

    One pass holds a count for each different value of a group. `bounded` takes two or three passes instead, whose counters do not grow with a
    group; it is exact as well. With `accuracy` quantiles are sketches of bounded size, whose ranks are wrong by 1 / accuracy at most.
    """
    shares = (0.25, 0.5, 0.75)
    rows = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    if bounded:
        found = quantiles(rows, [group], value, shares).select(F.col(group).alias("grp"), "n", F.col("quantiles").alias("q"))
    else:
        at = F.array(*map(F.lit, shares))
        q = F.percentile(value, at) if accuracy is None else F.percentile_approx(value, at, accuracy)
        found = rows.groupBy(F.col(group).alias("grp")).agg(F.count("*").alias("n"), q.alias("q"))
    found = found.filter(F.col("n") >= min_count).select("grp", "n", F.col("q")[1].alias("median"), F.col("q")[0].alias("p25"), F.col("q")[2].alias("p75"))
    return top(found, n, F.desc("median"), "grp")


def skill_premium(df: DataFrame, column: str, value: str, min_count: int = 5, n: int = 25, *, accuracy: int | None = None, bounded: bool = False) -> DataFrame:
    """Quantiles of a value by listed element."""
    return quantiles_by_group(_items(df, column), "item", value, min_count, n, accuracy=accuracy, bounded=bounded).withColumnRenamed("grp", "item")


def crosstab(df: DataFrame, a: str, b: str, *, missing: str | None = None) -> DataFrame:
    """a, b, n. Rows with a NULL go, or count as `missing`."""
    if missing is None:
        df = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) if missing is not None else F.col(c)
    return df.groupBy(cell(a).alias("a"), cell(b).alias("b")).agg(F.count("*").alias("n"))


def row_shares(df: DataFrame, row: str, column: str, n_rows: int) -> DataFrame:
    """Percentages of each value within the n_rows most frequent rows. Rows whose values are all NULL stay, without a share."""
    chosen = counts(df, row, n_rows, name="a").select("a")
    cells = crosstab(df, row, column).withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("a")), 4))
    return chosen.join(cells, "a", "left")


def diversity(df: DataFrame, group: str, value: str, min_count: int = 5, n: int = 20) -> DataFrame:
    """Groups with min_count rows by their number of different values."""
    found = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("grp")).agg(F.count("*").alias("n"), F.countDistinct(value).alias("kinds")).filter(F.col("n") >= min_count)
    return top(found, n, F.desc("kinds"), F.desc("n"), "grp")


def per_period(df: DataFrame, date: str, unit: str = "month") -> DataFrame:
    """Rows per month or per week (from Monday)."""
    fmt = "yyyy-MM" if unit == "month" else "yyyy-MM-dd"
    return df.filter(F.col(date).isNotNull()).groupBy(F.date_format(F.date_trunc(unit, date), fmt).alias("period")).agg(F.count("*").alias("n"))


def category_by_group(df: DataFrame, column: str, group: str, n_groups: int = 10) -> DataFrame:
    """Percentage of rows of the most frequent groups whose list holds each category; every category of those rows, zeros too."""
    chosen = counts(df, group, n_groups, name="grp").withColumnRenamed("n", "rows")
    rows = df.select(F.col(group).alias("grp"), F.col(column).alias("cats")).join(F.broadcast(chosen.select("grp")), "grp")
    # exploded as an expression: of a plain column Spark would infer a filter on its size, and compute the list for it once more
    hits = rows.select("grp", F.explode(F.array_distinct("cats")).alias("category"))
    return _category_shares(hits.filter("category IS NOT NULL AND category <> ''").groupBy("grp", "category").agg(F.count("*").alias("hits")), chosen)


def _category_shares(hits: DataFrame, chosen: DataFrame) -> DataFrame:
    # counted once: read both for the categories and for the cells
    hits = written(hits)
    # every category with each of the n_groups groups
    cells = hits.select("category").distinct().crossJoin(F.broadcast(chosen)).join(hits, ["grp", "category"], "left")
    return cells.select("grp", "category", F.round(F.coalesce("hits", F.lit(0)) / F.col("rows") * 100, 4).alias("pct"))


def item_category_by_group(df: DataFrame, column: str, group: str, id_col: str, category: Callable[[Column], Column], n_groups: int = 10, *, other: str = "other") -> DataFrame:
    """`category_by_group` of the categories of lists of different elements, where most elements are `other`: each element is named once, not once per row.

    The lists are written once. Elements with a name of their own meet the rows by element, and only those rows are grouped by `id_col`, which must be
    unique; a row has `other` unless all of its elements are named.
    """
    chosen = counts(df, group, n_groups, name="grp").withColumnRenamed("n", "rows")
    lists = df.select(F.col(id_col).alias("id"), F.col(group).alias("grp"), F.array_compact(column).alias("items"))
    lists = written(lists.withColumn("n", F.size("items"))).join(F.broadcast(chosen.select("grp")), "grp").filter("n > 0")
    items = lists.select("id", "grp", "n", F.explode("items").alias("item"))
    # the different elements are written first: Spark would else push the filter, and with it the naming, below the distinct
    named = written(written(items.select("item").distinct()).withColumn("category", category(F.col("item"))).filter(F.col("category") != other))
    rows = written(items.join(named, "item").groupBy("id", "grp", "n").agg(F.count("*").alias("k"), F.collect_set("category").alias("cats")))
    hits = rows.select("grp", F.explode("cats").alias("category")).groupBy("grp", "category").agg(F.count("*").alias("hits"))
    rest = lists.select("grp", F.lit(1).alias("one")).unionAll(rows.filter("k = n").select("grp", F.lit(-1).alias("one"))).groupBy("grp").agg(F.sum("one").alias("hits"))
    return _category_shares(hits.unionByName(rest.filter("hits > 0").withColumn("category", F.lit(other))), chosen)


def overlap_matrix(df: DataFrame, role: str, column: str, n: int = 25, *, n_roles: int) -> DataFrame:
    """Jaccard percentage of the n most frequent elements of each two of the n_roles most frequent roles; 100 for a role with itself."""
    df = df.join(F.broadcast(counts(df, role, n_roles, name=role).select(role)), role)
    items = _items(df.filter(F.col(role).isNotNull()), column).groupBy(F.col(role).alias("role"), "item").agg(F.count("*").alias("n"))
    first = items.withColumn("k", F.row_number().over(Window.partitionBy("role").orderBy(F.desc("n"), "item"))).filter(F.col("k") <= n)
    # one row per role with at most n elements
    sets = first.groupBy("role").agg(F.collect_set("item").alias("s"))
    a, b = sets.select(F.col("role").alias("a"), F.col("s").alias("x")), sets.select(F.col("role").alias("b"), F.col("s").alias("y"))
    return a.crossJoin(b).select("a", "b", F.round(F.size(F.array_intersect("x", "y")) * 100.0 / F.size(F.array_union("x", "y")), 4).alias("pct"))


def categorical_distribution(df: DataFrame, role: str, column: str, categories: Sequence[str], *, unspecified: bool = True) -> DataFrame:
    """Percentage of a role's rows in each category, of all its rows."""
    names = [*categories, *(["Unspecified"] if unspecified else [])]
    tests = [F.coalesce(F.col(column) == c, F.lit(False)) for c in categories] + ([F.col(column).isNull()] if unspecified else [])
    cells = df.filter(F.col(role).isNotNull()).groupBy(F.col(role).alias("grp")).agg(*[F.round(F.avg(t.cast("int")) * 100, 4).alias(str(k)) for k, t in enumerate(tests)])
    return _unpivot(cells, names, "category", "pct")


def text_share(df: DataFrame, group: str, text: Column, marks: Sequence[str]) -> DataFrame:
    """Percentage of a group's rows whose text holds each mark, blind to case."""
    cells = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("grp")).agg(*[F.round(F.avg(F.coalesce(F.lower(text).contains(m), F.lit(False)).cast("int")) * 100, 4).alias(str(k)) for k, m in enumerate(marks)])
    return _unpivot(cells, marks, "mark", "pct")


def skill_progression(df: DataFrame, column: str, level: str, levels: Sequence[str], n: int = 10, *, missing: str | None = "Mid") -> DataFrame:
    """Percentage of rows of each level that list each of the n most frequent elements."""
    value = F.coalesce(F.col(level), F.lit(missing)) if missing else F.col(level)
    return skill_by_group(df.withColumn("level", value).filter(F.col("level").isin(*levels)), column, "level", n, None).withColumnRenamed("grp", "level")


def casing_map(df: DataFrame, column: str, *, order: str | None = None) -> DataFrame:
    """key (lower case), canonical: the most frequent spelling of each value; ties to the first seen, then the smaller."""
    seen = F.min(order) if order else F.min(column)
    found = df.filter(F.col(column).isNotNull()).groupBy(F.lower(column).alias("key"), F.col(column).alias("canonical")).agg(F.count("*").alias("n"), seen.alias("first"))
    best = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "first", "canonical"))
    return found.withColumn("k", best).filter("k = 1").select("key", "canonical")


def apply_casing(df: DataFrame, column: str, canonical: DataFrame) -> DataFrame:
    known = canonical.select(F.col("key").alias("_key"), F.col("canonical").alias("_canonical"))
    return df.join(known, F.lower(df[column]) == F.col("_key"), "left").withColumn(column, F.coalesce("_canonical", column)).drop("_key", "_canonical")


def top_per_group(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The n most frequent values of every group in one pass."""
    found = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(group).alias("grp"), F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "value")).cast("long")).filter(F.col("rank") <= n)


def overview(df: DataFrame, *, company: str, place: str, date: str, low: str, high: str | None, modality: str) -> DataFrame:
    """One row of totals: rows, different companies and places, first and last date, salary coverage, remote share of known.

    Pay is known where both bounds are; without `high` (the filtered dashboard's definition) where the lower one is.
    """
    known = F.col(low).isNotNull() & (F.col(high).isNotNull() if high else F.lit(True))
    return df.agg(
        F.count("*").alias("total"), F.countDistinct(company).alias("companies"), F.countDistinct(place).alias("places"),
        F.date_format(F.min(date), "yyyy-MM-dd").alias("first"), F.date_format(F.max(date), "yyyy-MM-dd").alias("last"),
        F.round(F.avg(known.cast("int")) * 100, 2).alias("salary_known_pct"),
        F.round(F.try_divide(F.count_if(F.lower(modality) == "remote") * 100.0, F.count(modality)), 2).alias("remote_pct"),
    )


def language_levels(df: DataFrame, column: str = "languages", language: str = "German") -> DataFrame:
    """How often each level of a language is asked for: level, n."""
    return df.select(F.inline(column)).filter(F.col("language") == language).groupBy("level").agg(F.count("*").alias("n"))


def persona_stats(df: DataFrame, tags: dict[str, Column], *, family: str, value: str) -> DataFrame:
    """Per persona: rows, share of all rows, most frequent family, median value. A row may be several personas."""
    tagged = df.withColumn("persona", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tags.items()]))))
    stats = tagged.groupBy("persona").agg(F.count("*").alias("n"), F.percentile(value, 0.5).alias("median"))
    families = top_per_group(tagged, "persona", family, 1).select(F.col("grp").alias("persona"), F.col("value").alias("top_family"))
    return stats.join(families, "persona", "left").crossJoin(F.broadcast(df.agg(F.count("*").alias("rows")))).select("persona", "n", F.round(F.col("n") * 100.0 / F.col("rows"), 1).alias("market_pct"), "top_family", "median")


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per bin of equal width; bin 0 is below, bins + 1 above."""
    return df.filter(F.col(value).isNotNull()).groupBy(F.width_bucket(F.col(value).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum of each group."""
    q = F.percentile(value, F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("grp")).agg(q.alias("q")).select("grp", *[F.col("q")[k].alias(x) for k, x in enumerate(("low", "p25", "median", "p75", "high"))])


def min_max_scaled(df: DataFrame, column: str) -> DataFrame:
    """A column from 0 to 1; equal values give 0."""
    ends = F.broadcast(df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi")))
    return df.crossJoin(ends).withColumn("scaled", F.coalesce(F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))).drop("_lo", "_hi")


def salary_stats(df: DataFrame, low: str, high: str, *group: str) -> DataFrame:
    """count, min, median, quartiles and max of the mean of two bounds, rounded half up."""
    mid = (F.col(low) + F.col(high)) / 2
    q = F.percentile("mid", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    rows = df.filter(F.col(low).isNotNull() & F.col(high).isNotNull()).withColumn("mid", mid)
    found = rows.groupBy(*group).agg(F.count("*").alias("n"), q.alias("q"))
    return found.select(*group, "n", *[round_half_up(F.col("q")[k]).alias(x) for k, x in enumerate(("low", "p25", "median", "p75", "high"))])


def by_row_totals(table: DataFrame, n: int, *, levels: Sequence[str] | None = None) -> DataFrame:
    """Cells a, b, n of a cross-tab as a page shows them: rows by falling total (ties to the smaller), the first n of them, and of `levels` those that these rows have.

    rank counts rows from 1, level the kept columns from 1 in the order of `levels` (of names without it).
    """
    totals = top(table.groupBy("a").agg(F.sum("n").alias("total")), n, F.desc("total"), "a")
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "a")).cast("long"))
    cells = table.filter(F.col("n") > 0).join(F.broadcast(ranked), "a")
    if levels is None:
        place = cells.select("b").distinct().withColumn("level", F.row_number().over(Window.orderBy("b")).cast("long"))
    else:
        kept = F.array(*[F.struct(F.lit(x).alias("b"), F.lit(i).alias("i")) for i, x in enumerate(levels)])
        names = table.sparkSession.range(1).select(F.inline(kept)).join(cells.select("b").distinct(), "b")
        place = names.select("b", F.row_number().over(Window.orderBy("i")).cast("long").alias("level"))
    return cells.join(F.broadcast(place), "b").select("rank", "level", "a", "b", "n", "total")
