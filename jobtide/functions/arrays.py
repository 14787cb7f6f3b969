"""Lists in a cell: parsing, case-blind sets, pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SENTINELS, let, strip

STRINGS = "array<string>"


def parse_list(c: Column, *, strict_json: bool = False) -> Column:
    """ARRAY<STRING> of a JSON list in text; a Python repr is read as well unless `strict_json`. Anything else is an empty list."""
    if strict_json:
        parsed = F.from_json(c, STRINGS, {"allowSingleQuotes": "false"})
    else:
        plain = F.regexp_replace(c, r"(?<=[\[,]\s?)(?:None|nan)(?=\s?[,\]])", "null")
        parsed = F.from_json(F.regexp_replace(F.regexp_replace(plain, r"(?<=[\[,]\s?)True(?=\s?[,\]])", "true"), r"(?<=[\[,]\s?)False(?=\s?[,\]])", "false"), STRINGS)
    return F.coalesce(parsed, F.array().cast(STRINGS))


def first_of_each(items: Column, key) -> Column:
    """The first element of each key, in order, by two sorts."""
    keyed = F.array_sort(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))
    firsts = let(keyed, lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["k"] != e["k"])))
    return F.transform(F.array_sort(F.transform(firsts, lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x")))), lambda e: e["x"])


def ci_distinct(c: Column) -> Column:
    """Stripped elements, blanks and sentinels dropped, the first of each casing kept, in order.

    Equal elements go first, by hash; only lists that still hold one word in two casings are sorted.
    """
    clean = F.array_distinct(F.filter(F.transform(F.array_distinct(c), strip), lambda x: x.isNotNull() & ~x.isin(*SENTINELS)))
    clash = lambda s: F.size(F.array_distinct(F.transform(s, F.lower))) < F.size(s)
    return let(clean, lambda s: F.when(clash(s), first_of_each(s, F.lower)).otherwise(s))


def ci_contains(c: Column, value: str) -> Column:
    return F.coalesce(F.exists(c, lambda x: F.lower(x) == value.lower()), F.lit(False))


def ci_except(c: Column, other: Column, name=lambda x: x) -> Column:
    """Elements of c whose lower-case name is not among the lower-case names of `other`."""
    return let(F.transform(other, lambda x: F.lower(name(x))), lambda taken: F.filter(c, lambda x: ~F.array_contains(taken, F.lower(name(x)))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists as sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def pairs(c: Column) -> Column:
    """Pairs (a, b), a before b, of a list's distinct elements; linear in the number of pairs of one row only."""
    items = F.array_sort(F.array_distinct(c))
    return F.flatten(F.transform(items, lambda a, i: F.transform(F.slice(items, i + 2, F.greatest(F.size(items) - i - 1, F.lit(0))), lambda b: F.struct(a.alias("a"), b.alias("b")))))
