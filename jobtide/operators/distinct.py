"""Costly expressions once per different input instead of once per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import written


def input_key(inputs: Sequence[str]) -> list[Column]:
    """128 bits of the inputs as two columns, NULLs told from values."""
    cells = [x for c in inputs for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *cells).alias(name) for name, seed in (("_h1", 7), ("_h2", 11))]


def evaluate_once(df: DataFrame, inputs: Sequence[str], values: Mapping[str, Column], *, id_col: str, parts: Mapping[str, Column] | None = None) -> DataFrame:
    """`df` with the columns of `values`, which are expressions over the columns `inputs` only, each computed once per different inputs.

    `parts` are expressions over the inputs that more than one of the values reads, as columns of these names: a step of their own, so that they are computed
    once a row, not once for each place where an expression has them.

    One row of each group of equal inputs is chosen by (hash, smallest id), two numbers and an id a row, so texts are neither collected nor
    compared; a frequent input costs a row per task there. The chosen rows meet their texts in a semi-join on the id, the expressions run,
    and their results, written once, are joined back by hash. Both sides of that join come from exchanges, so that Spark can split a frequent input.
    `id_col` must be unique. Rows without one are computed by themselves.
    """
    shared = [c.alias(n) for n, c in (parts or {}).items()]
    results = [c.alias(n) for n, c in values.items()]
    keyed = df.select("*", *input_key(inputs))
    chosen = keyed.filter(F.col(id_col).isNotNull()).groupBy("_h1", "_h2").agg(F.min(id_col).alias(id_col)).select(id_col)
    computed = written(keyed.join(chosen, id_col, "left_semi").select("_h1", "_h2", *[F.col(f"`{c}`") for c in inputs], *shared).select("_h1", "_h2", *results))
    known = keyed.filter(F.col(id_col).isNotNull()).join(computed, ["_h1", "_h2"])
    order = [*df.columns, *values]
    if not df.schema[id_col].nullable:
        return known.select(*order)
    return known.select(*order).unionByName(df.filter(F.col(id_col).isNull()).select("*", *shared).select(*df.columns, *results))
