"""Stored cells that answer the filtered dashboard without scanning rows.

`build` aggregates rows once into cells of all dimensions, and those cells into the wanted sets of dimensions (all of them by default)
by grouping sets, so rows are read once and the rest of the work is that of the cells. Each set is a folder of its own. A question
names dimensions to group by and values to filter by; it is answered from the stored set with the fewest cells that has all of
these dimensions. NULL is a value of a dimension: a cell's set says which dimensions it has, so a NULL in it is never "all".

Measures are those that can be added up again: counts, sums, minima and maxima. Different values of a column (companies) are kept as
the different combinations with the dimensions, and counted exactly from these.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .filters import multi_filter

_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_FIRST = {"count": F.count_if, "sum": F.sum, "min": F.min, "max": F.max}


class FilterCube:
    """`build` once, or open what was built; `answer`, `count_by`, `crosstab`, `different` and `overview` ask it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/about").collect()  # a row per set, dimension and measure
        self.dims = [r.name for r in sorted((r for r in rows if r.what == "dimension"), key=lambda r: r.number)]
        self.measures = {r.name: r.kind for r in rows if r.what == "measure"}
        self.sizes = {int(r.name): r.number for r in rows if r.what == "set"}
        self.kept = [r.name for r in rows if r.what == "different"]

    @staticmethod
    def build(
        df: DataFrame, path: str, dims: Sequence[str], measures: Mapping[str, tuple[str, Column]], *, different: Sequence[str] = (), sets: Sequence[Sequence[str]] | None = None
    ) -> FilterCube:
        """`measures`: name -> (count, sum, min or max; what of: for counts a condition). `sets`: the sets of dimensions to keep besides the full one."""
        spark, dims = df.sparkSession, list(dims)
        if bad := [k for k, _ in measures.values() if k not in _AGAIN]:
            raise ValueError(f"cannot be added up again: {', '.join(bad)}")
        wanted = [list(c) for n in range(len(dims)) for c in combinations(dims, n)] if sets is None else [list(s) for s in sets]
        if unknown := {c for s in wanted for c in s} - set(dims):
            raise ValueError(f"no dimension {', '.join(sorted(unknown))}")
        code = {c: 1 << i for i, c in enumerate(dims)}
        full = df.groupBy(*dims).agg(*[_FIRST[kind](of).alias(name) for name, (kind, of) in measures.items()])
        full.write.parquet(f"{path}/cells/_set={(1 << len(dims)) - 1}")
        cells = spark.read.parquet(f"{path}/cells/_set={(1 << len(dims)) - 1}")
        again = [_AGAIN[kind](name).alias(name) for name, (kind, _) in measures.items()]
        parts = [s for s in wanted if 0 < len(set(s)) < len(dims)]
        if parts:
            here = sum((F.when(F.grouping(c) == 0, code[c]).otherwise(0) for c in dims), F.lit(0)).cast("int").alias("_set")
            rolled = cells.groupingSets([[F.col(c) for c in s] for s in parts], *[F.col(c) for c in dims]).agg(here, *again)
            rolled.write.partitionBy("_set").mode("append").parquet(f"{path}/cells")
        if [] in wanted:
            cells.agg(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in dims], *again).write.parquet(f"{path}/cells/_set=0")
        for c in different:
            df.filter(F.col(c).isNotNull()).select(*dims, c).distinct().write.parquet(f"{path}/different/{c}")
        counted = {r["_set"]: r["n"] for r in spark.read.parquet(f"{path}/cells").groupBy("_set").agg(F.count("*").alias("n")).collect()}
        # sets of an empty table have no rows but are there
        kept = {sum(code[c] for c in set(s)) for s in wanted} | {(1 << len(dims)) - 1}
        about = [("dimension", c, "", i) for i, c in enumerate(dims)] + [("measure", n, k, 0) for n, (k, _) in measures.items()] + [("set", str(k), "", counted.get(k, 0)) for k in kept] + [("different", c, "", 0) for c in different]
        spark.createDataFrame(about, "what string, name string, kind string, number long").coalesce(1).write.parquet(f"{path}/about")
        return FilterCube(spark, path)

    def smallest(self, dims: Sequence[str]) -> int:
        """The stored set with all these dimensions and the fewest cells."""
        if unknown := set(dims) - set(self.dims):
            raise ValueError(f"no dimension {', '.join(sorted(unknown))}")
        need = sum(1 << self.dims.index(c) for c in set(dims))
        return min((n, s) for s, n in self.sizes.items() if s & need == need)[1]

    def cells(self, dims: Sequence[str]) -> DataFrame:
        chosen = self.smallest(dims)
        if not self.sizes[chosen]:
            return self.spark.read.parquet(f"{self.path}/cells/_set={(1 << len(self.dims)) - 1}").limit(0)
        return self.spark.read.parquet(f"{self.path}/cells/_set={chosen}")

    @staticmethod
    def _active(wanted: Mapping[str, str]) -> dict[str, str]:
        return {c: v for c, v in wanted.items() if any(x.strip() for x in v.split(","))}

    def answer(self, by: Sequence[str] = (), wanted: Mapping[str, str] | None = None) -> DataFrame:
        """by, measures: what grouping the filtered rows would give. `wanted` as in `filters.multi_filter`: values with commas, NULL fails."""
        active = self._active(wanted or {})
        rows = multi_filter(self.cells([*by, *active]), active)
        again = [_AGAIN[k](n).alias(n) for n, k in self.measures.items()]
        found = rows.groupBy(*by).agg(*again) if by else rows.agg(*again)
        return found.withColumns({n: F.coalesce(n, F.lit(0)) for n, k in self.measures.items() if k == "count"})

    def count_by(self, field: str, wanted: Mapping[str, str] | None = None, *, count: str = "n") -> DataFrame:
        """value, n without NULL."""
        return self.answer([field], wanted).filter(F.col(field).isNotNull()).select(F.col(field).alias("value"), F.col(count).alias("n"))

    def crosstab(self, a: str, b: str, wanted: Mapping[str, str] | None = None, *, count: str = "n") -> DataFrame:
        """a, b, n without NULL."""
        found = self.answer([a, b] if a != b else [a], wanted)
        return found.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(count).alias("n"))

    def different(self, column: str, wanted: Mapping[str, str] | None = None) -> DataFrame:
        """n: how many different values of a kept column the filtered rows have."""
        if column not in self.kept:
            raise ValueError(f"the values of {column} are not kept")
        return multi_filter(self.spark.read.parquet(f"{self.path}/different/{column}"), self._active(wanted or {})).agg(F.countDistinct(column).alias("n"))

    def overview(self, wanted: Mapping[str, str] | None = None, *, company: str, modality: str, known_pay: str, count: str = "n") -> DataFrame:
        """total, companies, remote_pct of known modalities, salary_known_pct (of the lower bound, a count measure): one row, percentages 0 where there is nothing."""
        by = self.answer([modality], wanted)
        share = lambda part, of: F.coalesce(F.try_divide(part * 100.0, of), F.lit(0.0))
        rows, named = F.coalesce(F.sum(count), F.lit(0)), F.sum(F.when(F.col(modality).isNotNull(), F.col(count)))
        one = by.agg(rows.alias("total"), share(F.coalesce(F.sum(F.when(F.col(modality) == "Remote", F.col(count))), F.lit(0)), named).alias("remote_pct"), share(F.coalesce(F.sum(known_pay), F.lit(0)), rows).alias("salary_known_pct"))
        return one.crossJoin(F.broadcast(self.different(company, wanted).withColumnRenamed("n", "companies"))).select("total", "companies", "remote_pct", "salary_known_pct")
