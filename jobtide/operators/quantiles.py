"""Exact quantiles of all groups at once in bounded memory, by histograms that are refined until wanted ranks are single values.

A value becomes a 64-bit number of the same order. A pass counts, for each group and range that a wanted rank lies in, the values by
the 16 bits of that number that follow what the range's ends have in common; ranges of at most 65,536 values are counted
by value, which decides their ranks. So a group has at most 65,536 counters a range, whatever its size: a hot group is counted by all
tasks, and tasks hand on counters only. Groups of up to 65,536 rows take two passes (one for sizes), of up to some billion rows three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written

#: Bits that a pass tells apart, and so the logarithm of the counters of a range.
BITS = 16
#: Ranges are broadcast up to this many; beyond it the join shuffles.
BROADCAST = 1 << 16


def ordered_bits(value: Column) -> Column:
    """A long in the order of the double. Minus zero is zero, NaN is above all."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Inner join on keys of which NULL is one, without the right side's keys."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in (*keys, *more)})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(k) == F.col(f"_{k}") for k in more]
    return left.join(other, same).drop(*[f"_{k}" for k in (*keys, *more)]) if same else left.crossJoin(F.broadcast(other))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, at: Sequence[float], *, bits: int = BITS) -> DataFrame:
    """keys, n, quantiles: for each group the values at the given shares (0 to 1), linear between ranks, as an array in the order of `at`.

    NULL values are left out, NULL keys are a group; without keys the whole table is one. No rows, no groups.
    """
    if bad := [q for q in at if not 0 <= q <= 1]:
        raise ValueError(f"not between 0 and 1: {bad}")
    own = [f"k{i}" for i in range(len(keys))]
    v = F.col(f"`{value}`").cast("double")
    rows = df.filter(v.isNotNull()).select(*[F.col(f"`{k}`").alias(o) for k, o in zip(keys, own)], v.alias("v"), ordered_bits(v).alias("b"))
    rows = written(rows)
    sizes = written(rows.groupBy(*own).agg(F.count("*").alias("n"), F.min("b").alias("lo"), F.max("b").alias("hi")).filter("n > 0"))
    places = F.array(*[(F.lit(float(q)) * (F.col("n") - 1)) for q in at])
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))))
    open_ = written(sizes.select(*own, F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("m")))
    done = None
    while True:
        length = F.length(F.bin(F.col("lo").bitwiseXOR(F.col("hi"))))
        shift = F.when(F.col("m") <= (1 << bits), 0).otherwise(F.greatest(length - bits, F.lit(0)))
        spans = written(open_.select(*own, "lo", "hi", shift.cast("int").alias("s")).distinct())
        side = F.broadcast(spans) if spans.count() <= BROADCAST else spans
        met = _joined(rows, side, own).filter(F.col("b").between(F.col("lo"), F.col("hi")))
        bins = met.groupBy(*own, "lo", "s", F.expr("shiftright(b, s)").alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("least"))
        before = F.coalesce(F.sum("c").over(Window.partitionBy(*own, "lo").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counted = written(bins.withColumn("before", before))
        inside = F.col("rank") - F.col("below")
        hit = written(_joined(open_.drop("hi", "m"), counted, own, "lo").filter((inside >= F.col("before")) & (inside < F.col("before") + F.col("c"))))
        found = hit.filter("s = 0").select(*own, "rank", F.col("least").alias("v"))
        done = found if done is None else done.unionAll(found)
        start = F.expr("shiftleft(bin, s)")
        open_ = hit.filter("s > 0").select(*own, "rank", start.alias("lo"), start.bitwiseOR(F.expr("shiftleft(1L, s) - 1")).alias("hi"), (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("m"))
        if open_.isEmpty():
            break
    by_rank = done.groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("values"))
    whole = _joined(sizes.select(*own, "n"), by_rank, own) if own else sizes.select("n").crossJoin(F.broadcast(by_rank))

    def between(p: Column) -> Column:
        low, high = F.element_at("values", F.floor(p)), F.element_at("values", F.ceil(p))
        return F.when(F.floor(p) == F.ceil(p), low).otherwise(low + (high - low) * (p - F.floor(p)))

    return whole.select(*[F.col(o).alias(k) for k, o in zip(keys, own)], "n", F.array(*[between(F.lit(float(q)) * (F.col("n") - 1)) for q in at]).alias("quantiles"))
