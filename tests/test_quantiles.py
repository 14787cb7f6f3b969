"""Refined histograms against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators import analytics, quantiles


def plain(values, q):
    xs = sorted(values)
    p = q * (len(xs) - 1)
    lo, hi = xs[math.floor(p)], xs[math.ceil(p)]
    return lo if p == math.floor(p) else lo + (hi - lo) * (p - math.floor(p))


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_equals_sorted_lists(spark, bits, monkeypatch):
    rng = random.Random(bits)
    kinds = {
        "a": lambda: rng.uniform(-5, 5), "b": lambda: rng.choice([1.0, 2.0]), None: lambda: rng.choice([-1e300, 1e-300, 0.0, -0.0, 1e300, 5e-324]),
        "c": lambda: 7.0, "d": lambda: rng.gauss(60_000, 9_000), "e": lambda: float(rng.randrange(100)),
    }
    rows = [(k, f()) for k, f in kinds.items() for _ in range(rng.choice([1, 2, 37, 90]))] + [("a", None), ("only null", None)]
    df = spark.createDataFrame(rows, "`g r` string, v double")
    at = [0.0, 0.25, 0.5, 0.731, 1.0]
    if bits == 3:
        monkeypatch.setattr(quantiles, "BROADCAST", 0)
    got = {r["g r"]: (r.n, r.quantiles) for r in quantiles.quantiles(df, ["g r"], "v", at, bits=bits).collect()}
    assert set(got) == {k for k, v in rows if v is not None}
    for k, (n, found) in got.items():
        own = [v for g, v in rows if g == k and v is not None]
        assert n == len(own) and found == pytest.approx([plain(own, q) for q in at], rel=1e-12)


def test_counters_do_not_grow_with_a_group(spark, monkeypatch):
    sizes, write = [], quantiles.written

    def keep(df):
        out = write(df)
        if "before" in out.columns and "rank" not in out.columns:
            sizes.append(out.groupBy("lo").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(quantiles, "written", keep)
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_011 / 7).alias("v"))
    got = quantiles.quantiles(df, [], "v", [0.5], bits=6).first()
    assert max(sizes) <= 64 and len(sizes) <= 64 // 6 + 1
    assert got.quantiles[0] == pytest.approx(df.agg(F.percentile("v", 0.5)).first()[0], rel=1e-12)
    sizes.clear()
    many = spark.range(300_000).select((F.col("id") * 7919 % 300_007 / 7 + 1).alias("v"))
    assert quantiles.quantiles(many, [], "v", [0.5]).first().quantiles[0] == pytest.approx(many.agg(F.percentile("v", 0.5)).first()[0], rel=1e-12)
    assert max(sizes) <= 1 << 16 and len(sizes) <= 2


def test_by_group_equals_the_one_pass_form(spark):
    df = spark.range(900).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    one, other = (sorted(map(tuple, analytics.quantiles_by_group(df, "g", "v", bounded=b).collect())) for b in (False, True))
    assert one == other
    with pytest.raises(ValueError):
        quantiles.quantiles(df, ["g"], "v", [1.5])
    assert quantiles.quantiles(df.limit(0), ["g"], "v", [0.5]).collect() == []
