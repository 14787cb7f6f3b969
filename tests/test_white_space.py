"""Trimming by a list of signs equals the pattern of Unicode white space."""

import random

from pyspark.sql import functions as F

from jobtide.functions import text


def test_strip_and_squeeze_equal_the_pattern(spark):
    every = [chr(i) for i in range(1, 0x3100)] + ["﻿", "\U0001f600"]
    rng = random.Random(2)
    signs = text.WHITE_SPACE + "ab​᠎\x1c\x1f"
    texts = [f"{c}a{c}{c}b{c}" for c in every] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) for _ in range(2000)] + [None, "", " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    pattern = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    assert df.filter(~text.strip(t).eqNullSafe(pattern(t))).collect() == []
    assert df.filter(~text.squeeze(t).eqNullSafe(pattern(F.regexp_replace(t, r"(?U)\s+", " ")))).collect() == []
