"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from jobtide import queries

#: Runs first and is not in the sum: work that no change of this package touches, so that files of different machines can be compared.
CALIBRATION = "calibration"
HEADLINE = (
    "skill_counts_top25 skill_cooccurrence_top15 skill_by_family_pct salary_by_group modality_by_state_pct skill_salary_premium overview_kpis persona_stats skill_recommender "
    "url_dedup composite_dedup desc_hash_groups validate_input_flags regex_fields regex_languages location_parse title_normalize clean_html evaluate_confusion invariants_report"
).split()


def calibrate(spark: SparkSession, sf: str) -> float:
    """Seconds of a fixed aggregate and a fixed pattern on lineitem, in plain Spark."""
    began = time.time()
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").repartition(8)
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag")])
    found = rows.withColumn("m", F.regexp_count(text, F.lit("[0-9]{2}"))).groupBy("l_suppkey", "m").agg(F.sum("l_quantity"), F.count("*"))
    found.write.format("noop").mode("overwrite").save()
    return round(time.time() - began, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/nation.parquet").count()
    calibrate(spark, sf)
    took = {CALIBRATION: min(calibrate(spark, sf) for _ in range(3))}
    for name in HEADLINE:
        began = time.time()
        queries.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(t for n, t in took.items() if n != CALIBRATION), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
