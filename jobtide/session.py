"""The session that the command line, tests and bench use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "jobtide", master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
