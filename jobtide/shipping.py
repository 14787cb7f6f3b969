"""The package for Python workers: executors need not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession | None) -> None:
    """Add a zip of this package to the session's files, once for each Spark context."""
    if spark is None or getattr(spark.sparkContext, "_jobtide_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "jobtide.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    out.write(whole, os.path.join("jobtide", os.path.relpath(whole, top)))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._jobtide_shipped = True
