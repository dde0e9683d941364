"""Making this repository's packages importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_packages(spark: SparkSession) -> None:
    """Send the packages to all executors, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="narrascope-"), "narrascope.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in ("narrascope", "verification"):
            for folder, _, files in os.walk(os.path.join(ROOT, package)):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, ROOT))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
