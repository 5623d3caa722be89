"""Sends this package to the Python workers, which need not share the driver's folders."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: str | None = None


def ship(spark: SparkSession) -> None:
    """Once per application: functions that run in workers are found by their module's name there."""
    global _SHIPPED
    application = spark.sparkContext.applicationId
    if application == _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED = application
