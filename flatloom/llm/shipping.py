"""Making this package importable for the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import flatloom

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's modules to Spark, which hands them to every executor; once per application.

    Needed where the executors do not have the package installed. The archive is made in a folder
    of the driver's alone: Spark serves it from there.
    """
    context = spark.sparkContext
    root = Path(flatloom.__file__).resolve().parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="flatloom-")), "flatloom-modules.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
