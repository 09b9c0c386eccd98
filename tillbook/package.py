"""Ships this package to Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import tillbook

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were started without it.

    The driver serves the archive from a folder of its own as long as it runs.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        _SHIPPED[application] = tempfile.TemporaryDirectory(prefix="tillbook-package-")
        package = Path(tillbook.__file__).parent
        spark.sparkContext.addPyFile(shutil.make_archive(f"{_SHIPPED[application].name}/tillbook", "zip", package.parent, package.name))
