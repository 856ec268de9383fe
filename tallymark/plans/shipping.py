"""Send this package to the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import tallymark

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: the Arrow functions import `tallymark` on the
    executors, which do not share the driver's path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(tallymark.__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallymark-"), "tallymark")
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, "tallymark"))
    _shipped.add(app)
