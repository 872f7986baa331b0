"""Bring this package to executors that do not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors of the session, once; Spark serves the archive from the driver.

    For clusters on which it is not installed.  Tasks import the kernels of the operators from it.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="seriesloom-package-"), "seriesloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
