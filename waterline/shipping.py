"""Sending this package to the executors of a running session."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor the package, once per application, by Spark's own file server.

    Functions that run in Python workers are imported there by name, so this must come before the
    first of them; it costs nothing where the package is installed already.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.TemporaryDirectory(prefix="waterline-")
    # executors fetch it from the driver as long as the session lives
    atexit.register(folder.cleanup)
    archive = os.path.join(folder.name, "waterline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for inner, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(inner, name)
                    out.write(path, os.path.join("waterline", os.path.relpath(path, package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
