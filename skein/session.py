"""What a session needs before the engine's Python functions can run on its executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="skein-"), "skein.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.join("skein", os.path.relpath(full, root)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return spark
