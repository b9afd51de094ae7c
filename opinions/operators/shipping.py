"""This package in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, which need not have the repository on their path."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="opinions-"), "opinions.zip")
    with zipfile.ZipFile(path, "w") as package:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)
