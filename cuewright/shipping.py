"""Makes the package importable for Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, unless they find it by PYTHONPATH or the working folder."""
    context = spark.sparkContext
    known = {os.path.realpath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if os.path.realpath(ROOT) in known or context.applicationId in _shipped:
        return
    at = os.path.join(tempfile.mkdtemp(prefix="package-"), "cuewright.zip")
    with zipfile.ZipFile(at, "w") as out:
        for folder, _, names in os.walk(os.path.join(ROOT, "cuewright")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, ROOT))
    context.addPyFile(at)
    _shipped.add(context.applicationId)
