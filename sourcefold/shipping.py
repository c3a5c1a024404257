"""Makes this package importable on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors as a zip, once per application, so that no path need be shared."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="sourcefold-ship-"), "sourcefold_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent))
    context.addPyFile(path)
