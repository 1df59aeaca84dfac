"""Shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once a Spark application, so that Python functions can be loaded on any node."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="cropmill-code-"), f"{ROOT.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(ROOT.rglob("*.py")):
            z.write(f, f.relative_to(ROOT.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
