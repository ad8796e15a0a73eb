"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, unless PYTHONPATH already leads there."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    app = spark.sparkContext.applicationId
    if str(ROOT.parent) in paths or app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="roadloom-")) / "roadloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(ROOT.rglob("*.py")):
            z.write(file, file.relative_to(ROOT.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
