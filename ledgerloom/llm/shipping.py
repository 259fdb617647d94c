"""Brings the library to the executors where they cannot import it already."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application, once.

    Nothing is done where ``PYTHONPATH`` names the library: then the workers have it too.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-code-"), "ledgerloom_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "ledgerloom").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
