"""Makes the package importable on executors that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds a zip file of the package to the session's Python files, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="sieveline-")) / "sieveline.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    sc.addPyFile(str(at))
    _SHIPPED.add(sc.applicationId)
