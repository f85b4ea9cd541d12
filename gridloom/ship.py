"""Gives Python workers this package, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the application, once; without effect where it runs from an archive, as that was shipped."""
    context = spark.sparkContext
    top = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not top.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
