"""Makes this package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once an application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="fragloom-src-")) / "fragloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, str(Path(root.name) / file.relative_to(root)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
