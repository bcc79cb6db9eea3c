"""The package's code for the workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_sent: set[str] = set()  # applications that have the code


def ship(spark: SparkSession) -> None:
    """Send the package to all workers, once per application, so that their tasks can import it."""
    context: SparkContext = spark.sparkContext
    if context.applicationId in _sent:
        return
    path = Path(tempfile.mkdtemp(prefix="textlake-code-")) / "textlake.zip"  # the driver hands it out
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)
