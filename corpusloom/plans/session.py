"""What a session needs before Python code of this package can run on its executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        archive = os.path.join(folder, "corpusloom.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, f"{root.name}/{path.relative_to(root)}")
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
