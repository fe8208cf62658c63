"""Makes the library importable in Python workers that were started without it on their path."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp()  # on the driver, from where Spark serves it until the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    to = Path(folder) / "tidemark.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(to))
