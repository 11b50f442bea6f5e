"""Makes the package known to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors of a session, once; their own path need not have it."""
    sc = spark.sparkContext
    if getattr(sc, "_brambler_shipped", False):
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="brambler-code-")) / "brambler.zip"
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(here.rglob("*.py")):
            out.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(path))
    sc._brambler_shipped = True
