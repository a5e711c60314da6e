"""Sends this package to the Python workers of a session, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip file to the session, once. Spark's own file server carries it to the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="orogrid-")) / "orogrid.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, f"orogrid/{p.relative_to(here)}")
    sc.addPyFile(str(target))
    _SENT.add(sc.applicationId)
