"""Makes the package importable on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors of this session, once."""
    sc = spark.sparkContext
    if getattr(sc, "_casewright_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="casewright-")) / "casewright_src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(ROOT.rglob("*.py")):
            z.write(f, f.relative_to(ROOT.parent))
    sc.addPyFile(str(archive))
    sc._casewright_shipped = True
