"""Makes this package importable in Python workers, wherever the driver started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a context."""
    if getattr(spark.sparkContext, "_gridloom_core_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    if root.is_dir():
        out = Path(tempfile.mkdtemp(prefix="gridloom-code-")) / "gridloom_core.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(out))
    spark.sparkContext._gridloom_core_shipped = True
