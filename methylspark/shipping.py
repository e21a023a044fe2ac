"""Makes the package importable in Python workers of a session that was started elsewhere."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to executors, unless they find it by PYTHONPATH or the working folder."""
    paths = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    app = spark.sparkContext.applicationId
    if ROOT in paths or app in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="spark-"), "methylspark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "methylspark").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
