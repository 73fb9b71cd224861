"""Makes the package importable for Python workers, and settles what queries need of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once a context, unless their PYTHONPATH has it already.

    Unions do not keep the partitioning of their inputs: Spark 4.1 may plan a grouping
    without a shuffle on it and then, with inputs coalesced apart, count groups twice.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    package = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="spark-package-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
