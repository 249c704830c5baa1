"""Run this package's Python functions on executors that may not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package as a Python file, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tracelake-")) / "tracelake.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """DataFrame.mapInArrow with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
