"""Arrow functions whose code reaches the Python workers of every executor."""

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import it from the file that Spark distributes, whether or not the
    executors have it installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="redress-")) / "redress-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
