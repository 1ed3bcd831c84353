"""Python on the workers: the package is shipped once per application, so that workers need no copy of it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's modules to Spark as a zip, which every worker gets and imports from."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(PACKAGE)}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in sorted(os.walk(PACKAGE)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_batches(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """`mapInArrow` with the package at hand."""
    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def schema_of(rows: DataFrame) -> str:
    """The columns of a frame as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
