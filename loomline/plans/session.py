"""Sessions and what every query expects of one."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Give the executors this package and fix the time zone; does nothing the second time."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return spark
    _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Of repeated keys in a JSON object the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    package = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix="loomline-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(path)
    return spark


def session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("loomline")
    for k, v in {
        "spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": os.environ.get("LOOMLINE_MEMORY", "8g"), "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(k, v)
    return prepare(builder.getOrCreate())
