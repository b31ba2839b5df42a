"""Loggers, metrics and health of the engine itself."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NAME = "loomline"


def create_logger(name: str = NAME, log_level: str = "INFO", log_file: str | None = None) -> logging.Logger:
    """The logger of this name; it writes to ``log_file`` and to no file of an earlier run."""
    logger = logging.getLogger(name)
    logger.setLevel(log_level.upper())
    for h in [h for h in logger.handlers if isinstance(h, logging.FileHandler)]:
        if not log_file or h.baseFilename != os.path.abspath(log_file):
            logger.removeHandler(h)
            h.close()
    if log_file and not any(isinstance(h, logging.FileHandler) for h in logger.handlers):
        handler = logging.FileHandler(log_file, encoding="utf-8")
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        logger.addHandler(handler)
    return logger


class Metrics:
    """Row counts and null counts that are gathered while a table is written, without a pass of their own."""

    def __init__(self, name: str = "metrics") -> None:
        self._observation = Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns])

    def get(self) -> dict[str, int]:
        """Waits for the first action on the watched table."""
        return dict(self._observation.get)


def health(spark: SparkSession) -> dict[str, str]:
    """``{"status": "success"}`` if the session runs a job."""
    try:
        return {"status": "success" if spark.range(1).count() == 1 else "failed"}
    except Exception as e:  # noqa: BLE001 - a broken session may raise anything
        return {"status": "failed", "reason": str(e)[:200]}


def resources(spark: SparkSession) -> dict[str, float]:
    """Executors (the driver's own counts as one), their storage memory in all and what of it is free, and the driver's peak memory, in bytes."""
    import resource

    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    each = []
    while status.hasNext():
        pair = status.next()
        each.append((pair._1(), pair._2()))
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024
    return {"executors": len(each), "memory": sum(a for a, _ in each), "free": sum(b for _, b in each), "driver_peak": peak}
