"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """The tool-calling samples, every delivery of every sample."""
    return table(spark, folder, "syncfusion_tool_calling_dataset")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")
