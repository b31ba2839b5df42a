"""Validation and statistics of instruction datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import contains_exact, contains_folded, preview

# The fields a sample must have, the words its output is grouped by, and a marker.
REQUIRED = ("instruction", "input", "output", "tools", "tool_calls")
COMPONENTS = ("grid", "chart", "xlsio")
MARKER = "Basic Grid Configuration"
CHECKED_ROWS = 10


def tool_usage(df: DataFrame, calls: str = "tool_calls") -> DataFrame:
    """``tool_name, n_calls``; a call without function or name counts as ``unknown``. Names as they are spelt."""
    one = df.select(F.explode(calls).alias("c"))
    return one.groupBy(F.coalesce("c.function.name", F.lit("unknown")).alias("tool_name")).agg(F.count("*").alias("n_calls"))


def component_counts(df: DataFrame, text: str = "output", words: tuple[str, ...] = COMPONENTS, marker: str = MARKER) -> DataFrame:
    """One row: all samples, those whose text contains each word in any case, and those with the marker. A sample may count several times."""
    counts = [F.count_if(contains_folded(F.col(text), w)).alias(f"n_{w}") for w in words]
    return df.agg(F.count("*").alias("n_samples"), *counts, F.count_if(contains_exact(F.col(text), marker)).alias("n_marker"))


def required_fields(records: DataFrame, column: str = "json", required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """``records`` with ``missing``, the sorted required keys its JSON object lacks, and ``valid``.

    A key with a null value is there. A text that is no JSON object lacks all.
    """
    keys = F.coalesce(F.json_object_keys(F.col(column)), F.array().cast("array<string>"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), keys))
    return records.withColumn("missing", missing).withColumn("valid", F.size("missing") == 0)


def validity_report(checked: DataFrame, key: str, rows: int = CHECKED_ROWS) -> DataFrame:
    """One row over the first ``rows`` records by ``key``: ``n_valid``, ``denominator`` (always ``rows``) and ``n_checked``."""
    first = checked.orderBy(key).limit(rows)
    return first.agg(F.count_if("valid").alias("n_valid"), F.lit(rows).cast("bigint").alias("denominator"), F.count("*").alias("n_checked"))


def sample_previews(df: DataFrame, key: str, rows: int = 2) -> DataFrame:
    """The first ``rows`` samples by ``key`` with the names of their tools and the start of their output."""
    names = F.transform(F.coalesce(F.col("tool_calls"), F.array().cast(df.schema["tool_calls"].dataType)), lambda c: c["function"]["name"])
    return df.orderBy(key, F.col("ingested_at")).limit(rows).select(key, "instruction", F.array_join(names, ",").alias("tools_called"), preview(F.col("output")).alias("output_preview"))


def dataset_stats(df: DataFrame, section: str, instruction: str = "instruction", output: str = "output") -> DataFrame:
    """One row: samples, sections, and mean lengths in characters, which are 0 for an empty dataset."""
    mean = lambda c: F.coalesce(F.avg(F.length(F.coalesce(F.col(c), F.lit("")))), F.lit(0.0))
    return df.agg(F.count("*").alias("total_samples"), F.count_distinct(section).alias("sections_processed"), mean(instruction).alias("avg_instruction_length"), mean(output).alias("avg_output_length"))


def first_rows(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The first ``rows`` by ``order``; a top-k, not a full sort."""
    return df.orderBy(*order).limit(rows)


def numbered(df: DataFrame, partition: str, order: str, name: str = "turn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(partition).orderBy(order)) - 1)


def printed_means(stats: DataFrame, digits: int = 1) -> str:
    """The means of :func:`dataset_stats` as a line for people."""
    row = stats.first()
    return f"samples: {row['total_samples']}, mean instruction length: {row['avg_instruction_length']:.{digits}f}, mean output length: {row['avg_output_length']:.{digits}f}"


def validate_dataset(records: DataFrame, key: str = "place") -> dict[str, DataFrame]:
    """All there is to say about a dataset of JSON objects: ``tool_usage, component_counts, validity, previews``, each a small table.

    ``records`` has the objects as text in ``json`` and their order in ``key``. Objects are read whole; a text that is no object has no fields.
    """
    calls = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"
    read = F.from_json("json", f"instruction string, input string, output string, tools array<string>, tool_calls {calls}")
    samples = records.select(key, read.alias("r")).select(key, "r.*")
    return {
        "tool_usage": tool_usage(samples), "component_counts": component_counts(samples), "validity": validity_report(required_fields(records), key),
        "previews": sample_previews(samples.withColumn("ingested_at", F.lit(None).cast("timestamp")), key),
    }
