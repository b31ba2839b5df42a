"""Files in and out: Markdown pages, JSON datasets, statistics."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.pages import page_of, section_of
from loomline.operators.validate import validate_dataset

SAMPLE = "instruction string, input string, output string, tools array<string>, tool_calls array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"


def page_scan(spark: SparkSession, root: str, sections: list[str] | None = None) -> DataFrame:
    """``section, page, path, text`` of every ``<section>/page_<digits>.md`` below ``root``; only the named sections are listed."""
    wanted = "{" + ",".join(sections) + "}" if sections else "*"
    raw = spark.read.text(f"{root}/{wanted}/page_*.md", wholetext=True)
    path = F.col("_metadata.file_path")
    return raw.select(section_of(path).alias("section"), page_of(path).alias("page"), path.alias("path"), F.col("value").alias("text")).where("section <> ''")


def sidecar_scan(spark: SparkSession, root: str, sections: list[str] | None = None) -> DataFrame:
    """``section, page, path`` of every ``<section>/page_<digits>.json`` below ``root``; the files are listed, not read."""
    wanted = "{" + ",".join(sections) + "}" if sections else "*"
    as_page = F.regexp_replace("path", r"\.json$", ".md")
    listed = spark.read.format("binaryFile").load(f"{root}/{wanted}/page_*.json").select("path")
    return listed.select(section_of(as_page).alias("section"), page_of(as_page).alias("page"), "path").where("section <> ''")


def with_sidecar(pages: DataFrame, sidecars: DataFrame) -> DataFrame:
    """The pages that have a sidecar of the same section and number."""
    return pages.join(sidecars.select("section", "page"), ["section", "page"], "left_semi")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder, or anything that matches a pattern, is there, on whatever file system the path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_dataset(spark: SparkSession, path: str, schema: str = SAMPLE) -> DataFrame | None:
    """A JSON array file as samples; None where the file is missing or no JSON array. The whole file is parsed once, so that a fault anywhere in it is found."""
    if not exists(spark, path):
        return None
    try:
        df = spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST")
        # Every column is read, for the parser leaves what nobody asks for.
        df.agg(F.count(F.struct(*df.columns)), F.sum(F.xxhash64(*df.columns) % 2)).collect()
        return df
    except Exception:  # noqa: BLE001 - whatever the reader raises, the file can't be read
        return None


def validate_file(spark: SparkSession, path: str) -> tuple[bool, dict[str, DataFrame]]:
    """Whether a JSON array file can be read, which is all the verdict says, and the tables of :func:`validate_dataset`, none where it can't."""
    if read_dataset(spark, path) is None:
        return False, {}
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<variant>")).alias("place", "v"))
    return True, validate_dataset(whole.select("place", F.to_json("v").alias("json")))


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines as text in ``json``, so that missing keys differ from null values."""
    return spark.read.text(path).withColumnRenamed("value", "json")


def write_json_lines(df: DataFrame, path: str, *partitions: str) -> None:
    """JSON Lines in UTF-8, a folder for each value of ``partitions``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).json(path)


def export_json_array(df: DataFrame, path: str, most: int = 10_000) -> int:
    """One JSON array file of a small table, written by the driver; more than ``most`` rows are refused."""
    rows = df.toJSON().take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write JSON Lines instead")
    Path(path).write_text(json.dumps([json.loads(x) for x in rows], indent=2, ensure_ascii=False), encoding="utf-8")
    return len(rows)


def write_stats(stats: DataFrame, path: str) -> None:
    """A one-row table as one JSON object."""
    row = stats.first()
    Path(path).write_text(json.dumps(row.asDict() if row else {}, indent=2, default=str), encoding="utf-8")


def compact_pages(pages: DataFrame, path: str) -> None:
    """Many small pages as Parquet, a folder a section, so that later scans read only the sections they want. A section is spread over several tasks, however large."""
    pages.repartition(F.col("section"), F.pmod(F.xxhash64("path"), F.lit(16))).write.mode("overwrite").partitionBy("section").parquet(path)
