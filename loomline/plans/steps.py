"""The pipeline as an ordered registry of lazy steps.

A step takes the run's tables by name and returns those it adds. Nothing runs before a sink or an action asks for it,
but for the comparison of similar documents and the kept conversations, which are written, so that no layout makes them anew.
Batch settings reach the generator (tasks, retries) and the sinks (time limits).
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import generate
from loomline.functions.text import corrected, token_count
from loomline.operators import formats, pages, quality, validate, vectors
from loomline.plans.config import STEPS, PipelineConfig
from loomline.plans.logs import Metrics
from loomline.plans.scratch import materialize
from loomline.plans.timeouts import within
from loomline.sources import files

log = logging.getLogger("loomline")


@dataclass
class Run:
    spark: SparkSession
    config: PipelineConfig
    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: Only these sections' folders are listed; all if there are none.
    sections: list[str] | None = None
    #: Asks a model for each document; without one the built-in template makes the conversations.
    generator: generate.Generator | None = None


def _pages(run: Run) -> dict[str, DataFrame]:
    """Pages with their headers; the path says section and number."""
    scanned = files.page_scan(run.spark, run.config.md_staging_path, run.sections)
    if run.config.md_output_path and files.exists(run.spark, f"{run.config.md_output_path}/*/page_*.md"):
        scanned = scanned.unionByName(files.page_scan(run.spark, run.config.md_output_path, run.sections))
    if run.config.sidecar_path:
        scanned = files.with_sidecar(scanned, files.sidecar_scan(run.spark, run.config.sidecar_path, run.sections))
    if run.config.test_mode:
        scanned = scanned.orderBy("section", "page").limit(run.config.sample_size)
    text = corrected(F.col("text")) if run.config.enable_auto_correction else F.col("text")
    found = scanned.select("section", "page", "path", text.alias("text"))
    heads = pages.header(found, "path").select("path", "document_name", "product", "version")
    return {"pages": found.join(heads, "path")}


def _documents(run: Run) -> dict[str, DataFrame]:
    """Source documents: the pages' titles and bodies without header comment; ``neighbours`` of the query vectors, if there is a table of vectors."""
    body = F.trim(F.regexp_replace("text", r"<!--[\s\S]*?--[>}]", ""))
    title = F.regexp_extract("text", r"(?m)^#\s+(.+)$", 1)
    filled = body.rlike(r"\S").cast("double")
    made = run.tables["pages"].select(F.concat_ws("/", "section", "page").alias("id"), F.col("section").alias("component"), title.alias("title"), body.alias("content"), filled.alias("quality_score"))
    out = {"documents": made.where(token_count(F.col("content")) <= run.config.max_seq_length)}
    if run.config.vectors_path:
        out["neighbours"] = vectors.top_k(run.spark.read.parquet(run.config.vectors_path), run.config.top_k)
    else:
        log.warning("no vectors_path is set: no vectors are searched")
    return out


def _kept(run: Run) -> DataFrame:
    """``id`` of the documents that are good and safe enough and no copy of another one; without a ``toxicity`` column none is unsafe."""
    if "kept" not in run.tables:
        good = quality.quality_filter(run.tables["documents"], least=run.config.min_quality_score)
        if "toxicity" in good.columns:
            good = quality.safety_filter(good, most=run.config.safety_threshold)
        # The comparison has columns ``id`` of its own.
        kept = quality.without_similar(good.withColumnRenamed("id", "doc_id"), "doc_id", "content", run.config.max_similarity_threshold)
        run.tables["kept"] = kept.withColumnRenamed("doc_id", "id")
    return run.tables["kept"]


def _conversations(run: Run) -> dict[str, DataFrame]:
    b = run.config.batch
    mode = generate.GenerationMode.LLM_ASSISTED if run.generator else generate.GenerationMode.TEMPLATE
    return {"conversations": generate.conversations(run.tables["documents"], mode, run.generator, concurrent=b.max_concurrent, retries=b.max_retries, delay=b.retry_delay, backoff=b.retry_backoff_factor)}


def _dataset(run: Run) -> dict[str, DataFrame]:
    scored = run.tables["conversations"].where("conversations is not null").join(_kept(run), "id", "left_semi").join(run.tables["documents"].select("id", "quality_score"), "id")
    made = materialize(quality.capped(scored, run.config.target_count).drop("quality_score"), "pipeline-kept")
    split = quality.split(made, "id", run.config.train_test_split)
    return {name: formats.formatter(name)(made).join(split, "id") for name in run.config.formats}


def _quality(run: Run) -> dict[str, DataFrame]:
    found = quality.funnel(run.tables["documents"], least=run.config.min_quality_score, most=run.config.max_seq_length)
    return {"funnel": found.crossJoin(_kept(run).agg(F.count("*").alias("n_unlike")))}


REGISTRY: dict[str, Callable[[Run], dict[str, DataFrame]]] = dict(zip(STEPS, (_pages, _documents, _conversations, _dataset, _quality), strict=True))


def run_steps(spark: SparkSession, config: PipelineConfig, sections: list[str] | None = None, generator: generate.Generator | None = None) -> Run:
    """The tables of the configured steps, in their order; a step needs those before it."""
    run = Run(spark, config, sections=sections, generator=generator)
    for name in config.steps:
        if name not in REGISTRY:
            raise ValueError(f"step {name!r} doesn't exist")
        log.info("step %s", name)
        run.tables |= REGISTRY[name](run)
    return run


def write_outputs(run: Run) -> list[str]:
    """Write each layout as JSON Lines, a folder a split; returns the folders. A layout that takes longer than the batch timeout is an error."""
    out = []
    for name in run.config.formats:
        if name in run.tables:
            path, metrics = f"{run.config.output_directory}/{name}", Metrics(name)
            watched = metrics.watch(run.tables[name])
            within(run.spark, run.config.batch.batch_timeout, lambda watched=watched, path=path: files.write_json_lines(watched, path, "split"))
            out.append(path)
            log.info("layout %s: %s rows written, %s of %s layouts done", name, metrics.get()["rows"], len(out), len(run.config.formats))
    if "neighbours" in run.tables:
        path = f"{run.config.output_directory}/neighbours"
        files.write_json_lines(run.tables["neighbours"], path)
        out.append(path)
    if "alpaca" in run.tables and run.sections is None:
        # Only a run over all sections writes statistics.
        stats = validate.dataset_stats(run.tables["alpaca"].withColumn("section", F.substring_index("id", "/", 1)), "section")
        files.write_stats(stats, f"{run.config.output_directory}/dataset_stats.json")
    if "funnel" in run.tables and run.sections is None:
        files.write_stats(run.tables["funnel"], f"{run.config.output_directory}/funnel.json")
    return out
