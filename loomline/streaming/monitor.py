"""Throughput of an event stream in tumbling event-time windows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.plans.scratch import scratch_dir


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str | None = "10 minutes", time: str = "ts", group: str = "event_type") -> DataFrame:
    """``started, group, n_events`` of a stream; events later than ``late`` behind the newest one are dropped once their window is closed, none if it is null."""
    stamped = events.withColumn("at", F.col(time).cast("timestamp"))
    stamped = stamped.withWatermark("at", late) if late else stamped
    out = stamped.groupBy(F.window("at", width).alias("w"), group).agg(F.count("*").alias("n_events"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("started"), group, "n_events")


def streamed_throughput(spark: SparkSession, folder: str, table: str = "events") -> DataFrame:
    """What has been in the folder up to now, as a stream that ends; each micro-batch rewrites its windows' latest counts.

    Files come in no order of time, so no window is closed before the end: the state is all windows of the folder.
    """
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    # A stream reads folders; a lone file is matched by a pattern.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{folder}/{table}.parque[t]")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}/part")

    query = windowed_counts(stream, late=None).writeStream.outputMode("update").option("checkpointLocation", f"{base}/state").foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    seen = spark.read.schema("started timestamp_ntz, event_type string, n_events bigint, epoch int").option("recursiveFileLookup", "true").parquet(f"{base}/out")
    newest = seen.groupBy("started", "event_type").agg(F.max(F.struct("epoch", "n_events")).alias("m"))
    return newest.select("started", "event_type", F.col("m.n_events").alias("n_events"))
