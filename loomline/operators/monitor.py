"""Batches, back-pressure, retries, throughput, sessions and health of a pipeline's runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.operators.ranks import percentiles, running_number


def batches(df: DataFrame, size: int = 32, key: str = "doc_id") -> DataFrame:
    """``key, batch``: batches of ``size`` rows in the order of an integer key, without sorting all rows in one task; null keys are left out."""
    return running_number(df.where(F.col(key).isNotNull()).select(key), key).select(key, F.floor(F.col("number") / size).alias("batch"))


def running_count(df: DataFrame, key: str = "event_id", group: str = "event_type") -> DataFrame:
    """``key, group, done``: how many events of its group were done up to each event. A group may hold most of all rows."""
    known = df.where(F.col(key).isNotNull() & F.col(group).isNotNull()).select(key, group)
    return running_number(known, key, group).select(key, group, (F.col("number") + 1).alias("done"))


def degraded(batch: Column, least: int = 16, factor: float = 0.5) -> Column:
    """The batch size under pressure; it never falls below the least one."""
    return F.greatest(F.lit(least), F.floor(batch * F.lit(factor)).cast("int"))


def backpressure(df: DataFrame, limit: int = 100, threshold: float = 0.8, time: str = "ts", group: str = "event_type") -> DataFrame:
    """``day, group, n_events, pressed, batch_size``: days and groups whose events fill the queue's threshold or more."""
    n = df.groupBy(F.to_date(time).alias("day"), group).agg(F.count("*").alias("n_events"))
    pressed = F.col("n_events") >= F.lit(threshold * limit)
    return n.withColumn("pressed", pressed).withColumn("batch_size", F.when(pressed, degraded(F.lit(32))).otherwise(F.lit(32)))


def retry_schedule(spark: SparkSession, retries: int = 3, delay: float = 1.0, backoff: float = 2.0) -> DataFrame:
    """``attempt, delay_s`` of each retry."""
    return spark.range(retries).select(F.col("id").alias("attempt"), (F.lit(delay) * F.pow(F.lit(backoff), F.col("id").cast("double"))).alias("delay_s"))


def throughput(df: DataFrame, width: str = "1 hour", time: str = "ts", group: str = "event_type") -> DataFrame:
    """``started, group, n_events, total`` of tumbling windows."""
    out = df.groupBy(F.window(F.col(time), width).alias("w"), group).agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").alias("started"), group, "n_events", "total")


def value_percentiles(df: DataFrame, width: str = "1 day", time: str = "ts", value: str = "value") -> DataFrame:
    """``started, n_events, p50, p95`` of a measured value in tumbling windows."""
    own = df.select(F.window(F.col(time), width)["start"].alias("started"), F.col(value).alias("value"))
    counted = own.groupBy("started").agg(F.count("*").alias("n_events"))
    return counted.join(percentiles(own, "value", {"p50": 0.5, "p95": 0.95}, "started"), "started").select("started", "n_events", "p50", "p95")


def sessions(df: DataFrame, gap_s: int = 1800, time: str = "ts", user: str = "user_id") -> DataFrame:
    """``user, started, ended, n_events``: runs of a user's events with less than ``gap_s`` seconds between neighbours.

    Sessions are made within each user and day first, then those that meet are joined, so that a user with most of all
    events is spread over the days. Events without user or time are left out.
    """
    gap = F.make_dt_interval(secs=F.lit(gap_s))
    day = F.to_date(time)
    known = df.where(F.col(user).isNotNull() & F.col(time).isNotNull()).select(user, F.col(time).alias("at"), day.alias("day"))
    within, over = Window.partitionBy(user, "day").orderBy("at"), Window.partitionBy(user).orderBy("started")
    opens = lambda begin, end, w: F.when(begin - F.lag(end).over(w) < gap, 0).otherwise(1)
    run = lambda w: F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = known.withColumn("opens", opens(F.col("at"), F.col("at"), within)).withColumn("k", run(within))
    parts = marked.groupBy(user, "day", "k").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.count("*").alias("n"))
    joined = parts.withColumn("opens", opens(F.col("started"), F.col("ended"), over)).withColumn("k", run(over))
    out = joined.groupBy(user, "k").agg(F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("n").alias("n_events"))
    return out.select(user, "started", "ended", "n_events")


def success_rates(df: DataFrame, group: str = "user_id", kind: str = "event_type", failure: str = "error") -> DataFrame:
    """``group, n_total, n_success, n_failed, success_rate``; the rate is in per cent, rounded to two digits."""
    failed = F.count_if(F.col(kind) == failure)
    return df.groupBy(group).agg(F.count("*").alias("n_total"), (F.count("*") - failed).alias("n_success"), failed.alias("n_failed"), F.round(F.lit(100.0).cast("double") * (F.count("*") - failed) / F.count("*"), 2).alias("success_rate"))


def health(rates: DataFrame, group: str = "user_id", good: float = 90.0, bad: float = 50.0) -> DataFrame:
    """``group, status``: ``success``, ``degraded`` or ``failed`` by the success rate; ``unknown`` without one."""
    r = F.col("success_rate")
    return rates.select(group, F.when(r.isNull(), "unknown").when(r >= good, "success").when(r >= bad, "degraded").otherwise("failed").alias("status"))


def client_totals(df: DataFrame, group: str = "source") -> DataFrame:
    """Totals of client runs, each run counted once; the rate is null where nothing was requested."""
    once = df.where("run_id is not null").groupBy("run_id").agg(*[F.max(c).alias(c) for c in (group, "total_requests", "successful_requests", "failed_requests")])
    total, won = F.sum("total_requests"), F.sum("successful_requests")
    rate = F.round(F.lit(100.0).cast("double") * won / F.nullif(total, F.lit(0)), 2)
    return once.groupBy(group).agg(F.count("*").alias("n_runs"), total.alias("total_requests"), won.alias("successful_requests"), F.sum("failed_requests").alias("failed_requests"), rate.alias("success_rate"))
