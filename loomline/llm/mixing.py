"""Mixing sources to target shares of the total size.

Every record gets a random key, the hash of its id and epoch, and the records of a source are taken in
the order of their keys until the source's budget is reached. The prefix sums are distributed: keys are
cut into ranges, the ranges' token sums (sources x ranges, bounded) are summed up, and only the
range in which a budget ends is summed record by record. No source is sorted as a whole, and a
source that holds a third of all rows is spread over all ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.tokens import VOCABULARY, token_sizes
from loomline.plans.scratch import materialize

#: Ranges of the random key in each source and epoch.
RANGES = 1024


def budgets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, max_repeats, tokens, budget``: the most each source can give with all shares met.

    The total is the largest for which no source is repeated more than its limit. Sources without
    target, with a share of zero or without tokens get no budget; the shares of the rest are scaled to one.
    """
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    wanted = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = wanted.join(have.where("tokens > 0"), "source")  # as many rows as targets
    share = F.col("target_share") / F.sum("target_share").over(Window.partitionBy())
    most = F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1)) * F.col("tokens")
    total = F.min(most / F.col("share")).over(Window.partitionBy())
    return both.withColumn("share", share).withColumn("budget", F.floor(F.col("share") * total + 1e-6)).select("source", "target_share", F.col("max_repeats"), "tokens", "share", "budget")


def mix(df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, vocabulary: str = VOCABULARY) -> DataFrame:
    """``source, key, epoch, n_tokens``: the mix; ``epoch`` is 0 for the first copy of a record, 1 for the second and so on.

    Every source gives whole epochs while its budget lasts, then the records with the smallest random keys whose running sum of
    tokens stays within it. Records with a null or empty text have no tokens and aren't drawn, nor are those without source or target.
    Ids should be unique; rows with an equal id share their key, ties are broken by size. An empty table gives an empty mix.
    """
    sized = token_sizes(df.withColumn("__source", F.col(source)), key, text, "__source", vocabulary=vocabulary)
    sized = materialize(sized.where("n_tokens > 0 and __source is not null").withColumnRenamed("__source", "source"), "mixing-sizes")
    plan = F.broadcast(budgets(sized, targets))  # one row a target
    drawn = sized.join(plan.select("source", "budget", "tokens"), "source").where("budget > 0")
    whole = F.floor(F.col("budget") / F.col("tokens")).cast("int")
    copies = drawn.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    epochs = copies.where("whole > 0").select("source", "id", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "n_tokens")

    # The last epoch is cut: ranges of the key below the cut are whole, the range of the cut is summed by record.
    last = copies.where("rest > 0").withColumn("random", F.xxhash64("id", F.col("whole") + F.lit(seed * 7919)))
    last = last.withColumn("range", F.shiftright(F.col("random"), 54) + RANGES // 2)
    sums = last.groupBy("source", "range").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")
    sums = sums.withColumn("before", before)  # sources x RANGES rows
    state = F.when(F.col("before") + F.col("n") <= F.col("rest"), 1).when(F.col("before") < F.col("rest"), 0).otherwise(-1)
    spans = F.broadcast(sums.withColumn("state", state).where("state >= 0").select("source", "range", "before", "state"))
    placed = last.join(spans, ["source", "range"])
    taken = placed.where("state = 1").select("source", "id", F.col("whole").alias("epoch"), "n_tokens")
    order = Window.partitionBy("source").orderBy("random", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.where("state = 0").withColumn("upto", F.col("before") + F.sum("n_tokens").over(order)).where("upto <= rest")
    edge = edge.select("source", "id", F.col("whole").alias("epoch"), "n_tokens")
    return epochs.unionByName(taken).unionByName(edge).select("source", F.col("id").alias(key), "epoch", "n_tokens")


def mix_report(mixed: DataFrame, targets: DataFrame, key: str = "doc_id") -> DataFrame:
    """``source, target_share, actual_share, tokens, rows, records, most_copies, max_repeats`` of a mix, one row a target."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"), F.count_distinct(key).alias("records"), (F.max("epoch") + 1).alias("most_copies"))
    all_tokens = F.sum("tokens").over(Window.partitionBy())
    out = targets.join(got, "source", "left").fillna(0, ["tokens", "rows", "records", "most_copies"])
    return out.select("source", "target_share", (F.col("tokens") / all_tokens).alias("actual_share"), "tokens", "rows", "records", "most_copies", "max_repeats")


def mix_invariants(mixed: DataFrame, targets: DataFrame, df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY) -> DataFrame:
    """``source, share_met, limit_kept`` of each target: whether the source falls short of its budget by less than its longest record and never
    passes it, and whether no record is repeated beyond the limit."""
    sized = token_sizes(df.withColumn("__source", F.col(source)), key, text, "__source", vocabulary=vocabulary).withColumnRenamed("__source", "source")
    sized = materialize(sized.where("n_tokens > 0 and source is not null"), "mixing-sizes")
    plan = budgets(sized, targets).select("source", "budget", F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1)).alias("most"))
    longest = sized.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    copies = mixed.groupBy("source", key).agg(F.count("*").alias("copies"), F.sum("n_tokens").alias("tokens"))
    got = copies.groupBy("source").agg(F.max("copies").alias("copies"), F.sum("tokens").alias("tokens"))
    both = targets.select("source").distinct().join(plan, "source", "left").join(longest, "source", "left").join(got, "source", "left").fillna(0, ["budget", "longest", "copies", "tokens"])
    short = F.col("budget") - F.col("tokens")
    return both.select("source", ((short >= 0) & ((short == 0) | (short < F.col("longest")))).alias("share_met"), (F.col("copies") <= F.coalesce("most", F.lit(0))).alias("limit_kept"))
