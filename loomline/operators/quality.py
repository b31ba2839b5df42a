"""Quality thresholds, duplicates and splits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import split_bucket, token_count
from loomline.plans.scratch import materialize

MIN_QUALITY, MAX_SIMILARITY, MAX_TOKENS, TRAIN_SHARE = 0.7, 0.9, 8192, 0.9
SHINGLE = 5
#: Buckets of the rarity sketch: 4 MB, however many shingles there are.
SKETCH = 2**20


def quality_filter(df: DataFrame, score: str = "quality_score", least: float = MIN_QUALITY) -> DataFrame:
    """Rows with at least the score; an unscored row isn't kept."""
    return df.where(F.col(score) >= least)


def safety_filter(df: DataFrame, score: str = "toxicity", most: float = 0.1) -> DataFrame:
    """Rows with at most the score; a row without score isn't known to be safe and isn't kept."""
    return df.where(F.col(score) <= most)


def length_filter(df: DataFrame, text: str = "text", most: int = MAX_TOKENS) -> DataFrame:
    return df.where(token_count(F.col(text)) <= most)


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` of the survivor of each distinct text (the smallest) and its number of copies; null texts are one group."""
    return df.groupBy(F.md5(F.coalesce(text, F.lit("\0"))).alias("h")).agg(F.min(key).alias(key), F.count("*").alias("n_copies")).select(key, "n_copies")


def split(df: DataFrame, key: str = "doc_id", share: float = TRAIN_SHARE) -> DataFrame:
    """``key, split``: ``train`` or ``test`` by the MD5 of the key, disjoint and complete whatever the order of rows."""
    return df.select(key, F.when(split_bucket(F.col(key)) < int(share * 10_000), "train").otherwise("test").alias("split"))


def funnel(df: DataFrame, score: str = "quality_score", text: str = "content", least: float = MIN_QUALITY, most: int = MAX_TOKENS) -> DataFrame:
    """One row: rows, rows with text, with a score, with enough score, short enough, and passing all."""
    has_text, scored = F.length(F.trim(F.coalesce(text, F.lit("")))) > 0, F.col(score).isNotNull()
    good, short = F.coalesce(F.col(score) >= least, F.lit(False)), token_count(F.col(text)) <= most
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(has_text).alias("n_text"), F.count_if(scored).alias("n_scored"),
        F.count_if(good).alias("n_good"), F.count_if(short).alias("n_short"), F.count_if(has_text & good & short).alias("n_kept"),
    )


def reasons(df: DataFrame, key: str = "id", score: str = "quality_score", text: str = "content") -> DataFrame:
    """``key, reasons``: why a row is rejected, in fixed order, joined by commas; empty for a kept row."""
    has_text = F.length(F.trim(F.coalesce(text, F.lit("")))) > 0
    checks = [(~has_text, "no_text"), (F.col(score).isNull(), "no_score"), (F.col(score) < MIN_QUALITY, "low_score"), (token_count(F.col(text)) > MAX_TOKENS, "too_long")]
    return df.select(key, F.concat_ws(",", *[F.when(c, F.lit(n)) for c, n in checks]).alias("reasons"))


def _rarest(counts: np.ndarray, above: float):  # type: ignore[no-untyped-def]
    """The rarest shingles of each text, as many as a similar text must share one of."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = pdf["g"].str.len().to_numpy(np.int64)
            gram = np.concatenate([*pdf["g"], np.zeros(0, np.int64)]).astype(np.int64)
            doc = np.repeat(np.arange(len(pdf)), size)
            often = counts[gram & (SKETCH - 1)]
            order = np.lexsort((gram, often, doc))
            rank = np.arange(len(gram)) - np.repeat(np.cumsum(size) - size, size)
            # A shingle in a bucket of one text can't join two.
            kept = (rank < (size - np.ceil(above * size - 1e-9).astype(np.int64) + 1)[doc]) & (often[order] > 1)
            at = doc[kept]
            yield pd.DataFrame({"s": gram[order][kept], "id": pdf["id"].to_numpy()[at], "size": size[at]})

    return run


def similar_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", above: float = MAX_SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """``a, b, similarity`` of texts whose sets of ``shingle``-word runs have a Jaccard similarity above ``above``.

    A text with fewer words has one run, all its words; one without words has none. Equal texts meet only through the smallest key that
    has them. Shingles are ordered by how many texts have one of their hash bucket; a pair above the threshold shares one of the rarest
    ``n - ceil(above n) + 1`` of each text, so common shingles are no join keys and the join loses no pair.
    """
    reps = df.where(F.col(text).isNotNull()).groupBy(F.md5(text).alias("h")).agg(F.min(key).alias("id"))
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\S+"), F.lit(0))
    runs = F.sequence(F.lit(1), F.greatest(F.size("w") - shingle + 1, F.lit(1)))
    grams = F.when(F.size("w") > 0, F.transform(runs, lambda i: F.xxhash64(F.array_join(F.slice(F.col("w"), i, shingle), " "))))
    sets = df.join(reps, F.col(key) == F.col("id"), "left_semi").select(F.col(key).alias("id"), words.alias("w")).select("id", F.array_distinct(grams).alias("g"))
    # Written before any filter on it: one that is pushed down would split the words anew for every shingle.
    sets = materialize(sets, "similar-sets").where("g is not null")
    got = sets.select(F.explode("g").alias("s")).groupBy(F.col("s").bitwiseAND(F.lit(SKETCH - 1)).alias("b")).agg(F.least(F.count("*"), F.lit(2**31 - 1)).alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int32)
    counts[got["b"].to_numpy()] = got["n"].to_numpy()
    keyed = materialize(sets.mapInPandas(_rarest(counts, above), f"s bigint, id {dict(df.dtypes)[key]}, size bigint"), "similar-keys")
    a, b = keyed.alias("a"), keyed.alias("b")
    fits = (F.col("a.size") >= F.lit(above) * F.col("b.size")) & (F.col("b.size") >= F.lit(above) * F.col("a.size"))
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.id") < F.col("b.id")) & fits).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    # Written, so that the planner knows their number: the sets of few texts are sent to them.
    pairs = materialize(pairs, "similar-pairs")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("g").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("g").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (shared / (F.size("x") + F.size("y") - shared)).alias("similarity")).where(F.col("similarity") > above)


def without_similar(df: DataFrame, key: str = "doc_id", text: str = "text", above: float = MAX_SIMILARITY) -> DataFrame:
    """``key`` of the texts that are kept: neither a later copy of a text nor the later one of a similar pair. Null texts are kept."""
    later = similar_pairs(df, key, text, above).select(F.col("b").alias("id"))
    reps = df.where(F.col(text).isNotNull()).groupBy(F.md5(text)).agg(F.min(key).alias("id")).select("id")
    kept = reps.join(later, "id", "left_anti").unionByName(df.where(F.col(text).isNull()).select(F.col(key).alias("id")))
    return kept.select(F.col("id").alias(key))


def capped(df: DataFrame, most: int, score: str = "quality_score", key: str = "id") -> DataFrame:
    """The best ``most`` rows by score (unscored last), then key."""
    return df.orderBy(F.col(score).desc_nulls_last(), key).limit(most)


def hash_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``rows`` rows in the order of the MD5 of their key: the same ones on every run."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(rows)


def prefix_length(size: int, above: float) -> int:
    return size - math.ceil(above * size - 1e-9) + 1
