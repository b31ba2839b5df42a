"""Exact vector search of a stated set of queries against all rows, in blocks.

Queries and rows are packed into blocks of at most ``BLOCK`` vectors, each block of queries meets each block of
rows once as a matrix product, and only the best ``k`` of a query in a block are shuffled on. No single task
holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048
QUERY_STEP = 50


def _packed(df: DataFrame, prefix: str, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64("id"), F.lit(parts))
    return df.groupBy(part.alias(f"{prefix}_block")).agg(F.collect_list(F.struct("id", "v")).alias(prefix))


def top_k(df: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", step: int = QUERY_STEP) -> DataFrame:
    """``query_id, vec_id, similarity, rank``: for every row whose key is divisible by ``step``, its ``k`` most similar other rows.

    Similarity is the cosine, rounded to five digits; ties go to the smaller key. Null vectors and those of length zero have none.
    """
    base = df.where(F.col(key).isNotNull() & (F.size(vector) > 0)).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = df.count()
    asked = base.where(F.col("id") % step == 0)
    left = _packed(asked, "q", max(1, -(-rows // (step * BLOCK)) * 2))
    right = _packed(base, "r", max(1, -(-rows // BLOCK) * 2))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for q, r in zip(pdf["q"], pdf["r"], strict=True):
                qi, ri = np.array([x["id"] for x in q]), np.array([x["id"] for x in r])
                a, b = np.array([x["v"] for x in q], float), np.array([x["v"] for x in r], float)
                norm = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
                with np.errstate(invalid="ignore", divide="ignore"):
                    sim = np.round(np.where(norm > 0, a @ b.T / norm, -np.inf), 5)
                sim[qi[:, None] == ri[None, :]] = -np.inf
                for i in range(len(qi)):
                    best = np.lexsort((ri, -sim[i]))[:k]
                    best = best[np.isfinite(sim[i][best])]
                    yield pd.DataFrame({"query_id": qi[i], "vec_id": ri[best], "similarity": sim[i][best]})

    found = left.crossJoin(right).select("q", "r").mapInPandas(score, "query_id bigint, vec_id bigint, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest_centroid(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key, label, nearest``: each vector's label and that of the most similar centroid, ties to the smaller label. Labels are few and are broadcast as one row."""
    flat = df.select(label, F.posexplode(vector).alias("dim", "x")).groupBy(label, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    packed = flat.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda e: e["m"]).alias("c"))
    every = packed.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), "c"))).alias("all")).scalar()
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(dot(a, a))
    scored = F.transform("all", lambda e: F.struct(F.round(-dot(F.col(vector), e["c"]) / norm(e["c"]), 5).alias("s"), e["l"].alias("l")))
    return df.select(key, label, vector, every.alias("all")).select(key, label, F.array_min(scored)["l"].alias("nearest"))


def centroids(df: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """``label, dim, mean``: the mean of each dimension of each label's vectors, dimensions from 0."""
    flat = df.select(label, F.posexplode(vector).alias("dim", "x"))
    return flat.groupBy(label, "dim").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))
