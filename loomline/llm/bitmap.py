"""Bitmaps of fixed size that tell which keys may be wanted, so that a pass over a corpus gives few rows.

A bitmap lets pass some keys that aren't wanted, and more of them the more it holds; the join that follows leaves
them. So its size bounds the driver's memory, never the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB, however large the corpus.
BITS = 2**24


def bitmap(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """Where the 64-bit column ``key`` falls: at most ``bits / 64`` rows reach the driver."""
    at = F.col("key").bitwiseAND(F.lit(bits - 1))
    marks = keys.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")).distinct()
    got = marks.groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out.view(np.uint64)


def among(keys: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit ``keys`` may be in the bitmap."""
    at = keys & np.uint64(64 * len(marked) - 1)
    return (marked[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
