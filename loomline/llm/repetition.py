"""Repeated content within a document.

A logistic regression on hashed word and character n-grams is trained on a bounded sample of
labelled rows (``TRAIN_ROWS``), its probabilities are calibrated on rows it hasn't seen, and all
documents are scored in Arrow batches against fixed thresholds. The features are a hashed bag of word n-grams,
one of character n-grams, and for some lengths the share of a document's n-grams that fall into hash
buckets it has hit before. The label is whether the exact share of repeated words reaches ``REPETITIVE``.

The probability is the verdict where it is at least ``SURE``; where it is below ``UNLIKELY`` and the number of distinct
words proves the same, the document isn't repetitive. In between, and where the proof is wanting, the exact share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.shingles import LETTERS, Batch, WordHasher, chunks, mix
from loomline.operators.deliveries import latest

#: Labelled rows to train and calibrate on; the only use of a sample.
TRAIN_ROWS = 4000
#: Repeated runs of at least so many words count.
RUN = 5
#: A document is repetitive from this share of repeated words on.
REPETITIVE = 0.3
#: Fixed thresholds on the calibrated probability.
UNLIKELY, SURE = 0.01, 0.95
WORD_GRAMS = (1, 2, 3)
BAG_WORD_GRAM, BAG_CHAR_GRAM, BAG = 2, 5, 256
SLOTS = np.uint64(2**24 - 1)


def repeated_share(b: Batch, run: int = RUN) -> np.ndarray:
    """Share of each text's words that lie in runs of ``run`` words which stood earlier in it."""
    h, doc, at = b.grams(run)
    covered = np.zeros(len(b.hash) + 1, np.int64)
    if len(h):
        again = _again(h, doc, at)
        np.add.at(covered, at[again], 1)
        np.add.at(covered, at[again] + run, -1)
    hit = np.cumsum(covered)[: len(b.hash)] > 0
    return np.bincount(b.doc, weights=hit, minlength=b.n) / np.maximum(b.size, 1)


def _again(h: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which grams stood earlier in their text."""
    key = mix(h ^ mix(doc.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(h), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return same


def features(texts: list[str | None], hasher: WordHasher) -> tuple[np.ndarray, Batch]:
    b = Batch(texts, LETTERS, hasher)
    cols = []
    for n in WORD_GRAMS:
        h, doc, at = b.grams(n)
        again = _again(h & SLOTS, doc, at) if len(h) else np.zeros(0, bool)
        share = np.bincount(doc, weights=again, minlength=b.n) / np.maximum(np.bincount(doc, minlength=b.n), 1)
        cols += [share, np.log1p(50 * share), (share > 0.2).astype(float)]
    dense = np.stack([*cols, np.log1p(b.size) / 8], axis=1)
    h, doc, _ = b.grams(BAG_WORD_GRAM)
    return np.concatenate([dense, _bag(h, doc, b.n), _bag(*_char_grams(texts, BAG_CHAR_GRAM), b.n)], axis=1), b


def _char_grams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each run of ``n`` characters."""
    codes = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) if t else 0 for t in texts])
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(m, np.uint32)
    for k in range(n):
        h = (h * np.uint32(0x01000193)) ^ codes[k : k + m]
    h ^= h >> np.uint32(15)
    whole = doc[:m] == doc[n - 1 :]
    return h[whole].astype(np.uint64), doc[:m][whole]


def _bag(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Hashed bag of n-grams, each text's logarithms of counts scaled to length one."""
    bag = np.bincount(doc * BAG + (h % np.uint64(BAG)).astype(np.int64), minlength=n * BAG).reshape(n, BAG)
    bag = np.log1p(bag.astype(np.float32))
    return bag / np.maximum(np.linalg.norm(bag, axis=1, keepdims=True), 1)


class Scorer:
    """Logistic regression (ridge, Newton steps) with Platt calibration."""

    def __init__(self) -> None:
        self.w: np.ndarray | None = None
        self.slope, self.offset = 1.0, 0.0

    @staticmethod
    def _newton(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, steps: int = 25) -> np.ndarray:
        w = np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (p - y) + penalty * w
            hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
            step = np.linalg.solve(hess, g)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return w

    def fit(self, x: np.ndarray, y: np.ndarray) -> Scorer:
        """Every other row trains, the rest calibrate. Without both labels nothing is learnt, and every document passes."""
        train, held = np.arange(len(y)) % 2 == 0, np.arange(len(y)) % 2 == 1
        if not (0 < y[train].sum() < train.sum() and 0 < y[held].sum() < held.sum()):
            return self
        one = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        penalty = np.concatenate([np.full(x.shape[1] - 2 * BAG, 0.05), np.full(2 * BAG, 5.0), [0.0]])
        self.w = self._newton(one[train], y[train].astype(float), penalty)
        s = np.stack([one[held] @ self.w, np.ones(held.sum())], axis=1)
        pos, neg = y[held].sum(), (~y[held]).sum()
        target = np.where(y[held], (pos + 1) / (pos + 2), 1 / (neg + 2))
        self.slope, self.offset = self._newton(s, target, np.array([1e-3, 1e-3]))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), 0.5)
        s = x @ self.w[:-1] + self.w[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * s + self.offset, -30, 30)))


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = WordHasher()
    for pdf in chunks(batches, "body"):
        x, b = features(pdf["body"].tolist(), hasher)
        yield pd.DataFrame({"x": list(x.astype(np.float32)), "share": repeated_share(b)})


def train(df: DataFrame, text: str, rows: int = TRAIN_ROWS) -> Scorer:
    """Fit on at most ``rows`` rows of ``df``, those whose texts have the smallest hashes; their features, not their texts, reach the driver.

    Texts above a hash that about ``rows`` texts stay below (with some to spare) are left out by the scan, so that no
    task has to sort the starts of all partitions.
    """
    share = min(1.0, 1.5 * rows / max(1, df.count()))
    cut = int(-(2**63) + share * (2**64 - 1))
    own = df.select(F.col(text).alias("body")).where(F.length("body") > 0).withColumn("h", F.xxhash64("body"))
    picked = own.where(F.col("h") <= F.lit(min(cut, 2**63 - 1))).orderBy("h", "body").limit(rows).select("body")
    got = picked.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInPandas(_label, "x array<float>, share double").toArrow()
    if not len(got):
        return Scorer()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(got), -1).astype(float)
    order = np.lexsort(x.T[:8])  # the same whatever the partitions
    return Scorer().fit(x[order], got["share"].to_numpy()[order] >= REPETITIVE)


def proven(b: Batch) -> np.ndarray:
    """Which texts can't be repetitive: every repeated word stood earlier, so at most the share of words that aren't new is repeated."""
    key = mix(b.hash ^ mix(b.doc.astype(np.uint64)))
    new = np.zeros(len(key), bool)
    new[np.unique(key, return_index=True)[1]] = True
    distinct = np.bincount(b.doc, weights=new, minlength=b.n)
    return b.size - distinct < REPETITIVE * b.size


def repetition(df: DataFrame, key: str = "sample_id", text: str = "output", order: str = "ingested_at", scorer: Scorer | None = None, shares: bool = True) -> DataFrame:
    """``key, probability, evidence, repeated_share, repetitive`` for each record.

    ``evidence`` says what the verdict rests on: ``probability`` or ``share``. With ``shares`` the exact share of every document comes out,
    else it is null where it wasn't asked. Null and empty texts have share 0. Texts are read whole. Redelivered records count
    once; an empty table gives no rows; further columns are ignored.
    """
    model = scorer or train(df, text)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in chunks(batches, "body"):
            x, b = features(pdf["body"].tolist(), hasher)
            p = model.probability(x)
            sure = p >= SURE
            by_score = sure | ((p < UNLIKELY) & proven(b)) | (b.size == 0)
            share = np.where(b.size == 0, 0.0, np.nan)
            ask = np.nonzero(np.ones(len(pdf), bool) if shares else ~by_score)[0]
            if len(ask) == len(pdf):
                share = repeated_share(b)
            elif len(ask):
                share[ask] = repeated_share(Batch([pdf["body"].iloc[i] for i in ask], LETTERS, hasher))
            verdict = np.where(by_score, sure & (b.size > 0), share >= REPETITIVE)
            yield pd.DataFrame({"id": pdf["id"], "seen": pdf["seen"], "probability": p, "evidence": np.where(by_score, "probability", "share"), "repeated_share": pd.Series(share).astype("Float64").where(~np.isnan(share), None), "repetitive": verdict.astype(bool)})

    kinds = dict(df.dtypes)
    own = df.select(F.col(key).alias("id"), F.col(order).alias("seen"), F.col(text).alias("body"))
    scored = latest(own.mapInPandas(score, f"id {kinds[key]}, seen {kinds[order]}, probability double, evidence string, repeated_share double, repetitive boolean"), "id", "seen")
    return scored.select(F.col("id").alias(key), "probability", "evidence", "repeated_share", "repetitive")
