"""Near-duplicate records: word sets with a Jaccard similarity of at least a threshold.

1. Records with equal word sets form a class; only its smallest id, the representative, goes on.
2. Candidates come from a prefix filter, which loses no pair. Words are ordered by rarity (a count
   per hash bucket; any common order is right). Two sets of similarity t share at least c words
   among the first ``m - ceil(2t/(1+t) m) + c`` of the smaller and the first ``n - ceil(t n) + c`` of the
   larger one. Words that few records have are keys by themselves; other words only in pairs, and pairs that many
   smaller sets bring only with a third word. So what a third of all records have is no join key, and
   no key but one of three words is brought by more than about ``ALONE`` smaller sets, however large the corpus.
3. Bayesian pruning while the candidates are joined: MinHash values, one bit each, are compared in
   groups of 64. With a uniform prior, a pair whose posterior probability of reaching the threshold
   falls below ``TOLERANCE`` after a group is dropped.
4. What is left is verified exactly on the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.bitmap import among, bitmap
from loomline.llm.shingles import LETTERS_DIGITS, Batch, WordHasher, chunks, mix
from loomline.operators.deliveries import latest
from loomline.plans.scratch import materialize

SIMILARITY = 0.8
#: Words in buckets with at most so many records are keys by themselves; pairs that at most so many smaller sets bring get no third word.
ALONE = 200
#: Buckets of the rarity sketch: a fixed 4 MB however large the corpus.
SKETCH = 2**20
#: Bits of the maps of hot pairs and of the keys of smaller sets: 8 MB each, however large the corpus.
KEY_BITS = 2**26
#: A candidate may be dropped when it reaches the threshold with less than this probability.
TOLERANCE = 1e-6
SIGNATURE_LONGS = 2


#: Of each permutation: what is added bitwise, and an odd factor. The word hashes are well mixed already.
_PERMUTE = [(mix(np.array([2 * k + 1], np.uint64))[0], mix(np.array([2 * k + 2], np.uint64))[0] | np.uint64(1)) for k in range(64 * SIGNATURE_LONGS)]


def least_matches(bits: int, threshold: float = SIMILARITY, tolerance: float = TOLERANCE) -> int:
    """The fewest equal one-bit MinHash values of ``bits`` with which a pair is kept.

    Equal bits have probability (1 + s) / 2 at similarity s; the prior of s is uniform.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = (1 + s) / 2
    for m in range(bits + 1):
        log = m * np.log(p) + (bits - m) * np.log1p(-p)
        post = np.exp(log - log.max())
        if post[s >= threshold].sum() / post.sum() >= tolerance:
            return m
    return bits


def _word_sets(b: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct word of each text, ordered by text and hash."""
    order = np.lexsort((b.hash, b.doc))
    doc, h = b.doc[order], b.hash[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)  # the upper 20 bits: SKETCH buckets


def _counts(narrow: DataFrame) -> np.ndarray:
    """How many records have a word of each bucket, over all records; an order needs no more than 2^31 - 1."""
    got = narrow.where("bucket is not null").groupBy("bucket").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int32)
    counts[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return counts


def _signature(doc: np.ndarray, h: np.ndarray, n: int, longs: int = SIGNATURE_LONGS) -> np.ndarray:
    """One-bit MinHash: 64 bits of independent permutations a long."""
    out = np.zeros((n, longs), np.uint64)
    if not len(h):
        return out
    first = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])
    own = doc[first]
    for k in range(longs):
        bits = np.zeros(len(own), np.uint64)
        for j in range(64):
            salt, odd = _PERMUTE[k * 64 + j]
            low = np.minimum.reduceat((h ^ salt) * odd, first)
            bits |= (mix(low) & np.uint64(1)) << np.uint64(j)
        out[own, k] = bits
    return out


def _classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The class of each record, a hash of its word set; after them the task's rarity counts, as rows of their own."""
    hasher, counts = WordHasher(), np.zeros(SKETCH, np.int64)
    for pdf in chunks(batches, "body"):
        b = Batch(pdf["body"].tolist(), LETTERS_DIGITS, hasher)
        doc, h = _word_sets(b)
        counts += np.bincount(_bucket(h), minlength=SKETCH)
        size = np.bincount(doc, minlength=b.n)
        # Two independent sums of scrambled hashes: 128 bits that don't depend on the order.
        one, two = np.zeros(b.n, np.uint64), np.zeros(b.n, np.uint64)
        np.add.at(one, doc, mix(h))
        np.add.at(two, doc, mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        yield pd.DataFrame({"id": pdf["id"], "seen": pdf["seen"], "text": pdf["text"], "size": size, "one": one.view(np.int64), "two": two.view(np.int64), "bucket": None, "n": None})
    at = np.nonzero(counts)[0]
    for i in range(0, len(at), 50_000):
        yield pd.DataFrame({"id": None, "seen": pd.NaT, "text": None, "size": None, "one": None, "two": None, "bucket": at[i : i + 50_000], "n": counts[at[i : i + 50_000]]})


def _prefixes(counts: np.ndarray, threshold: float):  # type: ignore[no-untyped-def]
    """Of each record: size, signature, the words of its longest prefix in order of rarity, and their counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in chunks(batches, "body"):
            b = Batch(pdf["body"].tolist(), LETTERS_DIGITS, hasher)
            doc, h = _word_sets(b)
            size = np.bincount(doc, minlength=b.n)
            sig = _signature(doc, h, b.n).view(np.int64)
            rare = counts[_bucket(h)]
            order = np.lexsort((h, rare, doc))
            doc, h, rare = doc[order], h[order], rare[order]
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            inside = np.arange(len(h)) - start[doc] < _reach(size, threshold, 3)[doc]
            ends = np.cumsum(np.bincount(doc[inside], minlength=b.n))[:-1]
            yield pd.DataFrame({"id": pdf["id"], "size": size.astype(np.int32), "words": np.split(h[inside].view(np.int64), ends), "counts": np.split(rare[inside], ends), **{f"s{k}": sig[:, k] for k in range(SIGNATURE_LONGS)}})

    return run


def _reach(size: np.ndarray, threshold: float, shared: int) -> np.ndarray:
    """The prefix of a set in which it shares ``shared`` words with any smaller similar one."""
    return size - np.ceil(threshold * size - 1e-9).astype(np.int64) + shared


def _near(size: np.ndarray, threshold: float, shared: int) -> np.ndarray:
    """The same with any larger similar one."""
    return size - np.ceil(2 * threshold / (1 + threshold) * size - 1e-9).astype(np.int64) + shared


class _Flat:
    """The prefixes of a batch: words, counts, records and ranks."""

    def __init__(self, pdf: pd.DataFrame, threshold: float, alone: int) -> None:
        self.size = pdf["size"].to_numpy(np.int64)
        lengths = pdf["words"].str.len().to_numpy(np.int64)
        self.word = np.concatenate([*pdf["words"], np.zeros(0, np.int64)]).astype(np.int64).view(np.uint64)
        self.rare = np.concatenate([*pdf["counts"], np.zeros(0, np.int64)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(pdf)), lengths)
        self.rank = np.arange(len(self.doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.reach, self.near, self.near3 = _reach(self.size, threshold, 2), _near(self.size, threshold, 2), _near(self.size, threshold, 3)
        self.often = np.nonzero(self.rare > alone)[0]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the first and the second word of all pairs of frequent words in the shorter prefix, and their keys."""
        at = self.often[self.rank[self.often] < self.reach[self.doc[self.often]]]
        first, second, step = [], [], 1
        while len(at) > step and len(same := np.nonzero(self.doc[at[step:]] == self.doc[at[:-step]])[0]):
            first.append(at[same])
            second.append(at[same + step])
            step += 1
        x, y = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (first, second))
        return x, y, mix(mix(self.word[x]) ^ self.word[y])

    def thirds(self, x: np.ndarray, y: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same pairs with each later word of the longest prefix."""
        first, third, keys, step = [], [], [], 1
        last = len(self.doc)
        while len(y):
            good = y + step < last
            x, y, key = x[good], y[good], key[good]
            good = self.doc[y + step] == self.doc[y]
            x, y, key = x[good], y[good], key[good]
            first.append(y)
            third.append(y + step)
            keys.append(mix(key ^ mix(self.word[y + step])))
            step += 1
        return tuple(np.concatenate(p) if p else np.zeros(0, d) for p, d in ((first, np.int64), (third, np.int64), (keys, np.uint64)))  # type: ignore[return-value]


def _keys(threshold: float, most: int, hot: np.ndarray | None = None, wanted: np.ndarray | None = None):  # type: ignore[no-untyped-def]
    """The keys a record brings as the smaller set of a pair, or with ``wanted``, a bitmap of those, all that may meet one.

    Pairs of words in the bitmap ``hot`` are no keys, but in its place those with a third word are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = _Flat(pdf, threshold, most)
            # What one record has can't join two.
            alone = np.nonzero((f.rank < f.reach[f.doc]) & (f.rare > 1) & (f.rare <= most))[0]
            x, y, key = f.pairs()
            many = np.zeros(len(key), bool) if hot is None else among(key, hot)
            second, third, far = f.thirds(x[many], y[many], key[many])
            last = np.concatenate([alone, y[~many], third])
            doc = f.doc[last]
            inner = np.concatenate([
                f.rank[alone] < f.near[f.doc[alone]], f.rank[y[~many]] < f.near[f.doc[y[~many]]],
                (f.rank[second] < f.near[f.doc[second]]) & (f.rank[third] < f.near3[f.doc[third]]),
            ])
            keys = np.concatenate([mix(f.word[alone]), key[~many], far])
            kept = inner if wanted is None else among(keys, wanted)
            own = pdf.drop(columns=["words", "counts"]).iloc[doc[kept]].reset_index(drop=True)
            yield own.assign(key=keys[kept].view(np.int64), pair=(np.arange(len(keys)) >= len(alone))[kept])

    return run


def _pruned(a: str, b: str, threshold: float) -> Column:
    """The incremental comparison: after each 64 bits the pair must still be able to be one."""
    equal, keep = F.lit(0), F.lit(True)
    for k in range(SIGNATURE_LONGS):
        equal = equal + F.lit(64) - F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}")))
        keep = keep & (equal >= least_matches(64 * (k + 1), threshold))
    return keep


def joined_text(*columns: str) -> Column:
    """The fields of a record as one text; a null field has no words."""
    return F.concat_ws("\n", *[F.col(c) for c in columns])


def near_duplicates(df: DataFrame, key: str = "sample_id", texts: tuple[str, ...] = ("instruction", "output"), order: str = "ingested_at", threshold: float = SIMILARITY, alone: int = ALONE) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``key, class_id, text`` (a hash of the raw text) of every record, and ``class_a, class_b, similarity`` between classes.

    A class holds the records with the same words; its id is the smallest key in it. Links lack no
    pair of classes of at least ``threshold`` (but for the pruning's ``TOLERANCE``). Records without any
    word are no one's duplicates: each is its own class. Redelivered records count once. Texts are
    read whole; an empty table gives empty results.
    """
    kinds = dict(df.dtypes)
    base = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(order).alias("seen"), joined_text(*texts).alias("body"))
    passed = base.withColumn("text", F.xxhash64("body")).mapInPandas(_classes, f"id {kinds[key]}, seen {kinds[order]}, text bigint, size bigint, one bigint, two bigint, bucket bigint, n bigint")
    passed = materialize(passed, "neardup-classes")
    counts = _counts(passed)
    classed = latest(passed.where("bucket is null").drop("bucket", "n"), "id", "seen")
    shape = ["size", "one", "two"]
    smallest = classed.where("size > 0").groupBy(*shape).agg(F.min("id").alias("class_id"))
    members = materialize(classed.join(smallest, shape, "left").select("id", F.coalesce("class_id", "id").alias("class_id"), "text", (F.col("size") > 0).alias("worded")), "neardup-members")

    # Written, so that the planner knows their number: few copies are sent to the texts, many are joined by a shuffle.
    copies = materialize(members.where(F.col("id") != F.col("class_id")).select("id"), "neardup-copies")
    reps = base.join(copies, "id", "left_anti")
    columns = ", ".join(f"s{k} bigint" for k in range(SIGNATURE_LONGS))
    prefixes = reps.mapInPandas(_prefixes(counts, threshold), f"id {kinds[key]}, size int, words array<bigint>, counts array<int>, {columns}")
    prefixes = materialize(prefixes, "neardup-prefixes")
    shape = f"id {kinds[key]}, size int, {columns}, key bigint, pair boolean"
    # The smaller set (of equal ones the smaller id) brings only its inner keys; of the other keys only those that meet one are written.
    inner = materialize(prefixes.mapInPandas(_keys(threshold, alone), shape), "neardup-inner")
    crowded = materialize(inner.where("pair").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > alone).select("key"), "neardup-hot")
    hot = None if crowded.isEmpty() else bitmap(crowded, KEY_BITS)
    if hot is not None:
        inner = materialize(prefixes.mapInPandas(_keys(threshold, alone, hot), shape), "neardup-inner")
    outer = materialize(prefixes.mapInPandas(_keys(threshold, alone, hot, bitmap(inner.select("key"), KEY_BITS)), shape), "neardup-keys")
    a, b = inner.alias("a"), outer.alias("b")
    first = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.id") < F.col("b.id")))
    fits = F.col("a.size") >= F.ceil(F.lit(threshold) * F.col("b.size") - 1e-9)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & first & fits & _pruned("a", "b", threshold))
    pairs = pairs.select(F.least("a.id", "b.id").alias("class_a"), F.greatest("a.id", "b.id").alias("class_b")).distinct()
    pairs = materialize(pairs, "neardup-pairs")

    wanted = materialize(pairs.select(F.col("class_a").alias("id")).union(pairs.select(F.col("class_b").alias("id"))).distinct(), "neardup-wanted")
    words = F.array_distinct(F.regexp_extract_all(F.lower("body"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    sets = latest(base.join(wanted, "id", "left_semi"), "id", "seen").select("id", words.alias("words"))
    left, right = sets.select(F.col("id").alias("class_a"), F.col("words").alias("x")), sets.select(F.col("id").alias("class_b"), F.col("words").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "class_a").join(right, "class_b").withColumn("shared", shared)
    similarity = F.col("shared") / (F.size("x") + F.size("y") - F.col("shared"))
    links = both.select("class_a", "class_b", similarity.alias("similarity")).where(F.col("similarity") >= F.lit(threshold) - 1e-12)
    return members.select(F.col("id").alias(key), "class_id", "text"), links


def duplicate_pairs(members: DataFrame, links: DataFrame, key: str = "sample_id") -> DataFrame:
    """``{key}_a, {key}_b``, smaller first: all pairs of records of linked classes, and within a class all pairs whose raw texts differ.

    Only truly equal texts aren't paired with each other: each of them is paired with the smallest key that has the text.
    Rows are as many as there are such pairs.
    """
    one = members.select(F.col(key).alias("id"), "class_id", "text")
    # Few classes have more than one record; written, so that the planner knows their number.
    shared = one.where(F.col("id") != F.col("class_id")).select("class_id").distinct()
    crowd = materialize(one.join(shared, "class_id", "left_semi"), "neardup-crowd")
    texts = crowd.groupBy("class_id", "text").agg(F.min("id").alias("first"))
    copies = crowd.join(texts, ["class_id", "text"]).where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    # Texts are paired before records, so that the equal ones don't meet.
    unlike = texts.select("class_id", F.col("text").alias("x")).join(texts.select("class_id", F.col("text").alias("y")), "class_id").where("x < y")
    left, right = crowd.select("class_id", F.col("text").alias("x"), F.col("id").alias("a")), crowd.select("class_id", F.col("text").alias("y"), F.col("id").alias("b"))
    within = unlike.join(left, ["class_id", "x"]).join(right, ["class_id", "y"]).select("a", "b")
    ends = [one.select(F.col("class_id").alias(f"class_{c}"), F.col("id").alias(c)) for c in ("a", "b")]
    across = links.join(ends[0], "class_a").join(ends[1], "class_b").select("a", "b")
    return copies.union(within).union(across).select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))


def groups(members: DataFrame, links: DataFrame, key: str = "sample_id", rounds: int = 40) -> DataFrame:
    """``key, class_id, group_id, links``: connected groups over the links, and each record's number of links.

    ``group_id`` is the smallest class of the group. Components come from alternating large-star and
    small-star steps on written tables until nothing changes; a hub with many links is reduced by
    aggregation, never gathered. ``links`` counts the classes linked to the record's class. The rounds
    grow with the logarithm of the longest chain; if ``rounds`` don't do, an error is raised rather than half a grouping returned.
    """
    edges = materialize(links.select(F.greatest("class_a", "class_b").alias("u"), F.least("class_a", "class_b").alias("v")), "groups-edges")
    degree = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(down.select("u", F.col("m").alias("v"))).distinct()
        after = materialize(small, "groups-edges")
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    else:
        raise RuntimeError(f"the groups haven't come to rest in {rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("group_id")).withColumnRenamed("u", "class_id")
    out = members.join(roots, "class_id", "left").join(degree, "class_id", "left")
    return out.select(key, "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
