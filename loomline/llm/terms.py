"""Frequencies of terms and term sequences by suffix sorting.

Every record is a sequence of terms. Each of its suffixes, cut to ``longest`` terms, is routed by
its first term (and a salt made of its second, so that a term which opens a third of all suffixes
is still spread), and the suffixes of a partition are sorted in reverse lexicographic order. In that
order all suffixes with a common prefix stand together, so one pass with a stack of at most
``longest`` open prefixes gives the count of every n-gram.

Equal suffixes are counted before they are shuffled. The set of records of an n-gram needn't be
carried along: within one record a suffix knows the length up to which its prefixes stood earlier in
that record (if a prefix did, so did all shorter ones); only longer prefixes add one to their
number of records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.deliveries import latest

LONGEST = 3
RARE, COMMON = 5, 0.10
SALTS = 16


def tool_terms(calls: Column) -> Column:
    """Normalised tool names of an array of calls, in order; a missing function or name is ``unknown``."""
    name = lambda c: F.lower(F.regexp_replace(c["function"]["name"], r"^[\s 　​﻿]+|[\s 　​﻿]+$", ""))
    return F.transform(F.coalesce(calls, F.array()), lambda c: F.coalesce(F.when(F.length(name(c)) > 0, name(c)), F.lit("unknown")))


def _suffixes(longest: int):  # type: ignore[no-untyped-def]
    """Of each place: the cut suffix, and the length up to which its prefixes stood earlier in the record; one pass over the record."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        suffix, known, times = [], [], []

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"suffix": pd.Series(suffix, dtype="object"), "known": pd.Series(known, dtype="int32"), "times": pd.Series(times, dtype="int64")})
            suffix.clear()
            known.clear()
            times.clear()
            return out

        for pdf in batches:
            for terms, n in zip(pdf["terms"], pdf["times"], strict=True):
                own = list(terms)
                seen: set[tuple[str, ...]] = set()
                for i in range(len(own)):
                    cut = tuple(own[i : i + longest])
                    depth = 0
                    while depth < len(cut) and cut[: depth + 1] in seen:
                        depth += 1
                    # If a prefix is new, so are all longer ones.
                    seen.update(cut[:k] for k in range(depth + 1, len(cut) + 1))
                    suffix.append(list(cut))
                    known.append(depth)
                    times.append(n)
                if len(suffix) > 20_000:
                    yield flush()
        yield flush()

    return run


def _stack(longest: int):  # type: ignore[no-untyped-def]
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path: list[str] = []
        counts: list[list[int]] = []  # of each open prefix: occurrences, records
        out: list[tuple[list[str], int, int]] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                n, records = counts.pop()
                out.append((list(path), n, records))
                path.pop()
                if counts:
                    counts[-1][0] += n

        for pdf in batches:
            for suffix, known, n in zip(pdf["suffix"], pdf["known"], pdf["n"], strict=True):
                same = 0
                while same < min(len(path), len(suffix)) and path[same] == suffix[same]:
                    same += 1
                close(same)
                for t in suffix[same:]:
                    path.append(t)
                    counts.append([0, 0])
                counts[-1][0] += n
                for depth in range(known, len(path)):
                    counts[depth][1] += n
            if len(out) > 20_000:
                yield _frame(out)
                out = []
        close(0)
        yield _frame(out)

    return run


def _frame(rows: list[tuple[list[str], int, int]]) -> pd.DataFrame:
    return pd.DataFrame({"gram": pd.Series([r[0] for r in rows], dtype="object"), "occurrences": pd.Series([r[1] for r in rows], dtype="int64"), "records": pd.Series([r[2] for r in rows], dtype="int64")})


def term_frequencies(df: DataFrame, terms: str, longest: int = LONGEST) -> DataFrame:
    """``gram ARRAY<STRING>, occurrences BIGINT, records BIGINT`` of every sequence of up to ``longest`` terms.

    ``df`` has one row a record and an array of terms in ``terms``. A null or empty array holds no
    term; null terms must be named by the caller and are left out here. Records of any length are
    counted whole; an empty table gives no rows. Other columns are ignored.
    """
    seq = F.filter(F.coalesce(F.col(terms), F.array().cast("array<string>")), lambda t: t.isNotNull())
    # Equal records are one row with a multiplicity, before their suffixes are made.
    records = df.select(seq.alias("terms")).groupBy("terms").agg(F.count("*").alias("times"))
    made = records.where(F.size("terms") > 0).mapInPandas(_suffixes(longest), "suffix array<string>, known int, times bigint")
    merged = made.groupBy("suffix", "known").agg(F.sum("times").alias("n"))
    salt = F.pmod(F.xxhash64(F.coalesce(F.try_element_at("suffix", F.lit(2)), F.lit(""))), F.lit(SALTS))
    routed = merged.repartition(F.element_at("suffix", 1), salt).sortWithinPartitions(F.col("suffix").desc(), "known")
    partial = routed.mapInPandas(_stack(longest), "gram array<string>, occurrences bigint, records bigint")
    # A prefix whose suffixes were salted apart is counted in several places.
    return partial.groupBy("gram").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def verdicts(freq: DataFrame, total: DataFrame, rare: int = RARE, common: float = COMMON) -> DataFrame:
    """``freq`` with ``verdict``: ``rare`` in fewer than ``rare`` records, ``common`` in more than the share ``common`` of all, else ``kept``.

    ``total`` is one row with the number of all records.
    """
    verdict = F.when(F.col("records") < rare, "rare").when(F.col("records") > common * total.scalar(), "common").otherwise("kept")
    return freq.withColumn("verdict", verdict)


def tool_frequencies(df: DataFrame, longest: int = LONGEST, key: str = "sample_id", calls: str = "tool_calls", order: str = "ingested_at") -> DataFrame:
    """Frequencies and verdicts of tool-name sequences over the samples; each sample counts once, by its latest delivery.

    Samples without calls count in the total.
    """
    once = latest(df.select(F.col(key).alias("id"), F.col(order).alias("seen"), tool_terms(F.col(calls)).alias("terms")), "id", "seen")
    return verdicts(term_frequencies(once, "terms", longest), once.agg(F.count("*").alias("total")))
