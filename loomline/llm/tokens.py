"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file on the driver, which ships it to the executors; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the splitting pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict[str, object] = {}


def encoder(vocabulary: str = VOCABULARY):  # type: ignore[no-untyped-def]
    """The byte-level BPE of a vocabulary file, loaded once a worker."""
    if vocabulary not in _loaded:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[vocabulary]


def token_sizes(df: DataFrame, key: str, text: str, *keep: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, n_tokens`` and the columns ``keep`` of each row; a null text has none, an empty one 0 tokens."""
    df.sparkSession.sparkContext.addFile(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(SparkFiles.get(os.path.basename(vocabulary)))
        for pdf in batches:
            pdf["n_tokens"] = pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in pdf.pop("body")], dtype="int64")
            yield pdf

    kinds = dict(df.dtypes)
    own = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), *keep, F.col(text).alias("body"))
    shape = ", ".join([f"id {kinds[key]}", *(f"`{c}` {kinds[c]}" for c in keep), "n_tokens bigint"])
    return own.mapInPandas(count, shape)
