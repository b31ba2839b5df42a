"""Text that was decoded with the wrong encoding, and its restoration.

Every distinct word of the corpus with a character beyond ASCII is garbled under all chains of
(encoding written, encoding read), and the garbled forms are hash-joined with the words observed in
the documents. An observed word that is the garbled form of another corpus word is garbled; a form
that is longer than its original proves itself (bytes read as characters), one of equal length must
be rarer than its original. Besides whole words, bare runs of characters beyond ASCII are looked up,
for signs glued to names no other document has. Replacement characters are always damage.

A word in straight quotation marks whose original is shorter than three letters is an example of
the symptom, not the symptom (unless it was garbled more than once, so that the example itself is
damaged); so is a replacement character followed by its code point.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.bitmap import among, bitmap
from loomline.plans.scratch import materialize

# Encodings a text was written in, and those it was read in, by Python's names.
WRITTEN = ("utf-8", "cp1252", "cp949", "mac_roman", "cp437", "cp850", "cp932", "gbk", "iso8859-15", "koi8_r", "cp1251")
READ = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1250", "iso8859-2", "cp1251", "koi8_r", "cp1253", "cp1254", "iso8859-9", "iso8859-15", "cp932", "cp949", "gbk", "big5", "utf-8")
#: Readings that are applied twice and three times over UTF-8.
AGAIN = ("cp1252", "latin-1", "cp437", "mac_roman")
#: An original in quotation marks shorter than this is an example.
EXAMPLE = 3
#: A single sign must be so many times rarer than the sign it is a misreading of.
RARER = 33
REPLACED = "�"
#: Bits of the map of observed words: 8 MB, however many words there are.
WORD_BITS = 2**26

_WIDE = r"\x{80}-\x{10FFFF}"
WORD = rf'"?(?<![A-Za-z])[A-Za-z]*+[{_WIDE}][A-Za-z{_WIDE}]*"?'
RUN = rf"[{_WIDE}]+"
NAMED_REPLACEMENT = r"\x{FFFD}\s*\((?:U\+|\\u)FFFD\)"
_PYTHON_WORD = re.compile(r"[A-Za-z\u0080-\U0010ffff]*[\u0080-\U0010ffff][A-Za-z\u0080-\U0010ffff]*")


def _read(raw: bytes, encoding: str) -> set[str]:
    """What a reader may make of the bytes: strict, with signs for bad bytes, without them, or as control characters."""
    out = set()
    for errors in ("strict", "replace", "ignore"):
        try:
            out.add(raw.decode(encoding, errors))
        except UnicodeDecodeError:
            continue
    if encoding in ("cp1252", "cp1250", "cp1251", "cp1253", "cp1254"):
        out.add("".join(_single(b, encoding) for b in raw))
    return out


@lru_cache(maxsize=4096)
def _single(b: int, encoding: str) -> str:
    try:
        return bytes([b]).decode(encoding)
    except UnicodeDecodeError:
        return chr(b)


def garbled_forms(word: str) -> dict[str, str]:
    """Each garbled form of ``word`` with the chain that makes it; forms within ASCII tell nothing and are left out."""
    forms: dict[str, str] = {}
    for written in WRITTEN:
        try:
            raw = word.encode(written)
        except UnicodeEncodeError:
            continue
        for read in READ:
            if read == written:
                continue
            for form in _read(raw, read):
                # Reading UTF-8 back restores; only its signs for bad bytes are damage.
                if form != word and not form.isascii() and (read != "utf-8" or REPLACED in form):
                    forms.setdefault(form, f"{written}>{read}")
    level = {word}
    for depth in (1, 2, 3):
        after = set()
        for text in level:
            for read in AGAIN:
                after |= _read(text.encode("utf-8", "surrogatepass"), read)
        level = {x for x in after if len(x) <= 27 * len(word) and not x.isascii()}
        if depth > 1:
            for form in level:
                if form != word:
                    forms.setdefault(form, f"utf-8 x{depth}")
    return forms


def _garble(observed: np.ndarray):  # type: ignore[no-untyped-def]
    """Of each word the garbled forms that may have been observed; the others are left before they are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The hash of the engine's own ``xxhash64``.
        of = lambda x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 42)
        for pdf in batches:
            form, original, chain, seen = [], [], [], []
            for word, n in zip(pdf["word"], pdf["docs"], strict=True):
                if REPLACED in word:
                    continue  # damage is no original
                forms = garbled_forms(word)
                for (f, c), known in zip(forms.items(), among(np.array([of(f) for f in forms], np.uint64), observed), strict=True):
                    if known:
                        form.append(f)
                        original.append(word)
                        chain.append(c)
                        seen.append(n)
            # Typed, for a batch may give no form at all.
            text = lambda x: pd.Series(x, dtype="object")
            yield pd.DataFrame({"word": text(form), "original": text(original), "chain": text(chain), "original_docs": pd.Series(seen, dtype="int64")})

    return run


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(text, NAMED_REPLACEMENT, " "), F.lit(WORD), F.lit(0)))


def _observed(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id, text, word, quoted, whole``, ``text`` a hash of the whole text: the distinct words and runs beyond ASCII of each document."""
    raw = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text"), F.explode(_tokens(F.col(text))).alias("raw"))
    word = F.regexp_replace("raw", '^"|"$', "")
    quoted = F.col("raw").startswith('"') & F.col("raw").endswith('"')
    both = raw.select("id", "text", word.alias("word"), quoted.alias("quoted"))
    runs = F.regexp_extract_all("word", F.lit(RUN), F.lit(0))
    parts = F.concat(F.array(F.struct(F.col("word"), F.lit(True).alias("whole"))), F.transform(F.filter(runs, lambda r: r != F.col("word")), lambda r: F.struct(r.alias("word"), F.lit(False).alias("whole"))))
    return both.select("id", "text", "quoted", F.inline(parts))


def garbled_words(observed: DataFrame) -> DataFrame:
    """``word, whole, original, chain, sure``: each garbled word with its likeliest original.

    ``sure`` tells whether one original only explains the word. ``original`` is null for
    damage no corpus word explains.
    """
    # Copies of one text are one witness, however many there are.
    counted = observed.groupBy("word").agg(F.count_distinct("text").alias("docs"), F.max("whole").alias("whole"))
    counted = materialize(counted, "mojibake-words")
    # Garbling multiplies the words a hundredfold: spread it, keep what may have been observed, and write it, so that the planner knows its size.
    spread = counted.select("word", "docs").repartition(4 * counted.sparkSession.sparkContext.defaultParallelism, "word")
    seen = bitmap(counted.select(F.xxhash64("word").alias("key")), WORD_BITS)
    table = materialize(spread.mapInPandas(_garble(seen), "word string, original string, chain string, original_docs bigint"), "mojibake-forms")
    longer = F.length("word") > F.length("original")
    # One sign is read as another by many chains: that says nothing without letters around it.
    telling = longer | ((F.col("original_docs") > F.col("docs")) & (F.length("word") >= 3) & F.col("whole") & F.col("word").rlike(r"[A-Za-z]|\p{L}{3}"))
    # A sign alone that was read as another one says something only if it is far rarer than its original.
    sign = (F.length("word") == 1) & F.col("whole") & F.col("original").rlike(r"^[\p{S}\p{P}]$") & (F.col("docs") * RARER <= F.col("original_docs"))
    pairs = counted.join(table, "word").where((telling & (F.length("word") > 1)) | sign).select("word", "original", "chain", "original_docs")
    pairs = materialize(pairs, "mojibake-pairs")
    # An original that is garbled itself is only a stage on the way, unless there is no other.
    stage = pairs.select(F.col("word").alias("original"), F.lit(True).alias("stage")).distinct()
    ranked = pairs.join(stage, "original", "left").withColumn("clean", F.col("stage").isNull())
    found = ranked.groupBy("word").agg(
        F.max(F.struct("clean", "original_docs", "original", "chain")).alias("best"), F.count_distinct("original").alias("n"), F.count_distinct(F.when(F.col("clean"), F.col("original"))).alias("n_clean"),
    )
    one = F.coalesce((F.col("n_clean") == 1) | ((F.col("n_clean") == 0) & (F.col("n") == 1)), F.lit(False))
    lost = counted.where(F.col("word").contains(REPLACED)).select("word")
    return found.join(lost, "word", "full").select("word", F.col("best.original").alias("original"), F.col("best.chain").alias("chain"), one.alias("sure"))


def find_garbled(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(hits, words)``: ``key, word, original, chain, sure`` for each garbled word of each document, and the table of garbled words.

    Null and empty texts have none; a document whose only garbled words are examples has none.
    """
    # Written: the words serve the garbled forms, their counts and the documents.
    seen = materialize(_observed(df, key, text), "mojibake-observed")
    words = materialize(garbled_words(seen), "mojibake-garbled")
    hits = seen.join(words, "word")
    example = F.col("quoted") & (F.length(F.coalesce("original", F.lit(""))) < EXAMPLE) & ~F.coalesce("chain", F.lit("")).rlike(" x[23]$")
    return hits.where(~example).select(F.col("id").alias(key), "word", "original", "chain", "sure"), words


def _restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts, left = [], []
        for text, table in zip(pdf["body"], pdf["table"], strict=True):
            known = {w: o for w, o in table}
            lost = 0

            def put(m: re.Match) -> str:
                nonlocal lost
                got = known.get(m[0], "")
                if got:
                    return got
                if got is None:
                    lost += 1
                return re.sub(r"[\u0080-\U0010ffff]+", lambda r: known.get(r[0]) or r[0], m[0])

            texts.append(_PYTHON_WORD.sub(put, text))
            left.append(lost)
        yield pd.DataFrame({"id": pdf["id"], "restored": texts, "unresolved": pd.Series(left, dtype="int64")})


def restore_garbled(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, garbled_words, unresolved, restored``: each affected document with its text as far as it can be restored.

    A word with one possible original is replaced, others stay as they are and count as ``unresolved``
    together with damage no word explains. Nulls, empty texts and empty tables give no rows; documents
    without finding aren't returned. Further columns are ignored.
    """
    hits, _ = find_garbled(df, key, text)
    # All garbled words of a document: bounded by the document itself.
    per = hits.groupBy(key).agg(
        F.count("*").alias("garbled_words"),
        F.collect_list(F.struct("word", F.when(F.col("sure"), F.col("original")).alias("original"))).alias("table"),
    ).withColumnRenamed(key, "id")
    per = materialize(per, "mojibake-affected")
    kind = dict(df.dtypes)[key]
    # Only affected texts are sent anywhere: their ids are few.
    base = df.select(F.col(key).alias("id"), F.col(text).alias("body")).where(F.col("body").isNotNull()).join(per.select("id"), "id", "left_semi")
    done = base.join(per, "id").select("id", "body", F.transform("table", lambda t: F.array(t["word"], t["original"])).alias("table"))
    fixed = done.mapInPandas(_restore, f"id {kind}, restored string, unresolved bigint")
    return fixed.join(per.select("id", "garbled_words"), "id").select(F.col("id").alias(key), "garbled_words", "unresolved", "restored")
