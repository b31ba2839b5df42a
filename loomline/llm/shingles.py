"""Vectorised hashing of words, shingles and MinHash bands over batches of texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash

LETTERS_DIGITS = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[^\W\d_]+")
#: Word signs that Latin-1 doesn't have.
_BEYOND = re.compile(r"[^\W\x00-\xff]")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_INTS, _FULL = (int(_MIX), int(_A), int(_B)), 2**64 - 1


def splitter(pattern: re.Pattern, lower: bool = True) -> Callable[[str], list[str]]:
    """All that ``pattern``, a run of one kind of word signs, finds in a text (in lower case), by a table where Latin-1 has all word signs of the text."""
    table = bytes(ord(c.lower() if lower else c) if pattern.fullmatch(c) else 32 for c in map(chr, range(256)))

    def split(text: str) -> list[str]:
        if not text.isascii() and _BEYOND.search(text):
            return pattern.findall(text.lower() if lower else text)
        # Other signs that Latin-1 doesn't have become question marks, which are no word signs either.
        return text.encode("latin-1", "replace").translate(table).decode("latin-1").split()

    return split


#: The words and numbers of a text in lower case.
words_of = splitter(LETTERS_DIGITS)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class WordHasher:
    """64-bit hash of a word, remembered while the worker lives.

    The memory is bounded: past ``room`` words it starts anew.
    """

    def __init__(self, room: int = 400_000) -> None:
        self.room, self.known = room, _Hashes()

    def __call__(self, words: Sequence[str]) -> np.ndarray:
        if len(self.known) > self.room:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x + _MIX
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def mix_one(x: int) -> int:
    """The same scrambling of one value."""
    add, a, b = _INTS
    x = (x + add) & _FULL
    x = ((x ^ (x >> 30)) * a) & _FULL
    x = ((x ^ (x >> 27)) * b) & _FULL
    return x ^ (x >> 31)


def chunks(batches: Iterator[pd.DataFrame], column: str, rows: int = 2000, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The same rows in smaller frames, so that the arrays made of a frame stay small."""
    for pdf in batches:
        size = pdf[column].str.len().fillna(0).cumsum().to_numpy()
        begin = 0
        while begin < len(pdf):
            base = size[begin - 1] if begin else 0
            end = min(begin + rows, max(begin + 1, int(np.searchsorted(size, base + chars, "right"))))
            yield pdf.iloc[begin:end].reset_index(drop=True)
            begin = end


class Batch:
    """The words of many texts in one flat array; ``doc[i]`` is the text of word i."""

    def __init__(self, texts: Sequence[str | None], pattern: re.Pattern, hasher: WordHasher) -> None:
        words, sizes = [], []
        self.words = [pattern.findall(t.lower()) if t else [] for t in texts]
        for own in self.words:
            words += own
            sizes.append(len(own))
        self.n = len(sizes)
        self.size = np.array(sizes, dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]) if self.n else np.zeros(0, np.int64)
        self.hash = hasher(words) if words else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(self.n), self.size)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of each run of ``n`` words within a text."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = mix(h ^ self.hash[k : k + m])
        at = np.nonzero(self.doc[:m] == self.doc[n - 1 :])[0]
        return h[at], self.doc[at], at


def one_permutation_minhash(h: np.ndarray, doc: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation MinHash with rotation densification: an (n, bins) array.

    Texts without any shingle keep the greatest value in every bin.
    """
    top = np.uint64(2**64 - 1)
    sig = np.full(n * bins, top, np.uint64)
    h = mix(h)
    slot = doc * bins + (h % np.uint64(bins)).astype(np.int64)
    np.minimum.at(sig, slot, h // np.uint64(bins))
    sig = sig.reshape(n, bins)
    empty = sig == top
    some = ~empty.all(axis=1)
    far = 1
    while (left := empty & some[:, None]).any() and far < bins:
        moved = np.roll(sig, -far, axis=1)
        take = left & ~np.roll(empty, -far, axis=1)
        sig = np.where(take, mix(moved + np.uint64(far)), sig)
        empty = empty & ~take
        far += 1
    return sig


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` MinHash values."""
    n, bins = sig.shape
    parts = sig.reshape(n, bins // rows, rows)
    key = np.zeros((n, bins // rows), np.uint64)
    for k in range(rows):
        key = mix(key ^ parts[:, :, k])
    return mix(key ^ np.arange(bins // rows, dtype=np.uint64)[None, :])
