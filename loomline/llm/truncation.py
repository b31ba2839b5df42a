"""Texts cut off before their end, and how often each source cuts.

Texts that end in a final mark, a closed block or a full table row are whole. For every other text the
evidence comes in this order:

1. *Alignment*. A text that was cut equals the start of its near-copy, so not the whole texts are
   compared but the stretches up to the same three words, the *seam* before the last word. Every place of
   every text where a seam wanted by some open text stands gets MinHash bands of the five-word shingles
   before it (a running minimum gives those of all places at once); the open text gets the bands of its
   own stretch. So a copy cut at a tenth is found as surely as one cut at its last word. Of the texts of a
   bucket that go on alike one stands for all, so a hot bucket costs its open texts times its different
   continuations; where that one doesn't reach the similarity, the others of the bucket follow. Pairs whose
   stretches reach the wanted similarity are aligned at the seam: the text is cut if its copy goes on
   within the word or the sentence.
2. *Structure*: an open code fence, a table row without its closing bar, an empty list item, an open
   bracket or a trailing comma can't end a text.
3. *Closing-word terminality*: how often the closing words (up to three, names and numbers generalised)
   end a sentence within the whole corpus. Words never seen before the end of a text are fragments. A text's own
   open end is no evidence, with dots after it or without: else the fragments that cuts leave before dots would count as
   ends, more of them the larger the corpus. Dots end a text where the words before the last one mostly lead to it and dots.

The contexts and seams that any open text asks for are marked in a bitmap of fixed size, so that the pass over
the corpus counts only what may be asked for; what the bitmap lets pass without need is left by the joins.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.bitmap import among, bitmap
from loomline.llm.shingles import LETTERS_DIGITS, WordHasher, chunks, mix, mix_one, words_of
from loomline.operators.deliveries import latest
from loomline.plans.scratch import materialize

#: What may be said of a question, a text and the text's words in lower case.
Label = Callable[[str | None, str | None, list[str]], str | None]
WHOLE, CUT, OPEN = 0, 1, 2
SHINGLE = 5
SIMILARITY = 0.8
#: Bands of MinHash values over a stretch: a pair of the wanted similarity shares one with probability 0.998.
BANDS, ROWS = 9, 3
#: Words before the last one that must be equal in both texts.
SEAM = 3
#: Bits of the map of wanted bands: 8 MB, however large the corpus.
BAND_BITS = 2**26
#: A closing context seen less often than this says too little; a shorter one is asked.
LEAST_SEEN = 5
#: A context that ends a sentence in a smaller share of its places is no end.
LEAST_TERMINAL = 0.08
#: Dots are an end where at least this share of the places of the words before lead to the last word and dots.
LEAST_DOTTED = 0.5

# Marks that end a sentence, and what may close after them.
FINAL_MARKS = ".!?…。！？｡"
CLOSERS = "\"'”’»)]*_`>"
#: Stand-ins for a missing text; they are empty, not cut.
STAND_INS = ("none", "null", "nil", "nan", "na", "n/a", "todo", "tbd", "no answer", "empty", "undefined", "answer", "response", "output", "-", "[]", "{}")

_DOTS = re.compile(r"(?:\.{3,}|…)\Z")
#: No stand-in for a missing text has more words.
MOST_WORDS = 8
_MARKUP = re.compile(r"```[\w#+.-]*|</?\w+[^<>]*>")
_FENCE = re.compile(r"^[ \t]*(```+|~~~+)", re.M)
#: A fence that names its language opens a block: it doesn't close one that was cut open.
_CODE = re.compile(r"```.*?(?:```(?!(?<=\n```)[\w#+.-]+[ \t]*(?:\n|\Z))|\Z)", re.S)
_TOKEN = re.compile(r"[぀-ヿ一-鿿]|\w+|[.!?…。！？｡]+|\n+|[^\s\w]")
_CAMEL = re.compile(r"[a-z0-9][A-Z]")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_PARTS = re.compile(rf"{_PART.pattern}|\n")
_NAMES = re.compile(r"\s*(?:[-*+]\s+|[^\W\d_][\w ]{0,40}:\s*)?`?[A-Z][a-z0-9]+[A-Z]\w*`?(?:\s*,\s*`?[A-Z][a-z0-9]+[A-Z]\w*`?)*\s*")
_END = frozenset(FINAL_MARKS)
_STOPS = frozenset(".!?。！？｡")
_H = xxhash.xxh64_intdigest
_DOT = np.uint64(_H("\x05"))
_KINDS = {x: _H(x) for x in ("\x01number", "\x01name")}


def _norm(token: str) -> str:
    """Names and numbers stand for their kind; other words are themselves in lower case."""
    if token.isascii():
        if token.isdigit():
            return "\x01number"
        if _CAMEL.search(token) or ("_" in token and len(token) > 1):
            return "\x01name"
    return token.lower()


def _is_word(token: str) -> bool:
    return token[0].isalnum() or token[0] == "_"


class _Known(dict):
    """Numbers by token; a new token is given the next one."""

    def __init__(self, add: Callable[[str], int]) -> None:
        self.add = add

    def __missing__(self, token: str) -> int:
        n = self[token] = self.add(token)
        return n


class _Lexicon:
    """Number, hashes, kind, first letter and name parts of each token, remembered up to a bounded number.

    Kinds: 0 a mark, 1 a word, 2 the end of a sentence or line. Token 0 stands between two texts.
    """

    def __init__(self, room: int = 300_000) -> None:
        self.room = room
        self._begin()

    def _begin(self) -> None:
        self.known = _Known(self._add)
        self.hash, self.plain, self.kind, self.first = array("Q"), array("Q"), array("b"), array("I")
        self.low: list[str] = []
        # Names and their numbers; their parts are told for all of them at once.
        self.names: tuple[list[str], list[int]] = ([], [])
        self.often = np.zeros(self.room, np.int64)
        self.known[""]

    def numbers(self, tokens: list[str]) -> list[int]:
        return list(map(self.known.__getitem__, tokens))

    def _add(self, token: str) -> int:
        n, low = len(self.hash), token.lower()
        plain = _H(low)
        norm = _norm(token)
        self.hash.append(_H("\x04") if not token else plain if norm == low else _KINDS[norm])
        self.low.append(low)
        self.plain.append(plain)
        self.first.append(ord(low[0]) if low else 0)
        self.kind.append(0 if not token else 1 if _is_word(token) else 2 if token[0] in _END or token[0] == "\n" else 0)
        if norm == "\x01name":
            self.names[0].append(token)
            self.names[1].append(n)
        return n

    def saw(self, numbers: np.ndarray) -> None:
        if len(self.hash) > len(self.often):
            self.often = np.concatenate([self.often, np.zeros(len(self.hash), np.int64)])
        self.often += np.bincount(numbers, minlength=len(self.often))

    def name_parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, places and ends of the parts of all names seen; what was seen is forgotten."""
        parts: list[str] = []
        known = _Known(lambda part: parts.append(part) or len(parts) - 1)
        known["\n"]  # 0: the end of a name
        part = np.array(list(map(known.__getitem__, _PARTS.findall("".join(f"{name}\n" for name in self.names[0])))), np.int64)
        end = np.append(part == 0, [True, True])
        times = self.often[np.array(self.names[1], np.int64)[(np.cumsum(end) - end)[: len(part)]]]
        one = np.nonzero(~end[:-2])[0]
        two = one[~end[one + 1]]
        # Few pairs of neighbours are distinct.
        code, pairs = pd.factorize(part[two] * len(parts) + part[two + 1])
        part_hash = [_H("\x02" + x) for x in parts] + [_H(f"\x03{parts[i]} {parts[j]}") for i, j in zip(*(x.tolist() for x in np.divmod(pairs, len(parts))), strict=True)]
        at = np.concatenate([part[one], code + len(parts)])
        weights = np.concatenate([times[one], times[two]])
        places = np.bincount(at, weights=weights, minlength=len(part_hash))
        ends = np.bincount(at, weights=weights * np.concatenate([end[one + 1], end[two + 2]]), minlength=len(part_hash))
        seen = np.nonzero(places)[0]
        key = np.array(part_hash, np.uint64)[seen]
        if len(self.hash) > self.room:
            self._begin()
        else:
            self.often[:] = 0
        return key, places[seen], ends[seen]


def _tally(key: np.ndarray, places: np.ndarray | None, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, flat = pd.factorize(key)
    return flat, np.bincount(code, weights=places, minlength=len(flat)), np.bincount(code, weights=ends, minlength=len(flat))


def _prose(text: str) -> str:
    """The text without code and table rows."""
    text = _CODE.sub("\n", text) if "```" in text else text
    return "\n".join(x for x in text.split("\n") if not x.lstrip().startswith("|")) if "|" in text else text


def _prose_words(text: str) -> list[str]:
    """The words of the prose in lower case: what is aligned."""
    return [t.lower() for t in _TOKEN.findall(_prose(text)) if t[0].isalnum() or t[0] == "_"]


def _last_line(text: str) -> str:
    return text.rstrip("\n\r").rsplit("\n", 1)[-1]


def is_empty(text: str | None) -> bool:
    """Nothing there, or only blanks, bare markup or a stand-in for a missing value."""
    if text is None:
        return True
    bare = _MARKUP.sub(" ", text) if "<" in text or "```" in text else text
    # Format and control characters (zero-width space, byte order mark) are blanks too.
    words = [m[0] for m in islice(LETTERS_DIGITS.finditer(bare), MOST_WORDS + 1)]
    if len(words) > MOST_WORDS:
        return False
    core = " ".join(words).lower()
    return not core or core in STAND_INS or core.replace(" ", "") in ("na", "none", "null", "todo", "tbd") or text.strip().lower() in STAND_INS


def _last_words(text: str, n: int) -> list[str]:
    """The last ``n`` words in folded case, found without reading a long text from its start."""
    window = 256
    while True:
        words = LETTERS_DIGITS.findall(text[-window:])
        if len(words) > n or window >= len(text):
            return [w.casefold() for w in words[-n:]]
        window *= 4


def structure(text: str | None, instruction: str | None = None) -> int:
    """WHOLE, CUT or OPEN, as far as the text's own structure tells."""
    if text is None:
        return WHOLE
    bare = text.rstrip()
    # Most texts end in a final mark and have neither blocks nor table rows at their end: nothing below says otherwise of them.
    if bare[-1:] in _STOPS and "```" not in text and "~~~" not in text and bare[-2:-1] not in _STOPS and _last_line(bare).lstrip()[:1] not in ("|", "<"):
        return WHOLE
    if is_empty(text):
        return WHOLE
    if ("```" in text or "~~~" in text) and (len(_FENCE.findall(text)) % 2 or bare.count("```") % 2):
        return CUT
    if bare.endswith("```"):
        return WHOLE
    # Dots for what is left out may follow any word; the words before them decide.
    dotted = _DOTS.search(bare)
    bare = bare[: dotted.start()].rstrip() if dotted else bare
    if not bare:
        return WHOLE
    line = _last_line(bare).strip()
    if line.startswith("|"):
        return WHOLE if line.endswith("|") and len(line) > 1 else CUT
    if line in ("-", "*", "+") or re.fullmatch(r"\d+[.)]", line):
        return CUT
    if line.startswith("<") and re.fullmatch(r"<[^<>]*", line):
        return CUT
    end = bare.rstrip(CLOSERS)
    if line.endswith("`") and line.count("`") % 2 == 0:
        return WHOLE
    if not end or end[-1] in _END:
        return WHOLE  # a final mark, or nothing but markup
    opened, closed = line.count("(") + line.count("（"), line.count(")") + line.count("）")
    if opened > closed:
        return CUT
    if bare[-1] in ")）]}>" and opened == closed:
        return WHOLE
    if bare[-1] in ",;:，、；：(（[{=<&/":
        return CUT
    if instruction:
        asked = _last_words(instruction, 3)
        if len(asked) == 3 and _last_words(text, 3) == asked:
            return WHOLE  # the question again, whole to its last word
    return OPEN


def closing_keys(text: str) -> list[int]:
    """Hashes of the closing contexts: of three, two and one words; for a name also its last parts; before dots those of dotted ends."""
    tokens = _TOKEN.findall(_prose(text))
    while tokens and not _is_word(tokens[-1]):
        tokens.pop()
    if not tokens:
        return []
    norms = [_norm(t) for t in tokens[-3:]]
    one = [_H(x) for x in norms]
    keys = [_context(one[-k:]) if len(one) >= k else 0 for k in (3, 2, 1)]
    line = _last_line(text.rstrip())
    said = re.split(r"(?<=[.!?:])\s+", text.strip())
    if _NAMES.fullmatch(line) or (len(said) == 2 and _NAMES.fullmatch(said[1])):
        keys = [0, 0, 0]  # a list of names may end after any of them, and a name alone may be an answer
    parts = _PART.findall(tokens[-1]) if norms[-1] == "\x01name" else []
    keys.append(_H("\x02" + parts[-1]) if parts else 0)
    keys.append(_H("\x03" + parts[-2] + " " + parts[-1]) if len(parts) > 1 else 0)
    # Dots at the end of the text: how often the same words end in dots, and how often the words before the last one stand at all.
    dotted = _DOTS.search(text.rstrip()) is not None
    for k in (3, 2):
        keys += (mix_one(_context(one[-k:]) ^ int(_DOT)), _context(one[-k:-1])) if dotted and len(one) >= k else (0, 0)
    return keys


def _dotted(contexts: np.ndarray) -> np.ndarray:
    """Hashes of the contexts that end a text before dots."""
    return mix(contexts ^ _DOT)


def _open_end(tokens: list[str]) -> int:
    """The place of a last word that only dots for what is left out follow; -1 if there is none."""
    if not tokens or not _DOTS.fullmatch(tokens[-1]):
        return -1
    for i in range(len(tokens) - 2, -1, -1):
        if _is_word(tokens[i]):
            return i
        if tokens[i][0] in _END:
            return -1
    return -1


def _context(hashes: list[int]) -> int:
    out = 0
    for x in hashes:
        out = mix_one(out ^ x)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


#: Of each permutation: what is added bitwise, and an odd factor.
_SALT = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
_ODD = mix(_SALT) | np.uint64(1)
_BAND = mix(np.arange(BANDS, dtype=np.uint64))


def _stretch_bands(grams: np.ndarray, begins: np.ndarray, ends: np.ndarray, seams: np.ndarray) -> np.ndarray:
    """Of each stretch ``grams[begin:end]``: its band keys, tied to its seam. Stretches of one text have one begin and ascending ends."""
    n = len(ends)
    fresh = np.ones(n, bool)
    fresh[1:] = begins[1:] != begins[:-1]
    spans = np.stack([np.where(fresh, begins, np.concatenate([[0], ends[:-1]])), ends], axis=1).ravel()
    padded = np.append(grams, np.uint64(0))
    # The least up to each stretch of a text: above 48 bits of each value the texts count down, so that one running minimum begins anew at each of them (at most 2,000 at once).
    left = (np.cumsum(fresh[::-1])[::-1] - fresh).astype(np.uint64) << np.uint64(48)
    low = np.empty((BANDS * ROWS, n), np.uint64)
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat((padded ^ _SALT[k]) * _ODD[k], spans)[::2] >> np.uint64(16)
        np.minimum.accumulate(left | least, out=low[k])
    low &= np.uint64(2**48 - 1)
    low = low.reshape(BANDS, ROWS, n)
    key = np.broadcast_to(seams[:, None], (n, BANDS)).copy()
    for k in range(ROWS):
        key = mix(key ^ low[:, k].T)
    return mix(key ^ _BAND[None, :])


def _tied(seams: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The seams with the first letter of the word that comes after."""
    return mix(seams ^ firsts.astype(np.uint64))


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = mix(out ^ h[k : k + m])
    return out


def _scan(label: Label | None):  # type: ignore[no-untyped-def]
    """Status, closing contexts, seam, last word and band keys of each text, and what ``label`` says of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in chunks(batches, "body"):
            texts = pdf["body"].tolist()
            asked = pdf["asked"].tolist()
            status = [structure(t, a) for t, a in zip(texts, asked, strict=True)]
            closing = [[k - 2**64 if k >= 2**63 else k for k in closing_keys(t)] if s == OPEN else [] for t, s in zip(texts, status, strict=True)]
            seam, last, keys = [[] for _ in texts], [None] * len(texts), [[] for _ in texts]
            asking, grams, ties = [], [], []
            for i, text in enumerate(texts):
                own = _prose_words(text) if status[i] != WHOLE else []
                if len(own) > SHINGLE:
                    h = hasher(own[:-1])
                    tie = _grams(h[-SEAM:], SEAM)
                    seam[i], last[i] = _signed(np.concatenate([tie, _tied(tie, np.array([ord(own[-1][0])]))])).tolist(), own[-1]
                    asking.append(i)
                    grams.append(_grams(h, SHINGLE))
                    ties.append(tie)
            if asking:
                ends = np.cumsum([len(g) for g in grams])
                banded = _stretch_bands(np.concatenate(grams), ends - [len(g) for g in grams], ends, np.concatenate(ties))
                for i, own in zip(asking, _signed(banded).tolist(), strict=True):
                    keys[i] = own
            said = [label(a, t, words_of(t) if t else []) for a, t in zip(asked, texts, strict=True)] if label else [None] * len(pdf)
            yield pd.DataFrame({
                "row": pdf["row"], "text": pdf["text"], "status": np.array(status, np.int32), "closing": closing,
                "seam": seam, "last": pd.Series(last, dtype="object"), "bands": keys, "label": pd.Series(said, dtype="object"),
            })

    return run


def _wanted(scan: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The bitmaps of all contexts and seams asked for, and of all bands."""
    return bitmap(scan.select(F.explode(F.concat("closing", "seam")).alias("key"))), bitmap(scan.select(F.explode("bands").alias("key")), BAND_BITS)


def _places(at: np.ndarray, kind: np.ndarray, doc: np.ndarray, lexicon: _Lexicon, ids: np.ndarray, wanted: np.ndarray, banded: np.ndarray) -> pd.DataFrame:
    """``key, partner, next, ends``: band keys of each place where a wanted seam stands, the word after it, and whether a sentence ends there."""
    token = np.nonzero(kind == 1)[0]
    owner = doc[token]
    h = np.array(lexicon.plain, np.uint64)[at[token]]
    begin = np.searchsorted(owner, owner)  # of each word: the first word of its text
    seams = _grams(h, SEAM)[:-1] if len(h) > SEAM else np.zeros(0, np.uint64)
    grams = _grams(h, SHINGLE)
    place = np.nonzero((owner[SEAM:] == owner[: len(seams)]) & (np.arange(len(seams)) + SEAM - begin[: len(seams)] >= SHINGLE) & among(seams, wanted))[0]
    place = place[among(_tied(seams[place], np.array(lexicon.first)[at[token[place + SEAM]]]), wanted)]
    key, partner, after, ends = [], [], [], []
    keys = _stretch_bands(grams, begin[place], place + SEAM - SHINGLE + 1, seams[place]) if len(place) else np.zeros((0, BANDS), np.uint64)
    asked = among(keys, banded)
    for k in np.nonzero(asked.any(axis=1))[0]:
        t = int(token[place[k] + SEAM])
        rest = t + 1
        while lexicon.low[at[rest]] in CLOSERS and at[rest]:
            rest += 1
        if not at[rest]:
            continue  # this text ends at the same place: it says nothing
        mine = keys[k][asked[k]]
        key.append(mine)
        partner += [ids[owner[place[k]]]] * len(mine)
        after += [lexicon.low[at[t]]] * len(mine)
        ends += [kind[rest] == 2] * len(mine)
    flat = np.concatenate(key) if key else np.zeros(0, np.uint64)
    return pd.DataFrame({"key": _signed(flat), "partner": np.array(partner, np.int64), "next": pd.Series(after, dtype="object"), "ends": np.array(ends, bool)})


def _pass(wanted: np.ndarray, banded: np.ndarray):  # type: ignore[no-untyped-def]
    """One reading of the corpus: of each wanted context in the prose the places, and the places where a sentence ends after it; and the wanted seams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = _Lexicon()
        total: dict[int, list[int]] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"key": np.array(list(total), np.int64), "partner": None, "next": None, "ends": None, "n": [v[0] for v in total.values()], "n_ends": [v[1] for v in total.values()]})
            total.clear()
            return out.astype({"n": "int64", "n_ends": "int64"})

        def add(keys: np.ndarray, places: np.ndarray | None, ends: np.ndarray) -> None:
            asked = among(keys, wanted)
            for key, p, e in zip(*(x.astype(np.int64).tolist() for x in _tally(_signed(keys[asked]), None if places is None else places[asked], ends[asked])), strict=True):
                got = total.get(key)
                if got is None:
                    total[key] = [p, e]
                else:
                    got[0] += p
                    got[1] += e

        for pdf in chunks(batches, "body"):
            numbers: list[int] = []
            last: list[int] = []
            dotted: list[int] = []
            for text in pdf["body"]:
                tokens = _TOKEN.findall(_prose(text).rstrip())
                if (open_end := _open_end(tokens)) >= 0:
                    dotted.append(len(numbers) + open_end)
                numbers += lexicon.numbers(tokens)
                last.append(len(numbers) - 1)
                numbers += (0, 0, 0)  # no context reaches over two texts
            at = np.array(numbers)
            h, kind = np.array(lexicon.hash, np.uint64)[at], np.array(lexicon.kind, np.int8)[at]
            doc = np.repeat(np.arange(len(last)), np.diff(np.array(last) + 4, prepend=0))
            seams = _places(at, kind, doc, lexicon, pdf["text"].to_numpy(), wanted, banded)
            if len(seams):
                yield seams.assign(n=None, n_ends=None)
            used = kind == 1
            used[np.array(last)] = used[dotted] = False  # an open end is no evidence, with dots or without
            end = np.zeros(len(at), bool)
            end[:-1] = used[:-1] & (kind[1:] == 2)
            c = np.zeros(len(h), np.uint64)
            for k in (1, 2, 3):
                m = len(h) - k + 1
                c = mix(c[:m] ^ h[k - 1 :])
                add(c[used[k - 1 :]], None, end[k - 1 :][used[k - 1 :]])
                if k > 1 and dotted:
                    ended = _dotted(c[np.array([i for i in dotted if i >= k - 1], np.int64) - k + 1])
                    add(ended, None, np.zeros(len(ended), bool))
            lexicon.saw(at[used])
            if len(lexicon.hash) > lexicon.room:
                add(*lexicon.name_parts())
            if len(total) > 500_000:
                yield flush()
        add(*lexicon.name_parts())
        yield flush()

    return run


def ends_early(short: str, longer: str) -> int:
    """CUT if the alignment shows that ``short`` stops where ``longer`` is within a sentence,
    WHOLE if ``longer`` ends its sentence there, OPEN if they don't align at the end or both end there."""
    a = _prose_words(short)
    tokens = _TOKEN.findall(_prose(longer).rstrip())
    spots = [i for i, t in enumerate(tokens) if _is_word(t)]
    b = [tokens[i].lower() for i in spots]
    if len(a) <= SHINGLE:
        return OPEN
    head, last = a[:-1], a[-1]
    seam = head[-SEAM:]
    own = {tuple(head[i : i + SHINGLE]) for i in range(len(head) - SHINGLE + 1)}
    best, reach = 0.0, -1
    seen: set[tuple[str, ...]] = set()
    shared = 0
    for i in range(SHINGLE, len(b)):
        # The stretch b[:i], one shingle longer than the last one.
        gram = tuple(b[i - SHINGLE : i])
        if gram not in seen:
            seen.add(gram)
            shared += gram in own
        if b[i].startswith(last) and b[i - SEAM : i] == seam and (like := shared / (len(own) + len(seen) - shared)) >= SIMILARITY and like > best:
            best, reach = like, i
    if reach < 0:
        return OPEN
    after = [t for t in tokens[spots[reach] + 1 : spots[reach] + 9] if t not in CLOSERS]
    if not after:
        return OPEN
    if b[reach] != last:
        return CUT  # within a word
    return WHOLE if after[0][0] in _END or after[0][0] == "\n" else CUT


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"text": pdf["text"], "partner": pdf["partner"], "verdict": np.array([ends_early(a, b) for a, b in zip(pdf["short"], pdf["longer"], strict=True)], np.int32)})


def _aligned(base: DataFrame, scan: DataFrame, places: DataFrame) -> DataFrame:
    """``text, aligned``: CUT or WHOLE for the texts that a near-copy settles; CUT where copies differ."""
    asks = scan.where("last is not null").select("text", "last", F.explode("bands").alias("key")).distinct()
    places = materialize(places.join(asks.select("key").distinct(), "key", "left_semi"), "truncation-places")
    # One text stands for all of a bucket that go on alike.
    kinds = places.groupBy("key", "next", "ends").agg(F.min("partner").alias("partner"), F.count_distinct("partner").alias("n"))
    tried = asks.join(kinds, "key").where(F.col("next").startswith(F.col("last")) & (F.col("partner") != F.col("text")))
    tried = materialize(tried.groupBy("text", "next", "ends", "partner").agg(F.max("n").alias("n")), "truncation-pairs")
    first = materialize(_verify(base, tried.select("text", "partner").distinct()), "truncation-aligned")
    # Where it isn't similar enough, the others of the bucket follow.
    known = tried.join(first, ["text", "partner"]).select("text", "next", "ends").distinct()
    left = tried.where("n > 1").select("text", "next", "ends").distinct().join(known, ["text", "next", "ends"], "left_anti").join(first.where(F.col("verdict") == CUT).select("text").distinct(), "text", "left_anti")
    left = materialize(left, "truncation-left")
    more = asks.select("text", "key").join(left, "text").join(places, ["key", "next", "ends"]).where("partner <> text").select("text", "partner").distinct()
    more = materialize(more.join(tried.select("text", "partner"), ["text", "partner"], "left_anti"), "truncation-more")
    return first.unionByName(_verify(base, more)).groupBy("text").agg(F.max("verdict").alias("aligned"))


def _verify(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """``text, partner, verdict`` of the pairs that align. The texts of few pairs are read again, not those of all rows shuffled."""
    wanted = materialize(pairs.select("text").union(pairs.select("partner")).distinct(), "truncation-wanted")
    texts = base.select("text", "body").join(wanted, "text", "left_semi").groupBy("text").agg(F.first("body").alias("body"))
    both = (
        pairs.join(texts.select("text", F.col("body").alias("short")), "text")
        .join(texts.select(F.col("text").alias("partner"), F.col("body").alias("longer")), "partner")
        .select("text", "partner", "short", "longer")
    )
    return both.mapInPandas(_align, "text bigint, partner bigint, verdict int").where(F.col("verdict") != OPEN)


def truncation(
    df: DataFrame, key: str = "sample_id", text: str = "output", asked: str | None = "instruction", source: str = "source", order: str = "ingested_at",
    label: Label | None = None,
) -> DataFrame:
    """One row per record: ``key, source, truncated BOOLEAN, evidence STRING, terminality DOUBLE``.

    ``evidence`` is ``structure``, ``alignment`` or ``terminality``; ``terminality`` is null where
    it wasn't asked. Null, blank and stand-in texts are whole (they are empty, not cut); texts of
    any length are read to their end. Redelivered records count once, by their latest delivery.
    An empty table gives no rows. Other columns, whatever their names, are ignored. With ``label``, a function of
    question, text and the text's words that runs in the same pass, there is a column ``label``.
    """
    base = df.select(
        F.col(key).alias("id"), F.col(source).alias("src"), F.col(order).alias("seen"), F.col(text).alias("body"),
        (F.col(asked) if asked else F.lit(None).cast("string")).alias("asked"),
    ).where(F.col("id").isNotNull())
    # A row is its key and content: deliveries of one content are one row.
    base = base.withColumns({"row": F.xxhash64("id", "body", "asked"), "text": F.xxhash64("body")})
    scanned = base.select("row", "text", "body", "asked").mapInPandas(_scan(label), "row bigint, text bigint, status int, closing array<bigint>, seam array<bigint>, last string, bands array<bigint>, label string")
    scan = materialize(scanned, "truncation-scan")
    passed = base.where(F.col("body").isNotNull()).select("text", "body").mapInPandas(_pass(*_wanted(scan)), "key bigint, partner bigint, next string, ends boolean, n bigint, n_ends bigint")
    passed = materialize(passed, "truncation-pass")
    aligned = _aligned(base, scan, passed.where("partner is not null").select("key", "partner", "next", "ends"))

    # Terminality of the closing contexts over the whole corpus.
    counts = passed.where("partner is null").groupBy("key").agg(F.sum("n").alias("places"), F.sum("n_ends").alias("ends"))
    asks = scan.where(F.col("status") == OPEN).select("row", F.posexplode("closing").alias("k", "key")).where(F.col("key") != 0)
    got = asks.join(counts, "key", "left").withColumns({"places": F.coalesce("places", F.lit(0)), "ends": F.coalesce("ends", F.lit(0))})
    found = got.groupBy("row").agg(*[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(9) for c in ("places", "ends")])

    def of(k: int, least: int):  # type: ignore[no-untyped-def]
        return F.when(F.col(f"places{k}") >= least, F.col(f"ends{k}") / F.col(f"places{k}"))

    # The name's own parts say whether the last word is whole; the words before it whether it may end.
    context = F.when(F.col("places2").isNull(), F.lit(1.0)).otherwise(F.coalesce(of(0, LEAST_SEEN), of(1, LEAST_SEEN), of(2, LEAST_SEEN), F.lit(0.0)))
    whole_name = F.when(F.col("places3").isNull(), F.lit(1.0)).otherwise(F.coalesce(of(4, LEAST_SEEN), of(3, LEAST_SEEN), F.lit(0.0)))
    # Dots may end a text where the words before the last one mostly lead to it and the dots.
    left_out = F.coalesce(*[F.when(F.col(f"places{k + 1}") >= LEAST_SEEN, F.col(f"places{k}") / F.col(f"places{k + 1}")) for k in (5, 7)], F.lit(0.0))
    left_out = F.when(left_out >= LEAST_DOTTED, left_out).otherwise(0.0)
    scores = found.select("row", F.greatest(F.least(context, whole_name), left_out).alias("terminality"))

    # A copy that ends its sentence here doesn't close an open fence or bracket.
    settled = (F.col("aligned") == CUT) | (F.col("aligned").isNotNull() & (F.col("status") == OPEN))
    ids = base.select("id", "src", "seen", "row")
    out = (
        ids.join(scan.select("row", "text", "status", "label").distinct(), "row")
        .join(aligned, "text", "left").join(scores, "row", "left")
        .select(
            F.col("id").alias(key), F.col("src").alias(source), F.col("seen").alias(order),
            F.when(settled, F.col("aligned") == CUT).when(F.col("status") != OPEN, F.col("status") == CUT).otherwise(F.coalesce("terminality", F.lit(1.0)) < LEAST_TERMINAL).alias("truncated"),
            F.when(settled, "alignment").when(F.col("status") != OPEN, "structure").otherwise("terminality").alias("evidence"),
            F.when(F.col("status") == OPEN, F.col("terminality")).alias("terminality"), *(["label"] if label else []),
        )
    )
    return latest(out, key, order).drop(order)


def truncation_by_source(verdicts: DataFrame, source: str = "source") -> DataFrame:
    """``source, records, truncated, cut_rate`` of the rows of :func:`truncation`; a null source is one."""
    cut = F.col("truncated").cast("int")
    return verdicts.groupBy(source).agg(F.count("*").alias("records"), F.sum(cut).alias("truncated"), F.avg(cut.cast("double")).alias("cut_rate"))
