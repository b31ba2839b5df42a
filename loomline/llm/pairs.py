"""Defective pairs of prompt and response.

Each pair gets at most one defect, in this order: ``empty``, ``copied_question``, ``refusal``,
``other_language``, ``truncated``. Copies are found by aligning the tokens of prompt and response:
containment of the response's shingles in the prompt's, then the longest common subsequence.
Refusals are found by aligning the tokens of each sentence with those of templates in which ``*`` stands for what is
refused. The alignment's score is one less its cost a template token: a misspelt token costs a quarter, a word
put in or a small word left out a half, and no other word may be missing. Every sentence of the response must reach the
score with a refusal or one of the phrases that go with it, so an answer that merely apologises or names an
impossibility is kept.

The language of prose is told by script and by function words, with names, numbers and code left out. Prose that
these don't tell is held against profiles of letter trigrams, one for each language the corpus' own prompts and responses are written in, trained
on all of them: text that is less likely under each profile than almost all text of its language is in an ``other`` one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.shingles import LETTERS, chunks, mix, splitter, words_of
from loomline.llm.truncation import MOST_WORDS, is_empty, truncation
from loomline.plans.scratch import materialize

DEFECTS = ("empty", "copied_question", "refusal", "other_language", "truncated")
CONTAINED, COPY_SHINGLE = 0.8, 3
#: An alignment with a template of at least this score is one.
ALIGNED = 0.8
#: Words shorter than this must be spelt as in the template.
SPELT = 4
LEAST_WORDS = 4
#: Width of the steps in which scores are counted, in nats a trigram.
STEP = 1e-4
#: Hash buckets of trigrams; languages with fewer texts to train on get no profile.
PROFILE, LEAST_TEXTS = 2**13, 40
#: Words and letter trigrams that tell enough to hold a text against the profiles.
TELLING_WORDS, TELLING_GRAMS = 8, 40
#: Signs of texts whose trigrams are made at once, and texts whose own trigrams are counted at once, so that the arrays stay in a core's cache.
GRAMS_AT_ONCE, TEXTS_AT_ONCE = 200_000, 32
#: Share of a language's own texts that its profile takes for foreign, and how much less likely still a text must be (in nats a trigram).
FOREIGN, MARGIN = 0.005, 1.0

# Labels in front of an answer or a repeated question.
LABELS = ("answer", "question", "instruction", "response", "output", "user", "assistant", "prompt", "q", "a")
# How refusals begin or are put, by language; * is what is refused.
REFUSALS = {
    "en": (
        "i'm sorry, but i can't *", "i am sorry, but i cannot *", "i'm sorry, but i cannot *", "sorry, i can't *", "sorry, i cannot *", "sorry, but i can't *",
        "unfortunately i cannot assist *", "unfortunately, i cannot *", "unfortunately i can't *", "i cannot help *", "i can't help *", "i cannot assist *", "i can't assist *",
        "i cannot provide *", "i can't provide *", "i cannot answer *", "i can't answer *", "i cannot comply *",
        "i am unable to provide *", "i'm unable to *", "i am unable to *", "i am not able to *", "i'm not able to *", "i won't be able to *", "i will not be able to *",
        "i must decline *", "i have to decline *", "i decline to *", "i refuse to *", "apologies, no answer can be given *", "i apologize, but i *", "i apologise, but i *",
        "as a language model i do not *", "as a language model, i *", "as an ai *", "my guidelines do not allow me *", "it would not be appropriate for me *",
        "no comment on *", "sorry, * falls outside of what i may talk about *", "* falls outside of what i may talk about *", "* is not something i am able to *", "* is not something i can *",
        "this request was declined *",
    ),
    "de": (
        "es tut mir leid, aber *", "leider kann ich *", "leider darf ich *", "ich kann * nicht beantworten", "diese frage * kann ich nicht beantworten", "* kann ich keine auskunft geben",
        "ich bin nicht in der lage*", "ich darf *nicht *", "dazu darf ich *", "ich muss * ablehnen", "* muss ich ablehnen", "ich lehne *ab*", "* kann ich leider nicht *", "* kann ich nicht *helfen", "zu * äußere ich mich nicht", "* darf ich nichts *", "ich möchte * nicht *",
    ),
    "fr": (
        "je suis désolé, mais je *", "désolé, je ne *", "désolé, mais *", "je ne peux pas *", "je ne peux malheureusement pas *", "je ne suis pas en mesure de *", "je refuse de *", "je regrette, *", "il m'est impossible d*", "malheureusement, je *", "cette question * dépasse *", "cette demande * je ne *", "je ne puis *", "* sort de mon domaine*", "* n'entre pas dans *",
    ),
    "es": (
        "lo siento, no puedo *", "lo siento, pero *", "no puedo ayudar *", "no puedo responder *", "no puedo ofrecer *", "no me es posible *", "no estoy en condiciones de *", "esta consulta * queda fuera de mi alcance", "* queda fuera de mi alcance", "me niego a *", "debo rechazar *", "lamento no poder *", "lamentablemente no puedo *", "no tengo permitido *", "no estoy autorizado *",
    ),
    "ko": (
        "죄송하지만 *", "죄송합니다* 없습니다", "안타깝게도 * 불가능합니다", "안타깝게도 * 없습니다", "저는 * 제공할 수 없으니 양해해 주세요", "* 제가 다룰 수 있는 범위를 벗어납니다", "* 답변을 드릴 수 없습니다", "* 답변드릴 수 없습니다", "* 도와드릴 수 없습니다", "* 거절합니다", "* 요청은 * 수 없습니다", "유감스럽지만 *",
    ),
}
# Short words that turn a sentence round; they may neither be missing nor misspelt nor put in.
NEGATIONS = frozenset("not no cant wont never nie kein ne pas non sin 못 안".split())
# What goes with a refusal without giving an answer.
AROUND_REFUSAL = (
    "is there anything besides *", "is there anything else *", "please consult *", "try rephrasing *", "you may contact *", "please contact *", "please try *",
    "if you have * questions *", "let me know if *", "ask a colleague *", "i hope you understand*", "thank you for *",
    "bitte wenden sie sich *", "wenden sie sich bitte *", "bitte versuchen sie *", "bitte formulieren sie *", "bitte konsultieren sie *", "bitte kontaktieren sie *", "bitte fragen sie *", "kann ich ihnen sonst *", "kann ich ihnen anderweitig *",
    "gibt es sonst *", "gibt es noch etwas *", "wenn sie * fragen haben*", "falls sie * fragen haben*", "ich bitte um * verständnis*", "ich bitte um verständnis*", "ich hoffe auf ihr verständnis*", "vielen dank für *", "danke für *",
    "veuillez consulter *", "veuillez contacter *", "veuillez vous adresser *", "veuillez réessayer*", "veuillez reformuler *", "essayez de reformuler *", "y a-t-il autre chose *", "puis-je vous aider *", "n'hésitez pas à *", "si vous avez * questions*", "merci de votre compréhension*", "merci pour *", "je vous remercie *",
    "por favor, consulte *", "por favor consulte *", "por favor, contacte *", "por favor contacte *", "por favor, póngase en contacto *", "por favor póngase en contacto *", "intente reformular *", "¿hay algo más *", "¿puedo ayudarle *", "si tiene * preguntas*", "no dude en *", "espero que lo entienda*", "gracias por *",
    "다른 질문이 *", "다른 도움이 *", "더 궁금한 *", "궁금한 점이 *", "* 문의해 주*", "* 문의하시기 바랍니다", "양해해 주*", "양해 부탁*", "* 양해 부탁*", "이해해 주셔서 *", "감사합니다",
)
# Frequent function words of languages in Latin script.
FUNCTION_WORDS = {
    "en": "the of is are and for in to with on that before when how what which while by from or if not you your this must can will be as it at an its until without any every".split(),
    "de": "der die das und nicht ist ein eine einen für von auf wird den mit bei dem des im zu sich auch wenn oder wie kann ich sie aus nach vor beim jede jedes jeder trotz über ohne gemäß sofern solange einmal alle keine".split(),
    "fr": "le la les des est un une dans pour que et sont du de à ne pas en avec sur par au aux ce cette qui ou lors tant vous sans chaque avant après même l d qu s n".split(),
    "es": "el la los las en un una para que y del con se de al por es no su como más este esta cuando desde según sin antes después usted cada siempre lo".split(),
    "it": "il lo gli di che è per una sono della nel alla del con non si da le un i dei delle quando come ogni prima dopo senza nella".split(),
    "pt": "o os de não uma para as do da em com ao são um que no na por se dos das ou quando como cada antes depois sem você mais à".split(),
    "nl": "de het een van en niet zijn voor op wordt bij met dat te in is aan als of door naar uit over elke zonder zodra".split(),
    "pl": "w na nie jest i się z do przez po że dla jak od oraz lub każdy gdy przed bez to są".split(),
    "sv": "och att det som en på är av för med den inte till om ett från vid när varje före utan i".split(),
    "tr": "ve bir bu için ile da de olarak her gibi daha sonra önce değil olan kadar veya".split(),
    "id": "dan yang di untuk dengan dari pada ini itu tidak adalah ke atau setiap sebelum setelah saat".split(),
}
_SETS = {k: frozenset(v) for k, v in FUNCTION_WORDS.items()}
_SPEAKS: dict[str, tuple[str, ...]] = {w: tuple(k for k, s in _SETS.items() if w in s) for v in FUNCTION_WORDS.values() for w in v}
# Names of languages as prompts ask for them.
LANGUAGE_NAMES = {
    "en": ("english", "englisch", "anglais", "inglés", "영어"), "de": ("german", "deutsch", "allemand", "alemán", "독일어"), "fr": ("french", "französisch", "français", "francés", "프랑스어"),
    "es": ("spanish", "spanisch", "espagnol", "español", "스페인어"), "ko": ("korean", "koreanisch", "coréen", "coreano", "한국어"), "ja": ("japanese", "japanisch", "japonais", "japonés", "일본어"),
    "zh": ("chinese", "chinesisch", "chinois", "chino", "중국어"), "it": ("italian", "italienisch", "italien", "italiano", "이탈리아어"), "pt": ("portuguese", "portugiesisch", "portugais", "portugués", "포르투갈어"),
}
_NAMES = {w: k for k, v in LANGUAGE_NAMES.items() for w in v}
_LIST = "|".join(sorted(_NAMES, key=len, reverse=True))
_ASKS = [
    re.compile(rf"\b(?:answer|reply|respond|write|written|explain)\b[^.?!\n]{{0,20}}?\b(?:in|into)\s+({_LIST})\b"),
    re.compile(rf"\b({_LIST})\s+(?:text|answer|reply|response|version)\b"),
    re.compile(rf"\b(?:in|auf|en)\s+({_LIST})\b"),
    re.compile(r"(\w+어)로\b"),
]
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_NAME = re.compile(r"\b\w*[a-z0-9][A-Z]\w*\b|\b\w*[\d_]\w*\b")
_TOKENS = re.compile(r"[^\W_]+")
_WIDE = {k: re.compile(f"[{v}]+") for k, v in (("ko", "\uac00-\ud7a3\u1100-\u11ff"), ("ja", "\u3040-\u30ff"), ("zh", "\u4e00-\u9fff"), ("ru", "\u0400-\u04ff"))}
_ANY_WIDE = re.compile("[\u0400-\u04ff\u1100-\u11ff\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7a3]")
#: The end of a line, or a final mark before a blank, with the blanks after it.
_ENDS = re.compile(r"[.!?。！？\n](?:(?<=\n)|(?=\s))\s*|\Z")
_letters = splitter(LETTERS)
_whole_words = splitter(re.compile(r"\w+"), lower=False)


_NOTHING: frozenset[str] = frozenset()


class _Found(dict):
    """What is found for each token, found once; past ``room`` tokens it starts anew."""

    def __init__(self, find: Callable[[str], Any], room: int = 200_000) -> None:
        self.find, self.room = find, room

    def __missing__(self, token: str) -> Any:
        if len(self) > self.room:
            self.clear()
        got = self[token] = self.find(token)
        return got


class Templates:
    """Templates as tokens and gaps, found by their two longest words."""

    def __init__(self, refusals: list[str], around: list[str]) -> None:
        self.items = [self._parse(t) for t in (*refusals, *around)]
        self.declining = len(refusals)
        self.words = [frozenset(w for w, _ in items if w) for items in self.items]
        # Without these, no alignment costs less than a template has tokens.
        self.must = [frozenset(w for w in words if len(w) >= SPELT or w in NEGATIONS) for words in self.words]
        self.by_anchor: dict[str, list[int]] = {}
        for k, words in enumerate(self.words):
            for w in sorted(words, key=lambda w: (-len(w), w))[:2]:
                self.by_anchor.setdefault(w, []).append(k)
        # Words one letter short, to find misspelt ones.
        self.shorter: dict[str, set[str]] = {}
        for w in frozenset().union(*self.words):
            if len(w) >= SPELT:
                for x in (w, *_one_less(w)):
                    self.shorter.setdefault(x, set()).add(w)
        self.all = frozenset().union(*self.words)
        self.longest = max(map(len, self.all))
        self.stems = tuple(w for items in self.items for w, kind in items if kind)
        self.known = _Found(self._near)

    @staticmethod
    def _parse(t: str) -> list[tuple[str, str]]:
        """Tokens ``(word, "")``, ``(word, "start")`` or ``(word, "end")`` for a part of a word, and gaps ``("", "")``."""
        out: list[tuple[str, str]] = []
        for x in _spelt(t).split():
            word = "".join(_TOKENS.findall(x))
            if x.startswith("*") and (not out or out[-1] != ("", "")):
                out.append(("", ""))
            if word:
                out.append((word, "end" if x.startswith("*") and x != "*" else "start" if x.endswith("*") else ""))
            if x.endswith("*") and x != "*":
                out.append(("", ""))
        return out

    def _near(self, token: str) -> frozenset[str]:
        """The template words that ``token`` is, or is but for one letter."""
        found = {token} & self.all
        if SPELT <= len(token) <= self.longest + 1:
            found |= {w for x in (token, *_one_less(token)) for w in self.shorter.get(x, ()) if _one_apart(token, w)}
        if token.startswith(self.stems) or token.endswith(self.stems):
            found |= {w for w in self.stems if token.startswith(w) or token.endswith(w)}
        return frozenset(found) if found else _NOTHING

    def scores(self, tokens: list[str]) -> tuple[float, float]:
        """The best score of an alignment of the whole sentence with a refusal, and with what goes with one."""
        near = list(map(self.known.__getitem__, tokens))
        have = _NOTHING.union(*near)
        best = [0.0, 0.0]
        for k in dict.fromkeys(k for w in have for k in self.by_anchor.get(w, ())):
            words = self.words[k]
            if best[kind := k >= self.declining] < 1 and self.must[k] <= have and len(words & have) >= ALIGNED * len(words) - 1:
                best[kind] = max(best[kind], 1 - _cost(self.items[k], tokens, near) / len(words))
        return best[0], best[1]


def _spelt(text: str) -> str:
    """Lower case, without the apostrophes that join words."""
    return text.lower().replace("'", "").replace("’", "")


def _one_less(w: str) -> list[str]:
    return [w[:i] + w[i + 1 :] for i in range(len(w))]


def _one_apart(a: str, b: str) -> bool:
    """One letter put in, left out, changed, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])


def _cost(items: list[tuple[str, str]], tokens: list[str], near: list[frozenset[str]]) -> float:
    """The least cost of an alignment; gaps take any words for nothing."""
    far = 99.0
    row = [0.0] + [0.5 * (j + 1) for j in range(len(tokens))]
    for word, kind in items:
        if not word:
            low = far
            for j, x in enumerate(row):
                low = row[j] = min(low, x)
            continue
        out = 0.5 if len(word) < SPELT and word not in NEGATIONS else far
        after = [row[0] + out]
        for j, t in enumerate(tokens):
            same = 0.0 if t == word or (kind == "start" and t.startswith(word)) or (kind == "end" and t.endswith(word)) else 0.25 if len(t) >= SPELT and len(word) >= SPELT and word in near[j] and word not in NEGATIONS else far
            # Put in, left out, or set side by side; a word that denies isn't put in for nothing.
            after.append(min(row[j] + same, row[j + 1] + out, after[j] + (far if t in NEGATIONS else 0.5)))
        row = after
    return row[-1]


_TEMPLATES = Templates([t for ts in REFUSALS.values() for t in ts], list(AROUND_REFUSAL))


def _tokens(text: str) -> list[str]:
    return words_of(text)


def _common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; linear memory, bit-parallel over ``a``."""
    masks: dict[str, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    row = 0
    for y in b:
        x = row | masks.get(y, 0)
        row = x & ~(x - ((row << 1) | 1))
    return row.bit_count()


def is_copy(a: list[str], b: list[str]) -> bool:
    """The response's tokens ``b`` hold the prompt's ``a``, once or over and over, and nothing else of weight."""
    while b and b[0] in LABELS:
        b = b[1:]
    if len(a) < COPY_SHINGLE or len(b) < COPY_SHINGLE:
        return False
    if sum(map(set(a).__contains__, b)) < 0.8 * len(b):
        return False  # no alignment can hold more than the tokens both have
    asked = {tuple(a[i : i + COPY_SHINGLE]) for i in range(len(a) - COPY_SHINGLE + 1)}
    own = [tuple(b[i : i + COPY_SHINGLE]) for i in range(len(b) - COPY_SHINGLE + 1)]
    times = max(1, round(len(b) / len(a)))
    seams = (times - 1) * (COPY_SHINGLE - 1)
    inside = sum(x in asked for x in own)
    if inside < CONTAINED * max(1, len(own) - seams):
        # Edited copies: most of the prompt in its order, little beside it.
        if len(set(own) & asked) < 0.4 * len(asked):
            return False
    lcs = _common_subsequence(a * times, b)
    return lcs >= 0.8 * len(b) and lcs >= 0.8 * len(a)


def refusal_score(response: str) -> float:
    """The least of the sentences' best scores, refusals and phrases that go with them alike; 0 where no sentence declines.

    A first sentence of up to three words, such as an apology, may be anything.
    """
    text = _spelt(response).strip("\"*_> ")
    least, declined, begin = 1.0, False, 0
    for m in _ENDS.finditer(text):
        part = text[begin : m.start()]
        first, begin = begin == 0, m.end()
        tokens = words_of(part)
        if not tokens:
            continue
        declines, goes = _TEMPLATES.scores(tokens)
        if declines >= ALIGNED:
            declined = True
        elif first and len(tokens) <= 3:
            continue
        elif goes < ALIGNED:
            return 0.0
        got = max(declines, goes)
        least = min(least, got)
    return least if declined else 0.0


def is_refusal(response: str, tokens: list[str] | None = None) -> bool:
    """Every sentence declines or goes with declining, at least one declines."""
    return refusal_score(response) > 0


def language(text: str, tokens: list[str] | None = None) -> str | None:
    """Language of the prose in ``text``: ``en de fr es it pt nl pl sv tr id ko ja zh ru``, or null where too little tells.

    ``tokens`` are the text's words and numbers, for a caller that has them; they serve for texts without code and tables.
    """
    plain = tokens is not None and "`" not in text and "|" not in text
    prose = _uncoded(text)
    if not prose.isascii() and _ANY_WIDE.search(prose):
        wide = {k: sum(map(len, p.findall(prose))) * (1 if k == "ru" else 2) for k, p in _WIDE.items()}
        # Names are spelt in Latin letters in every language.
        others = sum(len(w) for w in _whole_words(prose) if _PLAIN[w]) - sum(v // (1 if k == "ru" else 2) for k, v in wide.items())
        if sum(wide.values()) > others:
            if wide["ja"] > 0.1 * (wide["zh"] + wide["ja"]) and wide["ja"] > wide["ko"]:
                return "ja"
            return max(sorted(wide), key=lambda k: wide[k])
    words = tokens if plain else _letters(prose)
    if len(words) < LEAST_WORDS:
        return None
    score = dict.fromkeys(_SETS, 0)
    for spoken in filter(None, map(_SPEAKS.get, words)):
        for k in spoken:
            score[k] += 1
    best = max(score, key=score.__getitem__)
    most = score[best]
    if most < max(2, 0.08 * len(words)) or list(score.values()).count(most) > 1:
        return None
    return best


def _uncoded(text: str) -> str:
    """The text without code and tables."""
    prose = _CODE.sub(" ", text) if "`" in text else text
    return "\n".join(x for x in prose.split("\n") if not x.lstrip().startswith("|")) if "|" in prose else prose


def _prose(text: str) -> str:
    """The text in lower case without code, tables, names and numbers."""
    return _NAME.sub(" ", _uncoded(text)).lower()


#: In lower case the words that aren't names; nothing for those that are.
_PLAIN = _Found(lambda word: "" if _NAME.fullmatch(word) else word.lower())


def _distinct_words(text: str) -> str:
    """The distinct words of :func:`_prose` in their order, with blanks between them."""
    text = _uncoded(text)
    if "\u03a3" in text or "\u0130" in text:  # one has a lower case by what is around it, the other one of two signs
        return " ".join(dict.fromkeys(LETTERS.findall(_NAME.sub(" ", text).lower())))
    words = dict.fromkeys(map(_PLAIN.__getitem__, _whole_words(text)))
    words.pop("", None)
    return " ".join(words)


def _trigrams(prose: str) -> np.ndarray:
    """Hash buckets of the letter trigrams of the distinct words, each with a blank before and after it."""
    return _word_trigrams([" ".join(dict.fromkeys(LETTERS.findall(prose)))])[0]


def _word_trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the letter trigrams of all texts, one after another, and the number of the text that each is of."""
    # No trigram reaches over the line's end between two texts.
    codes = np.frombuffer(f" {' \n '.join(texts)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = codes == 10
    own = np.nonzero(~(ends[:-2] | ends[1:-1] | ends[2:]))[0]
    signs = codes.astype(np.uint64)
    grams = mix(signs[own] * np.uint64(0x10001) ^ (signs[own + 1] << np.uint64(21)) ^ (signs[own + 2] << np.uint64(42))) % np.uint64(PROFILE)
    return grams.astype(np.int64), np.cumsum(ends)[own]


class Profiles:
    """Mean log-probability of a text's trigrams under each language, and from where on it is foreign to the language."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        self.log = {k: np.log((c + 0.5) / (c.sum() + 0.5 * PROFILE)).astype(np.float32) for k, c in counts.items()}
        self.least: dict[str, float] = {}

    def score(self, lang: str, grams: np.ndarray) -> float:
        return float(self.log[lang][grams].mean())

    def is_other(self, text: str) -> bool:
        """Foreign to every language that has a profile; false where too little tells."""
        if not self.least:
            return False
        prose = _prose(text)
        if len(LETTERS.findall(prose)) < TELLING_WORDS or len(grams := _trigrams(prose)) < TELLING_GRAMS:
            return False
        return all(self.score(k, grams) < least - MARGIN for k, least in self.least.items())


def _said(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Language and distinct prose words of each text in a language of Latin letters."""
    for pdf in chunks(batches, "body"):
        out = [(h, k, _distinct_words(text)) for h, text in zip(pdf["h"], pdf["body"], strict=True) if (k := language(text)) in _SETS]
        yield pd.DataFrame(out, columns=["h", "lang", "words"]).astype({"h": "int64", "lang": "object", "words": "object"})


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigrams by language; bucket -1 counts the texts."""
    total: dict[str, np.ndarray] = {}
    texts: Counter[str] = Counter()
    for pdf in chunks(batches, "words", chars=GRAMS_AT_ONCE):
        for k, words in pdf.groupby("lang")["words"]:
            total[k] = total.get(k, 0) + np.bincount(_word_trigrams(words.tolist())[0], minlength=PROFILE)
            texts[k] += len(words)
    for k, c in total.items():
        at = np.nonzero(c)[0]
        yield pd.DataFrame({"lang": k, "bucket": [-1, *at], "n": [texts[k], *c[at]]})


def _scores(counts: np.ndarray, texts: Sequence[str]) -> np.ndarray:
    """Of each text with enough trigrams: its score under the profile that all others make."""
    grams, text = _word_trigrams(texts)
    size = np.bincount(text, minlength=len(texts))
    # How often each trigram stands in its own text, for few texts at a time: the counts of a text are as many as buckets.
    times = np.empty(len(grams), np.int64)
    for first in range(0, len(texts), TEXTS_AT_ONCE):
        own = slice(*np.searchsorted(text, [first, first + TEXTS_AT_ONCE]))
        at = (text[own] - first) * PROFILE + grams[own]
        times[own] = np.bincount(at, minlength=1)[at]
    sums = np.bincount(text, weights=np.log(counts[grams] - times + 0.5), minlength=len(texts))
    tell = np.nonzero(size >= TELLING_GRAMS)[0]
    return sums[tell] / size[tell] - np.log(counts.sum() - size[tell] + 0.5 * PROFILE)


def _rate(counts: dict[str, np.ndarray]):  # type: ignore[no-untyped-def]
    """How many texts have which score, in steps of ``STEP``, under the profile that all other texts make."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps: Counter[tuple[str, int]] = Counter()
        for pdf in chunks(batches, "words", chars=GRAMS_AT_ONCE):
            for k, words in pdf.groupby("lang")["words"]:
                if k in counts:
                    steps.update((k, at) for at in np.floor(_scores(counts[k], words.tolist()) / STEP).astype(int).tolist())
        yield pd.DataFrame([(k, at, n) for (k, at), n in steps.items()], columns=["lang", "step", "n"]).astype({"lang": "object", "step": "int32", "n": "int64"})

    return run


def train_profiles(df: DataFrame, prompt: str, response: str) -> Profiles:
    """Profiles of the languages in Latin letters of all prompts and responses, each distinct text once; each is held against what the others make.

    Counts (languages x buckets) and histograms of scores in fixed steps reach the driver, no texts.
    """
    own = df.select(F.explode(F.array(prompt, response)).alias("body")).where(F.length("body") > 0).withColumn("h", F.xxhash64("body"))
    said = materialize(own.mapInPandas(_said, "h bigint, lang string, words string").distinct().select("lang", "words"), "pairs-said")
    got = said.mapInPandas(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    counts = {}
    for k, own_counts in got.groupby("lang"):
        if own_counts.loc[own_counts["bucket"] < 0, "n"].sum() >= LEAST_TEXTS:
            counts[k] = np.zeros(PROFILE)
            inside = own_counts[own_counts["bucket"] >= 0]
            counts[k][inside["bucket"]] = inside["n"]
    made = Profiles(counts)
    rated = said.mapInPandas(_rate(counts), "lang string, step int, n bigint").groupBy("lang", "step").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    for k, steps in rated.sort_values("step").groupby("lang"):
        upto = steps["n"].cumsum()
        if upto.iloc[-1] >= LEAST_TEXTS:
            made.least[k] = float(steps["step"][upto > FOREIGN * (upto.iloc[-1] - 1)].iloc[0]) * STEP
    return made


class Judge:
    """The defect of a pair, for a pass over texts; knows the profiles of the corpus."""

    def __init__(self, profiles: Profiles | None = None) -> None:
        self.profiles = profiles

    def __call__(self, prompt: str | None, response: str | None, own: list[str] | None = None) -> str | None:
        return defect(prompt, response, own, self.profiles)


def asked_languages(prompt: str, tokens: list[str]) -> list[str]:
    if _NAMES.keys().isdisjoint(tokens) and "어로" not in prompt:
        return []
    low = prompt.lower()
    for p in _ASKS:
        if found := [_NAMES[m] for m in p.findall(low) if m in _NAMES]:
            return found
    return []


def is_other_language(prompt: str | None, response: str, asked: list[str], own: list[str], profiles: Profiles | None = None) -> bool:
    """The response's prose is in a language that is neither the prompt's nor one it asks for."""
    if not prompt:
        return False
    got = language(response, own)
    if got is None and profiles and len(own) >= TELLING_WORDS and profiles.is_other(response):
        got = "other"
    if got is None:
        return False
    spoken = language(prompt, asked)
    if got == spoken:
        return False
    wanted = asked_languages(prompt, asked)
    return got not in wanted and bool(spoken or wanted)


def defect(prompt: str | None, response: str | None, own: list[str] | None = None, profiles: Profiles | None = None) -> str | None:
    """The pair's own defect, without truncation; ``own`` are the response's words in lower case."""
    own = _tokens(response or "") if own is None else own
    # Many words without markup are no stand-in.
    if (len(own) <= MOST_WORDS or "<" in response or "```" in response) and is_empty(response):
        return "empty"
    asked = _tokens(prompt or "")
    if is_copy(asked, own):
        return "copied_question"
    if is_refusal(response, own):
        return "refusal"
    if is_other_language(prompt, response, asked, own, profiles):
        return "other_language"
    return None


def broken_pairs(df: DataFrame, key: str = "sample_id", prompt: str = "instruction", response: str = "output", source: str = "source", order: str = "ingested_at") -> DataFrame:
    """``key, defect`` for each defective pair, one defect a pair.

    A null or blank response is ``empty``; a pair without prompt can't be a copy nor be in a wrong
    language. Texts are read whole. Redelivered pairs count once, by their latest delivery. An empty
    table gives no rows; further columns, whatever their names, are ignored.
    """
    judged = truncation(df, key, response, prompt, source, order, label=Judge(train_profiles(df, prompt, response)))
    found = F.coalesce("label", F.when(F.col("truncated"), F.lit("truncated")))
    return judged.select(key, found.alias("defect")).where(F.col("defect").isNotNull())
