"""Column expressions on text; all of them stay within whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a code fence's language and the one they are written as.
FENCE_LANGUAGES = {"csharp": "csharp", "cs": "csharp", "c#": "csharp", "vb": "vbnet", "vb.net": "vbnet", "vbnet": "vbnet", "visualbasic": "vbnet"}


def token_count(text: Column) -> Column:
    """Runs of non-blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def contains_folded(text: Column, part: str) -> Column:
    """Whether ``text`` contains ``part`` in any case; a null text contains nothing."""
    return F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(part.lower()))


def contains_exact(text: Column, part: str) -> Column:
    return F.contains(F.coalesce(text, F.lit("")), F.lit(part))


def preview(text: Column, length: int = 100) -> Column:
    """The first characters and three dots, which always follow."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def corrected(text: Column) -> Column:
    """Automatic corrections: line ends, a fence around the whole page, blanks at line ends, runs of blank lines, names of fence languages."""
    out = F.regexp_replace(text, r"\r\n?", "\n")
    out = F.regexp_replace(out, r"\A\s*```[ \t]*(?:html|markdown|md)?[ \t]*\n([\s\S]*?)\n```[ \t]*\s*\z", "$1")
    out = F.regexp_replace(out, r"(?m)[ \t]+$", "")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    for canonical in sorted(set(FENCE_LANGUAGES.values())):
        others = "|".join(sorted((k.replace(".", r"\.") for k, v in FENCE_LANGUAGES.items() if v == canonical and k != canonical), key=len, reverse=True))
        out = F.regexp_replace(out, rf"(?im)^([ \t]*```)(?:{others})[ \t]*$", f"$1{canonical}")
    return out


def split_bucket(key: Column, modulus: int = 10_000) -> Column:
    """A bucket in [0, ``modulus``) from the MD5 of the key's text, the same on every engine."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(modulus))
