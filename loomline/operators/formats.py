"""Conversations in the common fine-tuning layouts.

Input: ``id, conversations ARRAY<STRUCT<sender, value>>``. Turns without sender or with a null value are no
turns; role spellings are unified. One projection a row, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of roles in each layout.
SHAREGPT_ROLES = {"user": "human", "human": "human", "assistant": "gpt", "gpt": "gpt", "system": "system"}
OPENAI_ROLES = {"user": "user", "human": "user", "assistant": "assistant", "gpt": "assistant", "system": "system"}
DESCRIPTIONS = {
    "sharegpt": "multi-turn conversations of from/value turns",
    "alpaca": "instruction/input/output rows",
    "openai": "messages arrays of role/content objects",
}
UNKNOWN = "unknown format"


def turns(column: str = "conversations") -> Column:
    """The turns that have a sender and a value; a null array has none."""
    return F.filter(F.coalesce(F.col(column), F.array().cast("array<struct<sender:string,value:string>>")), lambda t: t["sender"].isNotNull() & t["value"].isNotNull())


def _role(sender: Column, names: dict[str, str]) -> Column:
    low = F.lower(F.trim(sender))
    out = low
    for spelling, role in names.items():
        out = F.when(low == spelling, role).otherwise(out)
    return out


def sharegpt(df: DataFrame, key: str = "id") -> DataFrame:
    """``id, conversations`` with turns ``{from, value}``; conversations without turns keep an empty array."""
    made = F.transform(turns(), lambda t: F.struct(_role(t["sender"], SHAREGPT_ROLES).alias("from"), t["value"].alias("value")))
    return df.select(key, made.alias("conversations"))


def openai(df: DataFrame, key: str = "id") -> DataFrame:
    """``id, messages`` with messages ``{role, content}``."""
    made = F.transform(turns(), lambda t: F.struct(_role(t["sender"], OPENAI_ROLES).alias("role"), t["value"].alias("content")))
    return df.select(key, made.alias("messages"))


def alpaca(df: DataFrame, key: str = "id") -> DataFrame:
    """``id, turn, instruction, input, output``: one row for each user turn that an assistant turn follows."""
    made = F.transform(turns(), lambda t: F.struct(_role(t["sender"], OPENAI_ROLES).alias("role"), t["value"].alias("value")))
    seen = df.select(key, made.alias("t"))
    pairs = F.filter(
        F.transform("t", lambda t, i: F.struct(i.alias("turn"), t["role"].alias("role"), t["value"].alias("instruction"), F.lit("").alias("input"), F.get(F.col("t"), i + 1)["role"].alias("next"), F.get(F.col("t"), i + 1)["value"].alias("output"))),
        lambda p: (p["role"] == "user") & (p["next"] == "assistant"),
    )
    return seen.select(key, F.inline(pairs)).select(key, "turn", "instruction", "input", "output")


_FORMATS: dict[str, Callable[..., DataFrame]] = {"sharegpt": sharegpt, "alpaca": alpaca, "openai": openai}


def supported_formats() -> list[str]:
    return list(_FORMATS)


def formatter(name: str, **options: str) -> Callable[[DataFrame], DataFrame]:
    """The layout's function by name in any case; ValueError for one that doesn't exist."""
    if name.lower() not in _FORMATS:
        raise ValueError(f"format {name!r} is not supported; supported are {', '.join(_FORMATS)}")
    made = _FORMATS[name.lower()]
    return lambda df: made(df, **options)


def describe_format(name: str) -> str:
    return DESCRIPTIONS.get(name.lower(), UNKNOWN)


def transcript(df: DataFrame, key: str = "id") -> DataFrame:
    """``id, transcript``: the turns as ``role: text`` lines."""
    lines = F.transform(turns(), lambda t: F.concat(_role(t["sender"], OPENAI_ROLES), F.lit(": "), t["value"]))
    return df.select(key, F.array_join(lines, "\n").alias("transcript"))


def turn_stats(df: DataFrame, key: str = "id") -> DataFrame:
    """``id, n_turns, n_chars, n_repeated_roles``: turns, their characters, and neighbours with one role."""
    roles = F.transform(turns(), lambda t: _role(t["sender"], OPENAI_ROLES))
    seen = df.select(key, turns().alias("t"), roles.alias("r"))
    repeated = F.aggregate(F.transform("r", lambda r, i: ((i > 0) & F.coalesce(F.get(F.col("r"), i - 1) == r, F.lit(False))).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return seen.select(key, F.size("t").cast("bigint").alias("n_turns"), F.aggregate("t", F.lit(0).cast("bigint"), lambda a, t: a + F.length(t["value"])).alias("n_chars"), repeated.alias("n_repeated_roles"))


def instruction_rows(df: DataFrame) -> DataFrame:
    """The three columns of an instruction dataset."""
    return df.select("instruction", "input", "output")


def turn_previews(df: DataFrame, key: str = "id", length: int = 100) -> DataFrame:
    """``id, turn, role, value_preview``: the first characters of every turn."""
    made = F.transform(turns(), lambda t, i: F.struct(i.alias("turn"), _role(t["sender"], OPENAI_ROLES).alias("role"), F.substring(t["value"], 1, length).alias("value_preview")))
    return df.select(key, F.inline(made))


def first_turns(df: DataFrame, most: int, key: str = "id") -> DataFrame:
    """``id, turn, role, value`` of the first ``most`` turns of each conversation."""
    made = F.slice(F.transform(turns(), lambda t, i: F.struct(i.alias("turn"), _role(t["sender"], OPENAI_ROLES).alias("role"), t["value"].alias("value"))), 1, most)
    return df.select(key, F.inline(made))
