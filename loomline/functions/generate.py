"""Conversations made from source documents.

A generator turns one document into turns; the built-in one is a deterministic template made of column
expressions. Others plug in as a function on records, run in Arrow batches with retries of its own; what a
generator gives up on is a null result, which counts as failed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from enum import Enum

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<sender:string,value:string>>"
#: One document as a dict to question and answer, or None.
Generator = Callable[[dict], tuple[str, str] | None]


class GenerationMode(Enum):
    """How conversations are made: by the built-in template or by a generator that asks a model."""

    TEMPLATE = "template"
    LLM_ASSISTED = "llm_assisted"


class Client:
    """What a model's client must do; this one answers offline, with the last message.

    ``complete`` takes messages ``{role, content}`` and returns ``{content, tokens_used, finish_reason}``; put a
    call to a server in its place. Failures are counted and raised.
    """

    def __init__(self, complete: Callable[[list[dict]], dict] | None = None) -> None:
        self._complete = complete or self._echo
        self._requests = self._failed = 0

    @staticmethod
    def _echo(messages: list[dict]) -> dict:
        said = messages[-1]["content"] if messages else ""
        return {"content": said, "tokens_used": sum(len(m["content"].split()) for m in messages), "finish_reason": "stop"}

    def test_connection(self) -> bool:
        """Whether a shortest request is answered; counts as a request."""
        try:
            return bool(self.chat_completion([{"role": "user", "content": "ping"}])["content"])
        except Exception:  # noqa: BLE001 - whatever a client raises, there is no connection
            return False

    def chat_completion(self, messages: list[dict]) -> dict:
        self._requests += 1
        try:
            return self._complete(messages)
        except Exception:
            self._failed += 1
            raise

    def get_stats(self) -> dict[str, float]:
        """Requests so far; the success rate is in percent, 0 before the first one."""
        good = self._requests - self._failed
        return {"total_requests": self._requests, "successful_requests": good, "failed_requests": self._failed, "success_rate": 100.0 * good / self._requests if self._requests else 0.0}

    def generator(self, system: str = "You answer questions about {component}.") -> Generator:
        """This client as a generator of conversations; each task counts its own requests."""

        def ask(record: dict) -> tuple[str, str] | None:
            if not record.get("component") or not (record.get("content") or "").strip():
                return None
            question = f"{record.get('title') or ''}\n\n{record['content']}"
            answer = self.chat_completion([{"role": "system", "content": system.replace("{component}", record["component"])}, {"role": "user", "content": question}])
            return question, answer["content"]

        return ask


def prompt_messages(df: DataFrame, system: str = "You answer questions about {component}.") -> DataFrame:
    """``id, messages``: the chat messages ``{role, content}`` that ask a model about each document; null where component or content is missing."""
    usable = F.col("component").isNotNull() & (F.trim(F.coalesce("content", F.lit(""))) != "")
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    told = F.replace(F.lit(system), F.lit("{component}"), F.col("component"))
    asked = F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.col("content"))
    return df.select("id", F.when(usable, F.array(message("system", told), message("user", asked))).alias("messages"))


def conversations(df: DataFrame, mode: GenerationMode = GenerationMode.TEMPLATE, generator: Generator | None = None, **options: float) -> DataFrame:
    """``id, conversations`` by the mode; ValueError if a model is wanted but no generator given."""
    if mode is GenerationMode.TEMPLATE:
        return template_conversations(df).select("id", "conversations")
    if generator is None:
        raise ValueError("this mode needs a generator")
    return generate(df, generator, **options)


def template_conversations(df: DataFrame) -> DataFrame:
    """``id, conversations, metadata`` of documents ``id, component, title, content``; null turns where component or content is missing."""
    question = F.concat(F.lit("How is "), F.col("component"), F.lit(" used? "), F.coalesce("title", F.lit("")))
    usable = F.col("component").isNotNull() & (F.trim(F.coalesce("content", F.lit(""))) != "")
    turn = lambda who, value: F.struct(F.lit(who).alias("sender"), value.alias("value"))
    made = F.when(usable, F.array(turn("human", question), turn("gpt", F.col("content"))))
    return df.select("id", made.alias("conversations"), F.create_map(F.lit("component"), F.col("component"), F.lit("mode"), F.lit("template")).alias("metadata"))


def generate(df: DataFrame, generator: Generator, concurrent: int = 8, retries: int = 3, delay: float = 1.0, backoff: float = 2.0) -> DataFrame:
    """As :func:`template_conversations`, by ``generator`` in at most ``concurrent`` tasks at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for record in pdf.to_dict("records"):
                answer = None
                for attempt in range(retries + 1):
                    try:
                        answer = generator(record)
                        break
                    except Exception:  # noqa: BLE001 - whatever a client raises, the record is tried again
                        if attempt < retries:
                            time.sleep(delay * backoff**attempt)
                made.append([{"sender": "human", "value": answer[0]}, {"sender": "gpt", "value": answer[1]}] if answer else None)
            yield pd.DataFrame({"id": pdf["id"], "conversations": made})

    return df.repartition(concurrent).mapInPandas(run, f"id {dict(df.dtypes)['id']}, conversations {TURNS}")


def generation_stats(made: DataFrame) -> DataFrame:
    """One row: documents, generated and failed ones."""
    return made.agg(F.count("*").alias("n_documents"), F.count("conversations").alias("n_generated"), F.count_if(F.col("conversations").isNull()).alias("n_failed"))
