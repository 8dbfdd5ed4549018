"""Batch inference: prompts to answers through a client made once per task.

A client is any ``client(prompt, temperature=..., max_tokens=...) -> str | None``
and a client factory is a function without arguments that makes one on the
executor. With ``CompletionSettings(batch=n)`` it takes a list of up to n prompts and
returns as many answers, an exception in place of each that failed. The call is marked nondeterministic, so Catalyst never repeats it for
a filter or a second projection; write the result before using it twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import batched, islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.parts import parts
from reviewloom.functions.text import is_blank
from reviewloom.operators.chunks import chunks_or_text
from reviewloom.operators.prompts import build_prompt
from reviewloom.schemas import ANSWER

ClientFactory = Callable[[], Callable]

ANSWER_TYPE = pa.struct(
    [
        ("raw_response", pa.string()),
        ("attempts", pa.int32()),
        ("error_class", pa.string()),
        ("waited", pa.float64()),
    ]
)

# Marks of an error message (lower case) by class, tried in order.
ERROR_MARKS = (
    ("rate_limit", ("rate limit", "429")),
    ("server", ("500", "502", "503")),
    ("auth", ("401", "invalid api key")),
)
FINAL_ERRORS = ("auth",)


@dataclass(frozen=True)
class CompletionSettings:
    # Tries, waits in seconds, sampling.
    attempts: int = 4
    first_wait: float = 2.0
    max_wait: float = 60.0
    temperature: float = 0.3
    max_tokens: int = 300
    # Pause after each call; bounds the rate of one task.
    delay: float = 0.0
    # Prompts of a call, for clients that take lists.
    batch: int | None = None
    sleep: Callable[[float], None] = time.sleep


def error_class(message: str) -> str:
    lowered = message.lower()
    for name, marks in ERROR_MARKS:
        if any(mark in lowered for mark in marks):
            return name
    return "other"


def ask(client: Callable, prompt: str, settings: CompletionSettings) -> dict:
    """One prompt to one answer; failures wait twice as long each time."""
    waited, failure, attempt = 0.0, None, 0
    while attempt < settings.attempts and failure not in FINAL_ERRORS:
        attempt += 1
        try:
            text = client(
                prompt, temperature=settings.temperature, max_tokens=settings.max_tokens
            )
        except Exception as error:
            failure = error_class(str(error))
            if failure not in FINAL_ERRORS:
                pause = min(settings.first_wait * 2 ** (attempt - 1), settings.max_wait)
                settings.sleep(pause)
                waited += pause
        else:
            return _answer(text, attempt, None, waited)
    return _answer(None, attempt, failure, waited)


def ask_batch(client: Callable, prompts: list[str], settings: CompletionSettings) -> list[dict]:
    """Prompts of one call to as many answers. Those that fail are asked again, together
    and without the others; an exception of the whole call is each one's own."""
    answers: list = [None] * len(prompts)
    waited, attempt, open_ = 0.0, 0, list(range(len(prompts)))
    while open_:
        attempt += 1
        replies = _replies(client, [prompts[i] for i in open_], settings)
        failures = {
            i: error_class(str(reply))
            for i, reply in zip(open_, replies)
            if isinstance(reply, Exception)
        }
        for i, reply in zip(open_, replies):
            if i not in failures or failures[i] in FINAL_ERRORS:
                text = None if i in failures else reply
                answers[i] = _answer(text, attempt, failures.get(i), waited)
        open_ = [i for i in failures if failures[i] not in FINAL_ERRORS]
        if open_:
            pause = min(settings.first_wait * 2 ** (attempt - 1), settings.max_wait)
            settings.sleep(pause)
            waited += pause
        if attempt == settings.attempts:
            for i in open_:
                answers[i] = _answer(None, attempt, failures[i], waited)
            break
    return answers


def _replies(client: Callable, prompts: list[str], settings: CompletionSettings) -> list:
    try:
        replies = list(
            client(prompts, temperature=settings.temperature, max_tokens=settings.max_tokens)
        )
        if len(replies) != len(prompts):
            raise ValueError(f"{len(replies)} answers to {len(prompts)} prompts")
    except Exception as error:
        return [error] * len(prompts)
    return replies


def ask_all(
    client: Callable, prompts: Iterable[str], settings: CompletionSettings
) -> Iterator[dict]:
    """Answers in the order of the prompts, of which those of one call are held."""
    if settings.batch is None:
        groups = ([ask(client, prompt, settings)] for prompt in prompts)
    else:
        groups = (ask_batch(client, list(x), settings) for x in batched(prompts, settings.batch))
    for group in groups:
        yield from group
        if settings.delay:
            settings.sleep(settings.delay)


def _answer(text: str | None, attempts: int, failure: str | None, waited: float) -> dict:
    return {
        "raw_response": text,
        "attempts": attempts,
        "error_class": failure,
        "waited": waited,
    }


def complete(
    prompts: Column,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
) -> Column:
    """An array of prompts to an array of answers in the same order.

    Only the prompts travel to Python; the other columns of the row stay in the
    JVM, so neither a join nor a shuffle is needed to bring answers home.
    """

    @F.arrow_udf(f"array<{ANSWER}>")
    def answers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        client = client_factory()
        for batch in batches:
            # Across rows, so that calls are full; a prompt leaves Arrow when it is asked.
            asked = (prompt.as_py() for prompts in batch if prompts.is_valid for prompt in prompts.values)
            found = ask_all(client, asked, settings)
            for part in parts([batch]):
                sizes = pc.list_value_length(part).fill_null(0).to_pylist()
                yield pa.array([list(islice(found, size)) for size in sizes], pa.list_(ANSWER_TYPE))

    return answers.asNondeterministic()(prompts)


def complete_chunks(
    chunks: DataFrame,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
) -> DataFrame:
    """One answer per row of ``explode_chunks``: adds the answer's four fields."""
    prompt = build_prompt(F.col("chunk"), F.col("rating"), F.col("author"))
    asked = chunks.withColumn("_answers", complete(F.array(prompt), client_factory, settings))
    return asked.select("*", F.inline("_answers")).drop("_answers")


def answered(responses: DataFrame) -> DataFrame:
    """Rows with a response; null and empty ones are dropped."""
    return responses.where(F.length("raw_response") > 0)


def add_answers(
    preprocessed: DataFrame,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
) -> DataFrame:
    """Adds ``raw_responses``, the non-empty answers to a review's chunks in order.

    Blank chunks are left out before the call. Every review is kept, with an
    empty array where nothing was answered.
    """
    texts = F.filter(chunks_or_text(preprocessed), lambda chunk: ~is_blank(chunk))
    prompts = F.transform(
        texts, lambda chunk: build_prompt(chunk, F.col("rating"), F.col("author"))
    )
    asked = preprocessed.withColumn("_answers", complete(prompts, client_factory, settings))
    return asked.withColumn(
        "raw_responses",
        F.filter(F.col("_answers.raw_response"), lambda raw: F.length(raw) > 0),
    ).drop("_answers")
