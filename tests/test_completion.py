import pytest
from pyspark.sql import functions as F

from reviewloom.operators.completion import (
    CompletionSettings,
    add_answers,
    answered,
    ask,
    ask_all,
    ask_batch,
    complete,
    complete_chunks,
    error_class,
)
from checks.offline_client import canned_answer, offline_client, reviewed_text
from reviewloom.operators.prompts import build_prompt

# Fixed value: the prompt as it must come out.
PROMPT = """You are a product review analyst. Analyze the following customer review and return a structured analysis.

{context}

REVIEW:
\"\"\"
{text}
\"\"\"

Respond in exactly this format (no extra text):

SENTIMENT: <Positive | Negative | Neutral | Mixed>
CONFIDENCE: <a score from 0.0 to 1.0>
KEY_POINTS:
- <point 1>
- <point 2>
- <point 3 if applicable>
SUMMARY: <one concise sentence summarizing the review>
"""


def test_prompt(spark):
    cases = [
        ("t", 4, "Ann", "Written by: Ann. The reviewer gave a rating of 4/5."),
        ("t", 0, "", " "),
        ("t", None, None, " "),
        ("", None, "Bo", "Written by: Bo. "),
        ('q """ \n x', 5, None, " The reviewer gave a rating of 5/5."),
    ]
    rows = spark.createDataFrame(cases, "text string, rating int, author string, context string")
    prompt = build_prompt(F.col("text"), F.col("rating"), F.col("author"))
    for row in rows.withColumn("prompt", prompt).collect():
        assert row.prompt == PROMPT.format(context=row.context, text=row.text)
        assert reviewed_text(row.prompt) == row.text


@pytest.mark.parametrize(
    "message, name",
    [
        ("Rate Limit reached", "rate_limit"),
        ("HTTP 429", "rate_limit"),
        ("502 bad gateway", "server"),
        ("500: rate limit", "rate_limit"),
        ("401 unauthorized", "auth"),
        ("Invalid API Key", "auth"),
        ("503 after 401", "server"),
        ("timed out", "other"),
    ],
)
def test_error_classes(message, name):
    assert error_class(message) == name


def scripted(errors):
    left = list(errors)

    def client(prompt, temperature, max_tokens):
        assert (temperature, max_tokens) == (0.3, 300)
        if left:
            raise RuntimeError(left.pop(0))
        return "fine"

    return client


@pytest.mark.parametrize(
    "errors, attempts, failure, pauses",
    [
        ([], 1, None, []),
        (["429"], 2, None, [2]),
        (["503", "503"], 3, None, [2, 4]),
        (["401"], 1, "auth", []),
        (["boom", "401"], 2, "auth", [2]),
        (["429"] * 9, 4, "rate_limit", [2, 4, 8, 16]),
        (["429", "500", "x", "x"], 4, "other", [2, 4, 8, 16]),
    ],
)
def test_retries(errors, attempts, failure, pauses):
    slept = []
    answer = ask(scripted(errors), "p", CompletionSettings(sleep=slept.append))
    assert (answer["attempts"], answer["error_class"]) == (attempts, failure)
    assert slept == pauses and answer["waited"] == sum(pauses)
    assert answer["raw_response"] == (None if failure else "fine")


def test_waits_are_capped():
    slept = []
    ask(scripted(["x"] * 9), "p", CompletionSettings(attempts=7, sleep=slept.append))
    assert slept == [2, 4, 8, 16, 32, 60, 60]


def test_one_client_per_task_and_delay(spark):
    def factory():
        calls = []

        def client(prompt, temperature, max_tokens):
            calls.append(prompt)
            return f"{prompt}:{len(calls)}"

        return client

    rows = spark.createDataFrame([(["a", "b"],), (["c"],), ([],), (None,)], "p array<string>")
    out = rows.coalesce(1).select(complete(F.col("p"), factory, CompletionSettings()).alias("r"))
    raws = [[a.raw_response for a in row.r] for row in out.collect()]
    assert raws == [["a:1", "b:2"], ["c:3"], [], []]


def chunk_rows(spark):
    rows = [(i, 0, f"chunk number {i}", None, None) for i in range(60)]
    return spark.createDataFrame(
        rows, "review_key int, chunk_idx int, chunk string, rating int, author string"
    )


def test_one_answer_per_chunk(spark):
    found = complete_chunks(chunk_rows(spark), offline_client).collect()
    assert len(found) == 60
    assert all(row.raw_response == canned_answer(row.chunk) for row in found)
    kept = {row.review_key for row in answered(complete_chunks(chunk_rows(spark), offline_client)).collect()}
    assert kept == {row.review_key for row in found if row.raw_response}
    assert 0 < len(kept) < 60


def test_answers_in_the_row(spark):
    rows = spark.createDataFrame(
        [(1, ["one", " ", "three"], 4, "Ann"), (2, [""], None, None)],
        "review_key int, chunks array<string>, rating int, author string",
    )

    def factory():
        return lambda prompt, temperature, max_tokens: reviewed_text(prompt).upper()

    found = {r.review_key: r.raw_responses for r in add_answers(rows, factory).collect()}
    assert found == {1: ["ONE", "THREE"], 2: []}


def test_filter_does_not_repeat_the_call(spark):
    plan = (
        complete_chunks(chunk_rows(spark), offline_client)
        .where("raw_response is not null and attempts = 1")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert plan.count("ArrowEvalPython") == 1


def test_an_error_in_a_batch_leaves_the_others():
    asked, slept = [], []

    def client(prompts, temperature, max_tokens):
        assert (temperature, max_tokens) == (0.3, 300)
        asked.append(list(prompts))
        return [
            RuntimeError("401") if p == "bad" else RuntimeError("503") if p == "slow" and len(asked) < 3 else
            RuntimeError("boom") if p == "never" else None if p == "nothing" else p.upper()
            for p in prompts
        ]

    settings = CompletionSettings(sleep=slept.append)
    found = ask_batch(client, ["a", "bad", "slow", "nothing", "never"], settings)
    assert [(x["raw_response"], x["attempts"], x["error_class"], x["waited"]) for x in found] == [
        ("A", 1, None, 0), (None, 1, "auth", 0), ("SLOW", 3, None, 6), (None, 1, None, 0),
        (None, 4, "other", 30),
    ]
    assert asked == [["a", "bad", "slow", "nothing", "never"], *[["slow", "never"]] * 2, ["never"]]
    assert slept == [2, 4, 8, 16]


def test_an_error_of_the_whole_call_is_everyones():
    replies = [RuntimeError("429"), ["one"], ["x", "y"]]

    def client(prompts, temperature, max_tokens):
        reply = replies.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return reply

    # The second call answers too few prompts, which is an error too.
    found = ask_batch(client, ["p", "q"], CompletionSettings(sleep=lambda _: None))
    assert [(x["raw_response"], x["attempts"]) for x in found] == [("x", 3), ("y", 3)]


def test_no_more_prompts_are_held_than_a_call_takes():
    taken, calls = [], []

    def prompts():
        for i in range(10):
            taken.append(i)
            yield f"p{i}"

    def client(batch, temperature, max_tokens):
        calls.append((len(batch), len(taken)))
        return batch

    found = ask_all(client, prompts(), CompletionSettings(batch=4))
    assert next(found)["raw_response"] == "p0" and len(taken) == 4
    assert [x["raw_response"] for x in found] == [f"p{i}" for i in range(1, 10)]
    assert calls == [(4, 4), (4, 8), (2, 10)]


def test_batches_reach_across_rows(spark):
    def factory():
        return lambda prompts, temperature, max_tokens: [f"{p}/{len(prompts)}" for p in prompts]

    rows = spark.createDataFrame(
        [(["a", "b"],), (["c"],), ([],), (None,), (["d", "e"],)], "p array<string>"
    )
    settings = CompletionSettings(batch=3)
    out = rows.coalesce(1).select(complete(F.col("p"), factory, settings).alias("r"))
    raws = [[a.raw_response for a in row.r] for row in out.collect()]
    assert raws == [["a/3", "b/3"], ["c/3"], [], [], ["d/2", "e/2"]]
