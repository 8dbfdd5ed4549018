"""Python calls hold a small part of an Arrow batch as objects, whatever the batch."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.functions.parts import PART_BYTES, parts
from reviewloom.functions.tokens import bpe_tokens
from reviewloom.operators import chunks, clean, completion

MB = 1 << 20


@pytest.mark.parametrize("kind", [pa.string(), pa.list_(pa.string())])
def test_parts_are_all_rows_in_order_and_small(kind):
    rng = random.Random(3)
    texts = [rng.choice([None, "", "é" * rng.randint(0, 900)]) for _ in range(700)]
    rows = texts if kind == pa.string() else [t if t is None else [t, None, t] for t in texts]
    batches = [pa.array(rows[:300], kind), pa.array([], kind), pa.array(rows, kind).slice(300)]
    for most in (1, 5000, MB):
        found = list(parts(batches, most))
        assert [row for part in found for row in part.to_pylist()] == rows
        assert all(len(part) == 1 or part.nbytes <= most for part in found)
    assert len(list(parts(batches, MB))) == 3


class Call:
    """Keeps a Python function instead of sending it to workers."""

    def __init__(self, function):
        self.function = function

    def __call__(self, *columns):
        return F.lit(None)

    def asNondeterministic(self):
        return self


def body(monkeypatch, make):
    """The Python function of the call that ``make`` builds."""
    held = []
    with monkeypatch.context() as patched:
        patched.setattr(F, "arrow_udf", lambda kind: lambda f: held.append(Call(f)) or held[-1])
        make()
    return held[0].function


def most_held(function, batch):
    """Rows that came out, and the most bytes of Python objects meanwhile."""
    tracemalloc.start()
    rows = sum(len(found) for found in function(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return rows, most


def test_composition_holds_a_part_of_its_batch(spark, monkeypatch):
    composed = body(monkeypatch, lambda: clean.compose(F.lit("x")))
    batch = pa.array(["é\U0001f600" + "x" * 6000] * 5000)
    rows, most = most_held(composed, batch)
    # As Python texts the batch has 120 MB, and its result as many.
    assert rows == 5000 and most < 16 * PART_BYTES


def test_chunk_limits_hold_a_part_of_their_batch(spark, monkeypatch):
    opens = body(monkeypatch, lambda: chunks.chunk_opens(F.lit(None)))
    batch = pa.array([list(range(1000, 1200))] * 10000, pa.list_(pa.int32()))
    rows, most = most_held(opens, batch)
    assert rows == 10000 and most < 24 * PART_BYTES


def test_token_counts_hold_a_part_of_their_batch(spark, monkeypatch):
    class Words:
        def encode(self, text):
            return text.split()

    count = body(monkeypatch, lambda: bpe_tokens(Words)(F.lit(None)))
    batch = pa.array([["\U0001f600 " + "x" * 3000] * 2] * 5000)
    rows, most = most_held(count, batch)
    assert rows == 5000 and most < 16 * PART_BYTES


def test_answers_hold_a_part_of_their_batch(spark, monkeypatch):
    calls = []

    def factory():
        def client(prompts, temperature, max_tokens):
            calls.append(len(prompts))
            return [prompt * 2 for prompt in prompts]

        return client

    settings = completion.CompletionSettings(batch=16)
    answers = body(monkeypatch, lambda: completion.complete(F.lit(None), factory, settings))
    batch = pa.array([["x" * 1000, "y" * 1000], None, []] * 5000, pa.list_(pa.string()))
    rows, most = most_held(answers, batch)
    assert rows == 15000 and most < 12 * PART_BYTES
    # Calls are full across rows and parts.
    assert set(calls) == {16}
