import random
import re
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.tokens import bpe_tokens
from reviewloom.operators.chunks import (
    explode_chunks,
    preprocess_metrics,
    preprocess_reviews,
    split_sentences,
)


def count(text):
    return int(len(text.split()) * 1.3)


def check_chunks(text, chunks, limit, size=count):
    """Whole, within the limit, and none could have taken the sentence after it."""
    sentences = re.split(r"(?<=[.!?])\s+", text)
    if size(text) <= limit:
        assert chunks == [text]
        return
    assert " ".join(chunks) == " ".join(sentences)
    at = 0
    for chunk in chunks:
        first = at
        while " ".join(sentences[first:at]) != chunk:
            at += 1
        sizes = [size(sentence) for sentence in sentences[first:at]]
        assert sum(sizes) <= limit or len(sizes) == 1
        if at < len(sentences):
            assert sum(sizes) + size(sentences[at]) > limit
    assert at == len(sentences)


def random_review(rng):
    sentences = []
    for _ in range(rng.randint(0, 30)):
        words = ["w" * rng.randint(1, 4) for _ in range(rng.randint(1, 25))]
        sentences.append(" ".join(words) + rng.choice([".", "!", "?", "...", ""]))
    return rng.choice([" ", "\n", "\n\n"]).join(sentences)


def preprocessed(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "review_key int, review_text string")
    return preprocess_reviews(rows, **options)


@pytest.mark.parametrize("limit", [1, 20, 60, 400])
def test_packing_against_brute_force(spark, limit):
    rng = random.Random(limit)
    texts = [random_review(rng) for _ in range(120)]
    for row in preprocessed(spark, texts, max_tokens=limit).collect():
        assert row.token_count == count(row.cleaned_text)
        check_chunks(row.cleaned_text, row.chunks, limit)
        assert row.chunk_count == len(row.chunks) >= 1
        # Nothing is lost and nothing is repeated.
        assert " ".join(row.chunks).split() == row.cleaned_text.split()


def test_sentences(apply):
    texts = ["", "One. Two!  Three?\nfour", "a...b. c", "x.\u2003y", ". . ."]
    assert apply(split_sentences, texts) == [re.split(r"(?<=[.!?])\s+", t) for t in texts]


def test_one_long_sentence_is_one_chunk(spark):
    row = preprocessed(spark, ["word " * 500]).first()
    assert (row.token_count, row.chunk_count) == (650, 1)


def test_empty_text_has_one_empty_chunk(spark):
    for row in preprocessed(spark, ["", None, "\U0001f600"]).collect():
        assert (row.chunks, row.chunk_count, row.token_count) == ([""], 1, 0)


def test_limit_is_inclusive(spark):
    # 307 words make 399 tokens, 308 make 400, 309 make 401.
    texts = ["a. " * n for n in (307, 308, 309)]
    found = [(r.token_count, r.chunk_count) for r in preprocessed(spark, texts).collect()]
    assert found[:2] == [(399, 1), (400, 1)]
    # Above the limit as a whole, but its 309 sentences count one token each.
    assert found[2] == (401, 1)


def test_other_counter(spark):
    by_length = preprocessed(
        spark, ["Abc. Defg. Hi."], counter=lambda t: F.transform(t, F.length), max_tokens=9
    )
    assert by_length.first().chunks == ["Abc. Defg.", "Hi."]


def test_vocabulary_counter(spark):
    def load():
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        return tiktoken.Encoding(
            "bytes", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={}
        )

    rows = preprocessed(
        spark, ["Abc. Defg. Hi.", "Short.", ""], counter=bpe_tokens(load), max_tokens=9
    ).collect()
    assert [r.chunks for r in rows] == [["Abc. Defg.", "Hi."], ["Short."], [""]]
    assert [r.token_count for r in rows] == [14, 6, 0]


def test_texts_with_the_marks_of_chunks(spark):
    from reviewloom.operators.chunks import add_chunks, add_token_count

    texts = ["a\x01b c. \x02 d\x02c e. " * 9, "\x01\x01. \x02e\x02\x02c. " * 9, "no. marks. " * 9]
    texts = [text.strip() for text in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "cleaned_text string")
    for row in add_chunks(add_token_count(rows), max_tokens=5).collect():
        check_chunks(row.cleaned_text, row.chunks, 5)
        assert len(row.chunks) > 3


def test_time_is_linear_in_the_text(spark):
    def seconds(repeats):
        rows = preprocessed(spark, ["Some words stand here. " * repeats])
        started = time.perf_counter()
        row = rows.select("token_count", "chunk_count", "chunks").first()
        found = time.perf_counter() - started
        # A sentence is five tokens, a chunk eighty sentences.
        assert (row.token_count, row.chunk_count) == (int(4 * repeats * 1.3), -(-repeats // 80))
        assert row.chunks[0] == ("Some words stand here. " * 80).strip()
        return found

    seconds(20_000)
    small, large = (min(seconds(n) for _ in range(2)) for n in (45_000, 720_000))
    # 1 and 16 MB; a quadratic step would take 256 times as long.
    assert large < 40 * small


def test_metrics(spark):
    rows = preprocessed(spark, ["a b c", "d"])
    assert preprocess_metrics(rows).first().asDict() == {"reviews": 2, "avg_tokens": 2.0}
    none = preprocess_metrics(rows.where("false")).first()
    assert none.asDict() == {"reviews": 0, "avg_tokens": 0.0}


def test_explode_keeps_positions_and_skips_blanks(spark):
    rows = spark.createDataFrame(
        [(1, ["a", " \u2003", "b"]), (2, [""])], "review_key int, chunks array<string>"
    )
    found = [tuple(r) for r in explode_chunks(rows).orderBy("chunk_idx").collect()]
    assert found == [(1, 0, "a"), (1, 2, "b")]
