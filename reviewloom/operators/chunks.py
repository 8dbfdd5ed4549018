"""Token counts and chunks of bounded size. No shuffle, nothing leaves the row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.parts import parts
from reviewloom.functions.text import UNICODE, WS, is_blank
from reviewloom.functions.tokens import TokenCounter, word_tokens
from reviewloom.operators.clean import clean_text

# Fixed value: tokens per chunk.
MAX_TOKENS = 400

# Stand for the start of a chunk, and for themselves in texts that have them.
CHUNK_MARK, ESCAPE_MARK = "\x01", "\x02"


def split_sentences(text: Column) -> Column:
    return F.split(text, f"{UNICODE}(?<=[.!?])[{WS}]+", -1)


def chunk_opens(counts: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Whether each sentence opens a chunk, because it no longer fits in the current one.

    Each answer depends on all before it, which no array function can say without
    copying what it has said so far. So the counts, and only they, go through Python.
    """

    @F.arrow_udf("array<boolean>")
    def opens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in parts(batches):
            found = []
            for counts in lists.to_pylist():
                filled, row = 0, None if counts is None else []
                for place, count in enumerate(counts or ()):
                    row.append(place == 0 or filled + count > max_tokens)
                    filled = count if row[-1] else filled + count
                found.append(row)
            yield pa.array(found, pa.list_(pa.bool_()))

    return opens(counts)


def join_chunks(sentences: Column, opens: Column) -> Column:
    """The sentences of each chunk, joined by one space; the time is linear in the text.

    They are joined to one text with a mark before each chunk, which is then cut at the
    marks. In texts that have the mark themselves, which cleaned ones have not, it is
    written as two other signs meanwhile.
    """
    held = F.exists(sentences, lambda sentence: F.contains(sentence, F.lit(CHUNK_MARK)))

    def cut(escaped: Column) -> Column:
        led = F.zip_with(
            escaped,
            opens,
            lambda sentence, open_: F.concat(F.when(open_, CHUNK_MARK).otherwise(" "), sentence),
        )
        pieces = F.split(F.array_join(led, ""), CHUNK_MARK, -1)
        # Before the first mark there is nothing.
        return F.slice(pieces, 2, F.size(pieces))

    def written(sentence: Column) -> Column:
        once = F.replace(sentence, F.lit(ESCAPE_MARK), F.lit(ESCAPE_MARK + "e"))
        return F.replace(once, F.lit(CHUNK_MARK), F.lit(ESCAPE_MARK + "c"))

    def read(chunk: Column) -> Column:
        once = F.replace(chunk, F.lit(ESCAPE_MARK + "c"), F.lit(CHUNK_MARK))
        return F.replace(once, F.lit(ESCAPE_MARK + "e"), F.lit(ESCAPE_MARK))

    safe = F.transform(cut(F.transform(sentences, written)), read)
    return F.when(held, safe).otherwise(cut(sentences))


def settled(table: DataFrame) -> DataFrame:
    """The same rows, whose columns are worked out before others are made of them.

    Where two Python calls follow one another, the optimizer else puts the whole
    expression of a column wherever it is read. It does not look through a generator, while
    filters and the choice of columns pass this one.
    """
    return table.select("*", F.explode(F.array(F.lit(True))).alias("_one")).drop("_one")


def add_token_count(
    reviews: DataFrame, text: str = "cleaned_text", counter: TokenCounter = word_tokens
) -> DataFrame:
    return settled(reviews).withColumn("token_count", counter(F.array(F.col(text)))[0])


def add_chunks(
    reviews: DataFrame,
    text: str = "cleaned_text",
    counter: TokenCounter = word_tokens,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Adds ``chunks`` to rows that hold ``token_count``.

    A text within the limit is its own only chunk; only longer ones are split.
    Each intermediate is a column of its own, so it is computed once.
    """
    too_long = F.col("token_count") > max_tokens
    return (
        settled(reviews)
        .withColumn("_sentences", F.when(too_long, split_sentences(F.col(text))))
        .withColumn("_counts", counter(F.col("_sentences")))
        .withColumn("_opens", chunk_opens(F.col("_counts"), max_tokens))
        .withColumn(
            "chunks",
            F.when(too_long, join_chunks(F.col("_sentences"), F.col("_opens"))).otherwise(
                F.array(F.col(text))
            ),
        )
        .drop("_sentences", "_counts", "_opens")
    )


def preprocess_reviews(
    reviews: DataFrame, counter: TokenCounter = word_tokens, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Adds cleaned_text, token_count, chunks and chunk_count to every review."""
    cleaned = reviews.withColumn("cleaned_text", clean_text(F.col("review_text")))
    counted = add_token_count(cleaned, counter=counter)
    chunked = add_chunks(counted, counter=counter, max_tokens=max_tokens)
    return chunked.withColumn("chunk_count", F.size("chunks"))


def preprocess_metrics(preprocessed: DataFrame) -> DataFrame:
    """Rows and average tokens per review, 0 where there is no review."""
    return preprocessed.agg(
        F.count("*").alias("reviews"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_tokens"),
    )


def chunks_or_text(reviews: DataFrame) -> Column:
    """A review's chunks; where they are null, its cleaned text is the only one."""
    text = F.col("cleaned_text") if "cleaned_text" in reviews.columns else F.lit("")
    return F.coalesce("chunks", F.array(F.coalesce(text, F.lit(""))))


def explode_chunks(preprocessed: DataFrame) -> DataFrame:
    """One row per non-blank chunk with its position in the review.

    The outer form, although no review is without chunks: for the inner one the
    optimizer adds a filter on the array's size, and so computes the chunks twice.
    """
    columns = [c for c in preprocessed.columns if c != "chunks"]
    return preprocessed.select(
        *columns, F.posexplode_outer(chunks_or_text(preprocessed)).alias("chunk_idx", "chunk")
    ).where(~is_blank(F.col("chunk")))
