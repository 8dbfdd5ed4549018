"""From the answers to a review's chunks to one result per review.

Two forms of the same rules. ``analyze_reviews`` works inside the review's row
on the array of its answers: no shuffle, no join. The ``merge_*`` functions
take a table with one row per answer, whose group sizes nobody promises: they
aggregate before the shuffle, or sort and stream, and do not gather a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.rounding import round3
from reviewloom.operators.chunks import chunks_or_text
from reviewloom.operators.completion import (
    ClientFactory,
    CompletionSettings,
    add_answers,
    answered,
)
from reviewloom.operators.responses import KEY_POINT_SEPARATOR, NO_SENTIMENT, parse_answers

# Results of the vote and where nothing was answered; limits.
DIVIDED = "Mixed"
NO_SUMMARY = "No summary generated."
RAW_SEPARATOR = "\n---\n"
MAX_KEY_POINTS = 5


def _elected(top_count: Column, votes: Column, label: Column) -> Column:
    """The most frequent label; several votes that all differ are divided."""
    return F.when((top_count == 1) & (votes > 1), DIVIDED).otherwise(label)


# In the row


def vote(labels: Column) -> Column:
    """Most frequent label, first seen on a tie. Not mode(), whose ties are open."""
    ranked = F.transform(
        F.array_distinct(labels),
        lambda label, seen: F.struct(
            F.size(F.filter(labels, lambda other: other == label)).alias("count"),
            (-seen).alias("earliest"),
            label.alias("label"),
        ),
    )
    top = F.array_max(ranked)
    elected = _elected(top["count"], F.size(labels), top["label"])
    return F.when(F.size(labels) == 0, NO_SENTIMENT).otherwise(elected)


def mean_confidence(confidences: Column) -> Column:
    """Mean of the known values, added up in order; null where none is known."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("known"))
    return F.aggregate(
        F.filter(confidences, lambda value: value.isNotNull()),
        start,
        lambda state, value: F.struct(
            (state["total"] + value).alias("total"), (state["known"] + 1).alias("known")
        ),
        lambda state: F.try_divide(state["total"], state["known"]),
    )


def first_key_points(key_points: Column) -> Column:
    return F.slice(F.array_distinct(F.flatten(key_points)), 1, MAX_KEY_POINTS)


def analyze_reviews(
    preprocessed: DataFrame,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
) -> DataFrame:
    """Every review with its merged analysis, whether anything was answered or not.

    One narrow pass from text to result: a review never meets another one, so
    nothing is shuffled whatever the sizes of products or sources.
    """
    return merge_in_row(add_answers(preprocessed, client_factory, settings))


def analyze_stored(preprocessed: DataFrame, responses: DataFrame) -> DataFrame:
    """The same result from a stored table of responses (see ``asking``).

    The raw answers of a review are one value of its result, joined; here they come
    together as an array, in one shuffle, and the rest is as in the row. Chunks are
    counted before it: they travel only if the result's column is read.
    """
    gathered = answered(responses).groupBy("review_key").agg(
        F.array_sort(F.collect_list(F.struct("chunk_idx", "raw_response"))).alias("_answers")
    )
    raws = F.coalesce(F.col("_answers.raw_response"), F.array().cast("array<string>"))
    counted = preprocessed.withColumn("_analyzed", F.size(chunks_or_text(preprocessed)))
    joined = counted.join(gathered, "review_key", "left")
    return merge_in_row(joined.withColumn("raw_responses", raws).drop("_answers"))


def merge_in_row(reviews: DataFrame) -> DataFrame:
    """Reviews with ``raw_responses``, the answers to their chunks in order, to results."""
    known = "_analyzed" in reviews.columns
    analyzed = F.col("_analyzed") if known else F.size(chunks_or_text(reviews))
    parsed = reviews.withColumn("_parsed", parse_answers(F.col("raw_responses")))
    # Columns of their own first: the expressions below read them several times.
    merged = parsed.withColumns(
        {
            "_labels": F.col("_parsed.sentiment"),
            "_mean": mean_confidence(F.col("_parsed.confidence")),
            "key_points": first_key_points(F.col("_parsed.key_points")),
        }
    )
    return merged.withColumns(
        {
            "sentiment": vote(F.col("_labels")),
            "confidence": round3(F.col("_mean")),
            "key_points_str": F.array_join("key_points", KEY_POINT_SEPARATOR),
            "llm_summary": F.coalesce(
                F.get(F.col("_parsed.llm_summary"), F.lit(0)), F.lit(NO_SUMMARY)
            ),
            "raw_llm_response": F.array_join("raw_responses", RAW_SEPARATOR),
            "chunks_analyzed": analyzed,
        }
    ).drop("_parsed", "_labels", "_mean", "raw_responses", "_analyzed")


# Across rows: one row per answer with review_key and chunk_idx


def merge_sentiment(parsed: DataFrame) -> DataFrame:
    """Vote per review from counts: (review, label) first, then review, both where one
    shuffle by review has put the rows."""
    placed = parsed.select("review_key", "chunk_idx", "sentiment").repartition("review_key")
    counts = placed.groupBy("review_key", "sentiment").agg(
        F.count("*").alias("votes"), F.min("chunk_idx").alias("first_seen")
    )
    top = F.max(
        F.struct(F.col("votes"), (-F.col("first_seen")).alias("earliest"), F.col("sentiment"))
    )
    elected = counts.groupBy("review_key").agg(top.alias("top"), F.sum("votes").alias("votes"))
    return elected.select(
        "review_key",
        _elected(F.col("top.votes"), F.col("votes"), F.col("top.sentiment")).alias("sentiment"),
    )


def merge_confidence(parsed: DataFrame) -> DataFrame:
    """Mean confidence per review.

    Floating-point addition depends on its order and the chunk order is the rule,
    so the values are added by a running sum over three narrow columns, which
    streams through a sorted group and can spill.
    """
    in_order = Window.partitionBy("review_key").orderBy("chunk_idx")
    running = parsed.select(
        "review_key",
        "chunk_idx",
        "confidence",
        F.sum("confidence").over(in_order).alias("running"),
    )
    totals = running.groupBy("review_key").agg(
        F.max_by("running", "chunk_idx").alias("total"), F.count("confidence").alias("known")
    )
    means = totals.select("review_key", F.try_divide("total", "known").alias("mean"))
    return means.select("review_key", round3(F.col("mean")).alias("confidence"))


def merge_key_points(parsed: DataFrame) -> DataFrame:
    """First five different key points per review, in order of appearance.

    One shuffle by review serves all steps: repeats fall away where the rows are, and
    at most five points per review pass the window.
    """
    placed = parsed.select("review_key", "chunk_idx", "key_points").repartition("review_key")
    points = placed.select(
        "review_key", "chunk_idx", F.posexplode_outer("key_points").alias("position", "point")
    )
    # Chunk and position in one number, which a hash aggregate can hold.
    place = F.col("chunk_idx").cast("long") * 2**32 + F.col("position")
    first_seen = points.groupBy("review_key", "point").agg(F.min(place).alias("seen"))
    # A review without any point keeps one row, ranked after real ones.
    in_order = Window.partitionBy("review_key").orderBy(F.col("point").isNull(), "seen")
    kept = first_seen.withColumn("rank", F.row_number().over(in_order)).where(
        F.col("rank") <= MAX_KEY_POINTS
    )
    ranked = F.when(F.col("point").isNotNull(), F.struct("rank", "point"))
    gathered = kept.groupBy("review_key").agg(
        F.array_sort(F.collect_list(ranked))["point"].alias("key_points")
    )
    return gathered.withColumn("key_points_str", F.array_join("key_points", KEY_POINT_SEPARATOR))


def merge_summary(parsed: DataFrame) -> DataFrame:
    """Summary of the first answer and all raw answers joined.

    The joined text is one value by definition, so its parts do come together;
    nothing else does.
    """
    merged = parsed.groupBy("review_key").agg(
        F.min_by("llm_summary", "chunk_idx").alias("llm_summary"),
        F.array_sort(F.collect_list(F.struct("chunk_idx", "raw_response"))).alias("raws"),
    )
    return merged.select(
        "review_key",
        "llm_summary",
        F.array_join("raws.raw_response", RAW_SEPARATOR).alias("raw_llm_response"),
    )
