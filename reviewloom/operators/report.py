"""Figures of the summary report and of the stages. All group sizes are reduced
map-side; ``by`` names the grouping columns, none means one figure for all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.operators.pages import MISSING

PER_PRODUCT = ("source_url",)
FAILED_SENTIMENTS = ("Unknown", "")
BAR = "\u2588"
LABEL_WIDTH = 10
SAMPLE_SIZE = 3


def report_header(products: DataFrame) -> DataFrame:
    """Title, price, rating, address and time of each product, as shown."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(MISSING)).alias(name)

    return products.select(
        *[
            shown(name)
            for name in ("product_title", "price", "overall_rating", "scraped_url", "scraped_at")
        ]
    )


def report_stats(enriched: DataFrame, by=PER_PRODUCT) -> DataFrame:
    """Reviews and mean rating, confidence and tokens; null where nothing is known."""

    def mean(name: str) -> Column:
        return F.avg(F.col(name).try_cast("double"))

    return enriched.groupBy(*by).agg(
        F.count("*").alias("total_reviews"),
        mean("rating").alias("avg_rating"),
        mean("confidence").alias("avg_confidence"),
        mean("token_count").alias("avg_tokens"),
    )


def sentiment_breakdown(enriched: DataFrame, by=(), reviews_per_mark: int = 1) -> DataFrame:
    """Reviews per label, most frequent first, with the label and bar as drawn.

    A mark stands for a review, or for up to ``reviews_per_mark``; with so many reviews
    that a line of one mark each is no text any more (2^31 bytes), give a larger one.
    """
    # The group of nulls counts 0. A filter on the label itself would sink below
    # the aggregate and work the label out twice where it is not stored.
    counts = (
        enriched.groupBy(*by, "sentiment")
        .agg(F.count("sentiment").alias("reviews"), F.min("review_key").alias("first_key"))
        .where(F.col("reviews") > 0)
    )
    # rpad would cut labels longer than the column.
    padded = F.when(
        F.length("sentiment") < LABEL_WIDTH, F.rpad("sentiment", LABEL_WIDTH, " ")
    ).otherwise(F.col("sentiment"))
    length = F.ceil(F.col("reviews") / reviews_per_mark).cast("int")
    return (
        counts.orderBy(*by, F.desc("reviews"), "first_key")
        .withColumns({"label": padded, "bar": F.repeat(F.lit(BAR), length)})
        .drop("first_key")
    )


def sample_summaries(enriched: DataFrame, by=(), size: int = SAMPLE_SIZE) -> DataFrame:
    """The first reviews, of all or of each group, with rating and summary."""
    columns = ("author", "rating", "sentiment", "llm_summary")
    rows = enriched.select(*by, "review_key", *columns)
    if not by:
        return rows.orderBy("review_key").limit(size)
    # The group limit below the window keeps `size` rows per group and task.
    in_order = Window.partitionBy(*by).orderBy("review_key")
    ranked = rows.withColumn("_rank", F.row_number().over(in_order))
    return ranked.where(F.col("_rank") <= size).drop("_rank")


def run_metrics(enriched: DataFrame, by=PER_PRODUCT) -> DataFrame:
    """Reviews, chunks, and reviews with a usable sentiment."""
    failed = F.coalesce("sentiment", F.lit("")).isin(*FAILED_SENTIMENTS)
    return enriched.groupBy(*by).agg(
        F.max("product_title").alias("product_title"),
        F.count("*").alias("reviews"),
        F.coalesce(F.sum("chunk_count"), F.lit(0)).alias("total_chunks"),
        F.count_if(~failed).alias("successful"),
    )


def source_overview(enriched: DataFrame) -> DataFrame:
    """One line per product: the stage counts, the means and the leading sentiment.

    A first aggregate per product and label carries everything as sums, so the
    reviews are shuffled once and only as partial sums.
    """
    failed = F.coalesce("sentiment", F.lit("")).isin(*FAILED_SENTIMENTS)
    per_label = enriched.groupBy("source_url", "sentiment").agg(
        F.count("*").alias("reviews"),
        F.min("review_key").alias("first_key"),
        F.sum("chunk_count").alias("chunks"),
        F.count_if(~failed).alias("successful"),
        F.sum(F.col("rating").try_cast("double")).alias("rating_sum"),
        F.count(F.col("rating").try_cast("double")).alias("rated"),
        F.sum("confidence").alias("confidence_sum"),
        F.count("confidence").alias("confident"),
        F.sum("token_count").alias("tokens"),
    )
    # Most reviews first, then the label seen first: the least of this pair.
    standing = F.when(
        F.col("sentiment").isNotNull(),
        F.struct((-F.col("reviews")).alias("n"), F.col("first_key"), F.col("sentiment")),
    )
    totals = per_label.groupBy("source_url").agg(
        F.sum("reviews").alias("reviews"),
        F.sum("chunks").alias("total_chunks"),
        F.sum("successful").alias("successful"),
        F.try_divide(F.sum("rating_sum"), F.sum("rated")).alias("avg_rating"),
        F.try_divide(F.sum("confidence_sum"), F.sum("confident")).alias("avg_confidence"),
        F.try_divide(F.sum("tokens"), F.sum("reviews")).alias("avg_tokens"),
        F.min(standing).alias("standing"),
    )
    return totals.withColumn("top_sentiment", F.col("standing.sentiment")).drop("standing")
