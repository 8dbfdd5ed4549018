"""One query per operator, over whole tables. Array results are joined to text
or exploded, as the comparison is by plain values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from checks.clients import failing_client
from checks.offline_client import offline_batch_client, offline_client
from reviewloom.functions.times import moment
from reviewloom.functions.text import is_blank
from reviewloom.functions.tokens import estimate_tokens
from reviewloom.operators import asking, chunks, completion, merge, pages, report
from reviewloom.operators import clean as cleaning
from reviewloom.operators import prompts as prompting
from reviewloom.operators import responses as parsing
from reviewloom.operators.generate import generate_reviews as seven_reviews
from reviewloom.plans.workflow import Store, analyzed, run_reviews
from reviewloom.sinks import documents, flat
from reviewloom.sources.tables import fetched, run_folder

RUN_TIME = datetime(2024, 5, 20, 14, 32, 1)


# Pages and products


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = pages.page_titles(fetched(views.pages(spark, sf_dir)))
    return titles.select("page_id", "url", "product_title")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.product_metadata(fetched(views.product_pages(spark, sf_dir)), RUN_TIME)


def product_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(spark, sf_dir).select(
        "product_title",
        "overall_rating",
        "price",
        "availability",
        "description",
        "scraped_url",
        F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss").alias("scraped_at"),
    )


def spec_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(spark, sf_dir).select(
        "scraped_url", F.explode_outer("specs").alias("spec_key", "spec_value")
    ).where(F.col("spec_key").isNotNull())


def generate_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seven_reviews(_products(spark, sf_dir))


# Cleaning


def fix_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dirty(spark, sf_dir).select(
        "review_key", cleaning.fix_encoding(F.col("review_text")).alias("fixed_text")
    )


def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pages(spark, sf_dir).select(
        "page_id", cleaning.strip_tags(F.col("html")).alias("stripped_text")
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dirty(spark, sf_dir).select(
        "review_key", cleaning.clean_text(F.col("review_text")).alias("cleaned_text")
    )


# Tokens and chunks


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).select(
        "review_key", cleaning.clean_text(F.col("review_text")).alias("cleaned_text")
    )


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.reviews(spark, sf_dir).select(
        "review_key", estimate_tokens(F.col("review_text")).alias("token_count")
    )


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select(
        "review_key",
        F.posexplode_outer(chunks.split_sentences(F.col("cleaned_text"))).alias(
            "position", "sentence"
        ),
    )


def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = chunks.add_chunks(chunks.add_token_count(_cleaned(spark, sf_dir)))
    return packed.select("review_key", F.posexplode_outer("chunks").alias("chunk_idx", "chunk"))


def _preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.preprocess_reviews(views.reviews(spark, sf_dir))


def preprocess_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocessed(spark, sf_dir).drop("chunks")


def preprocess_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = chunks.preprocess_metrics(_preprocessed(spark, sf_dir))
    return metrics.withColumn("avg_tokens", F.round("avg_tokens", 6))


# Prompts and answers


def build_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = prompting.build_prompt(F.col("review_text"), F.col("rating"), F.col("author"))
    return views.reviews(spark, sf_dir).select("review_key", prompt.alias("prompt"))


def explode_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Reviews of many chunks, with a blank one before and after them.
    padded = _preprocessed(spark, sf_dir).withColumn(
        "chunks", F.concat(F.array(F.lit(" \u2003")), "chunks", F.array(F.lit("")))
    )
    return chunks.explode_chunks(padded).select("review_key", "chunk_idx", "chunk")


def _asked(spark: SparkSession, sf_dir: str, client_factory=offline_client, **options) -> DataFrame:
    # The turns of a conversation are given one per row already.
    texts = views.turns(spark, sf_dir).where(~is_blank(F.col("chunk")))
    asked = texts.withColumns(
        {"rating": F.lit(None).cast("int"), "author": F.lit(None).cast("string")}
    )
    return completion.complete_chunks(asked, client_factory, **options)


def completion_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = completion.answered(_asked(spark, sf_dir))
    return kept.select("review_key", "chunk_idx", "raw_response", "attempts")


def retry_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = completion.CompletionSettings(sleep=lambda seconds: None)
    asked = _asked(spark, sf_dir, client_factory=failing_client, settings=settings)
    return asked.select(
        "review_key",
        "chunk_idx",
        "attempts",
        "error_class",
        "waited",
        F.col("raw_response").isNotNull().alias("got_answer"),
    )


def stored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk asked once, in calls of 16 prompts, by two runs of which the first was
    cut off after one round of three."""
    store = Store(run_folder(spark), "run")
    # Stored as in a run: each call below reads the prompts twice.
    chunked = _preprocessed(spark, sf_dir).select("review_key", "rating", "author", "chunks")
    prompts = asking.chunk_prompts(store.keep(chunked, "preprocessed"))
    path = store.path("responses")
    options = {
        "client_factory": offline_batch_client,
        "settings": completion.CompletionSettings(batch=16),
    }
    asking.ask_chunks(prompts, path, rounds=3, most_rounds=1, **options)
    done = asking.ask_chunks(prompts, path, rounds=2, **options)
    return done.select("review_key", "chunk_idx", "raw_response", "attempts", "error_class")


# Parsing


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = views.responses(spark, sf_dir).where(~is_blank(F.col("chunk")))
    return parsing.parse_responses(completion.answered(answers))


def parse_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select(
        "review_key", "chunk_idx", "sentiment", "confidence", "llm_summary"
    )


def parse_key_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select(
        "review_key", "chunk_idx", F.size("key_points").alias("points"), "key_points_str"
    )


def parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return parsing.parse_responses(talks, raw="text").select(
        "conv_id", "turn", "text", "sentiment", "confidence", "llm_summary", "key_points_str"
    )


# Merging


def merge_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_sentiment(_parsed(spark, sf_dir))


def merge_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_confidence(_parsed(spark, sf_dir))


def merge_key_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_key_points(_parsed(spark, sf_dir)).select("review_key", "key_points_str")


def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_summary(_parsed(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyzed(views.reviews(spark, sf_dir), offline_client)


ANALYSIS = (
    "review_key",
    "token_count",
    "sentiment",
    "confidence",
    "key_points_str",
    "llm_summary",
    "raw_llm_response",
    "chunks_analyzed",
)


def analyze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select(*ANALYSIS)


def _source_products(reviews: DataFrame) -> DataFrame:
    """A product per source, as its page would give it."""
    products = reviews.groupBy("source_url").agg(
        F.max("product_title").alias("product_title"), F.max("rating").alias("overall_rating")
    )
    return products.select(
        "product_title",
        "overall_rating",
        *[F.lit("N/A").alias(name) for name in ("price", "availability", "description")],
        F.create_map(F.lit("lang"), F.lit("any")).alias("specs"),
        F.col("source_url").alias("scraped_url"),
        moment(RUN_TIME).alias("scraped_at"),
    )


def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run that goes on where one was cut off: its products, preprocessed reviews
    and a third of its responses were there."""
    folder, reviews = run_folder(spark), views.reviews(spark, sf_dir)
    products = _source_products(reviews)
    cut_off = Store(folder, "run")
    cut_off.keep(products, "products")
    preprocessed = cut_off.keep(chunks.preprocess_reviews(reviews), "preprocessed")
    prompts = asking.chunk_prompts(preprocessed)
    responses = cut_off.path("responses")
    asking.ask_chunks(prompts, responses, offline_client, rounds=3, most_rounds=1)
    run = run_reviews(
        reviews, products, folder, "run", RUN_TIME, resume=True, rounds=2, client_factory=offline_client
    )
    return spark.read.parquet(run.enriched_path).select(*ANALYSIS)


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole run reports and what its files hold, per product."""
    reviews = views.reviews(spark, sf_dir)
    run = run_reviews(
        reviews, _source_products(reviews), run_folder(spark), "run", RUN_TIME, client_factory=offline_client
    )
    header = run.report["header"].select("product_title", F.col("scraped_url").alias("source_url"))
    rows = flat.read_csv(spark, run.csv_path).groupBy("source_url").agg(F.count("*").alias("csv_rows"))
    listed = documents.read_openings(spark, run.json_path).select(
        "source_url", F.col("total_reviews").alias("json_reviews")
    )
    figures = run.report["metrics"].drop("product_title").join(run.report["stats"], "source_url")
    joined = header.join(figures, "source_url").join(rows, "source_url").join(listed, "source_url")
    return _rounded(joined, "avg_rating", "avg_confidence", "avg_tokens")


# Output


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.export_rows(_enriched(spark, sf_dir))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_folder(spark)}/csv"
    flat.write_csv(flat.export_rows(_preprocessed(spark, sf_dir)), path)
    return flat.read_csv(spark, path)


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the form of one line a record, which is read in many tasks."""
    path = f"{run_folder(spark)}/csv"
    flat.write_csv(flat.export_rows(_preprocessed(spark, sf_dir)), path, splittable=True)
    return flat.read_csv(spark, path, splittable=True)


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark)
    documents.with_json_bytes(_enriched(spark, sf_dir)).write.parquet(f"{folder}/enriched")
    enriched = spark.read.parquet(f"{folder}/enriched")
    documents.write_documents(enriched, _source_products(enriched), f"{folder}/json", RUN_TIME)
    fields = (
        "review_id string, rating int, cleaned_text string, chunk_count int, sentiment string, "
        "confidence double, key_points array<string>, raw_llm_response string"
    )
    openings = documents.read_openings(spark, f"{folder}/json")
    reviews = documents.read_reviews(spark, f"{folder}/json", fields)
    review = F.col("review")

    def total(value):
        return F.sum(value.cast("bigint"))

    sums = reviews.groupBy("source_url").agg(
        F.count("*").cast("int").alias("listed"),
        # Equal where the same reviews are there, whatever their order, and added map-side.
        F.sum(_digest(F.concat_ws("|", "review_key", "review.review_id"))).alias("ids_digest"),
        total(F.coalesce(review["rating"], F.lit(0))).alias("rating_sum"),
        total(F.length(review["cleaned_text"])).alias("text_length"),
        total(review["chunk_count"]).alias("chunks"),
        total(review["confidence"].isNotNull()).alias("confident"),
        total(F.size(review["key_points"])).alias("points"),
        total(F.length(review["raw_llm_response"])).alias("raw_length"),
        total(review["sentiment"] == "Mixed").alias("mixed"),
    )
    misplaced = documents.misplaced_pieces(spark, f"{folder}/json")
    page = F.col("product_metadata")
    joined = openings.join(sums, "source_url").join(misplaced, "source_url", "left")
    return joined.select(
        page["scraped_url"].alias("source_url"),
        page["product_title"].alias("product_title"),
        page["overall_rating"].cast("int").alias("overall_rating"),
        page["scraped_at"].alias("scraped_at"),
        "generated_at",
        "total_reviews",
        *[name for name in sums.columns if name != "source_url"],
        F.coalesce("misplaced", F.lit(0)).cast("int").alias("misplaced"),
    )


def _digest(text):
    """A number of 44 bits from a text; a million million of them fit one sum."""
    return F.conv(F.substring(F.md5(text), 1, 11), 16, 10).cast("bigint")


# Report


def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_header(_products(spark, sf_dir))


def report_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.report_stats(_enriched(spark, sf_dir))
    return _rounded(stats, "avg_rating", "avg_confidence", "avg_tokens")


def sentiment_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.sentiment_breakdown(_enriched(spark, sf_dir))


def sample_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.sample_summaries(_enriched(spark, sf_dir))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.run_metrics(_enriched(spark, sf_dir))


def source_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = report.source_overview(_enriched(spark, sf_dir))
    return _rounded(overview, "avg_rating", "avg_confidence", "avg_tokens")


def _rounded(table: DataFrame, *means: str) -> DataFrame:
    """Means to six places: their last digits depend on the order of addition."""
    return table.withColumns({name: F.round(name, 6) for name in means})


QUERIES = {
    "page_title": page_title,
    "product_metadata": product_metadata,
    "spec_table": spec_table,
    "generate_reviews": generate_reviews,
    "fix_encoding": fix_encoding,
    "strip_tags": strip_tags,
    "clean_text": clean_text,
    "token_count": token_count,
    "sentence_split": sentence_split,
    "chunk_pack": chunk_pack,
    "preprocess_reviews": preprocess_reviews,
    "preprocess_metrics": preprocess_metrics,
    "build_prompt": build_prompt,
    "explode_chunks": explode_chunks,
    "completion": completion_answers,
    "retry_outcomes": retry_outcomes,
    "stored_responses": stored_responses,
    "parse_fields": parse_fields,
    "parse_key_points": parse_key_points,
    "parse_malformed": parse_malformed,
    "merge_sentiment": merge_sentiment,
    "merge_confidence": merge_confidence,
    "merge_key_points": merge_key_points,
    "merge_summary": merge_summary,
    "analyze_reviews": analyze_reviews,
    "resumed_run": resumed_run,
    "whole_run": whole_run,
    "export_rows": export_rows,
    "csv_roundtrip": csv_roundtrip,
    "csv_lines": csv_lines,
    "json_documents": json_documents,
    "report_header": report_header,
    "report_stats": report_stats,
    "sentiment_breakdown": sentiment_breakdown,
    "sample_summaries": sample_summaries,
    "run_metrics": run_metrics,
    "source_overview": source_overview,
}
