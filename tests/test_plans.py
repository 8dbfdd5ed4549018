"""What the plans must look like, whatever the size of the tables."""

import re

import pytest
from pyspark.sql import functions as F

from checks import queries as registered
from checks.offline_client import offline_client
from reviewloom.operators import merge, report
from reviewloom.operators.chunks import preprocess_reviews
from reviewloom.plans.workflow import analyzed
from reviewloom.sources.tables import run_folder, spread

SMALL = "/root/testdata/sf0.001"
WRITING = (
    "csv_roundtrip", "csv_lines", "json_documents", "stored_responses", "resumed_run", "whole_run",
)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def many_splits(spark, tmp_path_factory):
    """Reviews in more files than there are cores."""
    path = str(tmp_path_factory.mktemp("reviews") / "table")
    rows = spark.range(0, 80, 1, 8).select(
        F.col("id").alias("review_key"),
        F.lit("i").alias("review_id"),
        F.lit("p").alias("product_title"),
        F.lit("a").alias("author"),
        F.lit(3).alias("rating"),
        F.lit("d").alias("date"),
        F.lit("Some text. And more.").alias("review_text"),
        F.lit("u").alias("source_url"),
    )
    rows.write.parquet(path)
    return spark.read.option("maxPartitionBytes", 1).parquet(path)


def test_analysis_is_one_narrow_stage(spark, many_splits):
    text = plan(analyzed(many_splits, offline_client))
    assert "Exchange" not in text
    # Composition of what may change, chunk limits from counts, and the client: each once.
    names = re.findall(r"ArrowEvalPython \[(\w+)\(", text)
    assert sorted(names) == ["answers", "composed", "opens"]


@pytest.mark.parametrize("name", ["preprocess_reviews", "chunk_pack", "run_metrics", "sample_summaries", "export_rows"])
def test_a_text_is_cleaned_and_split_once(spark, name):
    text = plan(registered.QUERIES[name](spark, SMALL))
    # The patterns of tags, of sentence ends, and of words (of a text and of a sentence).
    assert text.count("<[^>]++>") == 1
    assert text.count("(?<=[.!?])") <= 1
    assert text.count(", x, 1)") <= 2


def test_filters_pass_preprocessing_and_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "reviews")
    rows = [(i, "d", "Caf\u0065\u0301. " * 400, f"u{i % 3}") for i in range(9)]
    frame = spark.createDataFrame(rows, "review_key int, date string, review_text string, source_url string")
    frame.write.partitionBy("date").parquet(path)
    done = preprocess_reviews(spark.read.parquet(path)).where("source_url = 'u1' and date = 'd'")
    text = plan(done)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(source_url,u1\)", text)
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = d", text)
    assert {r.cleaned_text[:5] for r in done.collect()} == {"Caf\u00e9."} and done.count() == 3
    # What does not read the text does not clean it.
    assert "ArrowEvalPython" not in plan(done.select("review_key"))


@pytest.mark.parametrize("merged", [merge.merge_sentiment, merge.merge_key_points, merge.merge_confidence])
def test_merging_moves_rows_once(spark, merged):
    rows = spark.createDataFrame(
        [(1, 0, "Mixed", 0.5, ["a"])],
        "review_key int, chunk_idx int, sentiment string, confidence double, key_points array<string>",
    )
    assert len(re.findall(r"Exchange hashpartitioning", plan(merged(rows)))) == 1


def test_tasks_deal_reviews_out(spark, many_splits):
    assert plan(analyzed(many_splits, offline_client, tasks=13)).count("Exchange") == 1


def test_report_reads_only_its_columns(spark, many_splits, tmp_path):
    path = str(tmp_path / "enriched")
    analyzed(many_splits, offline_client).write.parquet(path)
    stats = plan(report.report_stats(spark.read.parquet(path)))
    schema = re.search(r"ReadSchema: struct<(.*?)>", stats).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {
        "rating", "confidence", "token_count", "source_url",
    }
    # Partial sums are built before the shuffle.
    assert re.search(r"HashAggregate.*Exchange.*HashAggregate\(.*partial_avg", stats, re.S)


@pytest.mark.parametrize("name", [n for n in registered.QUERIES if n not in WRITING])
def test_no_cross_join_and_no_repeated_python(spark, name):
    text = plan(registered.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    names = re.findall(r"ArrowEvalPython \[(\w+)\(", text)
    assert len(names) == len(set(names)) <= 3


def test_spread_moves_only_small_scans(spark, many_splits):
    one = many_splits.coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert spread(one, "review_key").rdd.getNumPartitions() == 2 * cores
    wide = many_splits.repartition(cores)
    assert spread(wide, "review_key") is wide


def test_run_folder_is_on_the_named_storage(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first, second = run_folder(spark), run_folder(spark)
    assert first != second
    if before:
        assert first.startswith(before.rstrip("/"))
