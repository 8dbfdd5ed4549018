import csv
import io
import json
import os
import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import report
from reviewloom.plans.workflow import run_pages, run_reviews
from reviewloom.schemas import EXPORT_COLUMNS
from checks.offline_client import offline_client
from reviewloom.sinks.documents import PIECE_ORDER, misplaced_pieces, write_documents
from reviewloom.sinks.flat import export_rows, read_csv, write_csv

WHEN = datetime(2024, 5, 20, 14, 32, 1)
ODD_TEXTS = [
    'quote " and ""two""', "comma, semi;", "line\nbreak", "carriage\r\nreturn", "\r", " padded ",
    "\ttab\t", "back\\slash", 'end\\"', "'", "\u00E9\u6F22\U0001f600", "=1+1", "#hash", '"', "\\", "\\N",
]


def enriched_rows(spark, rows):
    """(review_key, source_url, text, sentiment, confidence, rating) to enriched rows."""
    return spark.createDataFrame(
        rows,
        "review_key long, source_url string, review_text string, sentiment string, "
        "confidence double, rating int",
    ).withColumns(
        {
            "review_id": F.lit("id"),
            "product_title": F.concat(F.lit("title of "), "source_url"),
            "author": F.when(F.col("review_key") % 2 == 0, "Ann"),
            "date": F.lit("2024-01-01"),
            "cleaned_text": F.col("review_text"),
            "token_count": F.length("review_text"),
            "chunks": F.array("review_text"),
            "chunk_count": F.lit(2),
            "key_points": F.array(F.lit("a"), F.lit("b")),
            "key_points_str": F.lit("a | b"),
            "llm_summary": F.lit("s"),
            "raw_llm_response": F.lit("SENTIMENT: x\nSUMMARY: s"),
            "chunks_analyzed": F.lit(2),
        }
    )


def product_rows(spark, *urls):
    return spark.createDataFrame(
        [(f"title of {u}", 3, "\u00A31", "N/A", "d", {"upc": "1", "price": "\u00A39"}, u, WHEN)
         for u in urls],
        "product_title string, overall_rating int, price string, availability string, "
        "description string, specs map<string,string>, scraped_url string, scraped_at timestamp",
    )


def test_export_defaults(spark):
    bare = spark.createDataFrame([("r", None)], "review_id string, author string")
    row = export_rows(bare).first().asDict()
    assert tuple(row) == EXPORT_COLUMNS
    assert row["chunk_count"] == 1 and row["author"] == "" and row["sentiment"] == ""
    assert row["rating"] is None and row["confidence"] is None


def test_csv_bytes_and_round_trip(spark, tmp_path):
    rows = [(i, "u", t, "Mixed", 0.5, None) for i, t in enumerate(ODD_TEXTS)]
    export = export_rows(enriched_rows(spark, rows)).coalesce(1)
    path = write_csv(export, str(tmp_path / "csv"))
    content = next(Path(path).glob("part-*")).read_bytes().decode("utf-8")
    assert content.startswith("\uFEFFreview_id,product_title,")
    # Another reader of the format sees the same texts.
    listed = list(csv.DictReader(io.StringIO(content.removeprefix("\uFEFF"), newline="")))
    assert sorted(r["original_review"] for r in listed) == sorted(ODD_TEXTS)
    assert {r["rating"] for r in listed} == {""} and {r["confidence"] for r in listed} == {"0.5"}

    back = read_csv(spark, path).collect()
    assert sorted(r.original_review for r in back) == sorted(ODD_TEXTS)
    assert {r.author for r in back} == {"Ann", None}
    with pytest.raises(Exception, match="exist"):
        write_csv(export, path)


def documents(spark, path):
    """All documents of a written folder, by address."""
    texts = {}
    for row in spark.read.parquet(f"{path}/pieces").orderBy(*PIECE_ORDER).collect():
        texts.setdefault(row.source_url, ([], [], []))[row.section].append(row.value)
    return {
        url: json.loads(opening[0] + ",".join(bodies) + closing[0])
        for url, (opening, bodies, closing) in texts.items()
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """One product with far more reviews than the other twenty together."""
    rows = [(i, "http://hot/?a=1", ODD_TEXTS[i % len(ODD_TEXTS)], "Mixed", None, 3)
            for i in range(2000)]
    rows += [(5000 + i, f"http://cold/{i % 20}", "t", "Positive", 0.25, None) for i in range(60)]
    return enriched_rows(spark, rows)


@pytest.mark.parametrize("part_bytes", [2**27, 100_000])
def test_documents(spark, skewed, tmp_path, part_bytes, monkeypatch):
    monkeypatch.setattr("reviewloom.sinks.documents.PART_BYTES", part_bytes)
    urls = ["http://hot/?a=1", *[f"http://cold/{i}" for i in range(20)]]
    path = str(tmp_path / "json")
    # A page listed twice does not double anything.
    products = product_rows(spark, *urls, urls[3])
    write_documents(skewed, products, path, WHEN)
    found = documents(spark, path)
    assert set(found) == set(urls)
    hot = found["http://hot/?a=1"]
    assert hot["total_reviews"] == len(hot["reviews"]) == 2000
    assert [r["review_text"] for r in hot["reviews"]] == [
        ODD_TEXTS[i % len(ODD_TEXTS)] for i in range(2000)
    ]
    assert hot["generated_at"] == "2024-05-20T14:32:01.000000"
    # Spec rows stand beside the page's fields, which they have replaced before.
    assert list(hot["product_metadata"].items()) == [
        ("product_title", "title of http://hot/?a=1"), ("overall_rating", 3), ("price", "\u00A31"),
        ("availability", "N/A"), ("description", "d"), ("upc", "1"),
        ("scraped_url", "http://hot/?a=1"), ("scraped_at", "2024-05-20T14:32:01.000000"),
    ]
    review = found["http://cold/4"]["reviews"][0]
    assert "chunks" not in review and "review_key" not in review
    assert review["key_points"] == ["a", "b"] and review["rating"] is None
    if part_bytes < 2**27:
        # The large document was written by several tasks.
        hot = spark.read.parquet(f"{path}/pieces").where("source_url like '%hot%'")
        assert hot.select("_metadata.file_name").distinct().count() > 3


def test_documents_without_address(spark, tmp_path):
    rows = [(1, None, "a", "Mixed", None, 3), (2, None, "b", "Mixed", None, 3), (3, "u", "c", None, None, 1)]
    path = str(tmp_path / "json")
    write_documents(enriched_rows(spark, rows), product_rows(spark, "u"), path, WHEN)
    found = documents(spark, path)
    assert found[""]["total_reviews"] == 2 == len(found[""]["reviews"])
    assert found[""]["product_metadata"] == {} and len(found["u"]["reviews"]) == 1


def test_index_lists_all(spark, skewed, tmp_path):
    path = str(tmp_path / "json")
    write_documents(skewed, product_rows(spark, "http://hot/?a=1"), path, WHEN)
    index = {r.source_url: r for r in spark.read.parquet(f"{path}/index").collect()}
    assert len(index) == 21 and index["http://hot/?a=1"].total_reviews == 2000
    assert index["http://cold/1"].metadata is None


def test_report(spark):
    rows = [
        (1, "u", "aa", "Positive", 0.9, 5),
        (2, "u", "bbbb", "Negative", None, None),
        (3, "v", "c", "Negative", 0.4, 2),
        (4, "v", "d", None, None, None),
        (5, "v", "e", "Unknown", None, None),
        (6, "w", "f", "a label of some length", None, None),
    ]
    enriched = enriched_rows(spark, rows)
    stats = {r.source_url: r.asDict() for r in report.report_stats(enriched).collect()}
    assert stats["u"] == {
        "source_url": "u", "total_reviews": 2, "avg_rating": 5.0, "avg_confidence": 0.9,
        "avg_tokens": 3.0,
    }
    assert stats["w"]["avg_rating"] is None and stats["w"]["avg_confidence"] is None
    assert report.report_stats(enriched, ()).first().total_reviews == 6

    breakdown = [tuple(r) for r in report.sentiment_breakdown(enriched).collect()]
    assert breakdown == [
        ("Negative", 2, "Negative  ", "\u2588\u2588"),
        ("Positive", 1, "Positive  ", "\u2588"),
        ("Unknown", 1, "Unknown   ", "\u2588"),
        ("a label of some length", 1, "a label of some length", "\u2588"),
    ]
    samples = [tuple(r) for r in report.sample_summaries(enriched).collect()]
    assert [s[0] for s in samples] == [1, 2, 3] and samples[0][1:] == (None, 5, "Positive", "s")
    per_product = report.sample_summaries(enriched, ("source_url",), size=2).collect()
    assert sorted(r.review_key for r in per_product) == [1, 2, 3, 4, 6]
    metrics = {r.source_url: r for r in report.run_metrics(enriched).collect()}
    assert (metrics["v"].reviews, metrics["v"].total_chunks, metrics["v"].successful) == (3, 6, 1)
    overview = {r.source_url: r for r in report.source_overview(enriched).collect()}
    assert overview["v"].top_sentiment == "Negative" and overview["v"].avg_tokens == 1.0
    assert overview["u"].top_sentiment == "Positive" and overview["u"].avg_rating == 5.0
    header = report.report_header(product_rows(spark, "u").withColumn("price", F.lit(None)))
    assert header.first().price == "N/A" and header.first().overall_rating == "3"


def test_run_from_pages(spark, tmp_path):
    pages = spark.createDataFrame(
        [
            ("http://x/1", "<h1>One</h1><p class='star-rating Four'></p>"),
            ("http://x/2", "<h1>Two</h1>"),
            ("http://x/3", None),
        ],
        "url string, html string",
    )
    run = run_pages(pages, str(tmp_path), "first", WHEN, client_factory=offline_client)
    assert spark.read.parquet(run.enriched_path).count() == 14
    assert read_csv(spark, run.csv_path).count() == 14
    found = documents(spark, run.json_path)
    assert {url: d["total_reviews"] for url, d in found.items()} == {
        "http://x/1": 7,
        "http://x/2": 7,
    }
    authors = [r["author"] for r in found["http://x/1"]["reviews"]]
    assert authors[0] == "Alice M." and authors[6] == "Sara N."
    sizes = {name: frame.count() for name, frame in run.report.items()}
    assert sizes["header"] == sizes["stats"] == sizes["metrics"] == 2
    assert sizes["samples"] == 6 and sizes["preprocessing"] == 1
    # A second run under the same name is an error, not an overwrite.
    with pytest.raises(Exception, match="exist"):
        run_pages(pages, str(tmp_path), "first", WHEN, client_factory=offline_client)
    one = run_pages(pages, str(tmp_path), "second", WHEN, client_factory=offline_client, url="http://x/2")
    assert list(documents(spark, one.json_path)) == ["http://x/2"]


def test_nothing_to_do_is_an_error(spark, tmp_path):
    reviews = enriched_rows(spark, []).select(
        "review_key", "review_id", "product_title", "author", "rating", "date", "review_text",
        "source_url",
    )
    with pytest.raises(ValueError, match="no reviews"):
        run_reviews(reviews, product_rows(spark), str(tmp_path), "none", WHEN, client_factory=offline_client)


def test_records_of_one_line_are_read_in_parts(spark, tmp_path):
    texts = ["plain", 'q"uo,ted', "two\nlines", "\r\n", "back\\slash", "\\n no line end", "\\\\n", "\\\n\\", "\\", "é x", " s "]
    texts += [c + d + e for c in "\\\nnr" for d in "\\\rnr" for e in "\\\n\rnx"]
    rows = [(str(i), texts[i % len(texts)], i) for i in range(3000)]
    table = spark.createDataFrame(rows, "review_id string, cleaned_text string, token_count int")
    path = write_csv(export_rows(table).coalesce(1), str(tmp_path / "lines"), splittable=True)
    assert len([name for name in os.listdir(path) if name.endswith(".csv")]) == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3_000)
    try:
        found = read_csv(spark, path, splittable=True)
        assert found.rdd.getNumPartitions() > 10
        assert {(r.review_id, r.cleaned_review, r.token_count) for r in found.collect()} == set(rows)
        assert found.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # A record is a line, for any reader.
    (name,) = (name for name in os.listdir(path) if name.endswith(".csv"))
    with open(f"{path}/{name}", newline="") as file:
        assert file.read().count("\n") == len(rows) + 1


def test_misplaced_pieces_are_found(spark, tmp_path):
    rows = [("u", 0, None, "{"), ("u", 1, 1, "a"), ("u", 1, 2, "b"), ("u", 2, None, "}"), ("v", 0, None, "{")]

    def misplaced(*files):
        path = str(tmp_path / str(len(os.listdir(tmp_path))))
        for i, part in enumerate(files):
            table = spark.createDataFrame(part, "source_url string, section int, review_key int, value string")
            table.coalesce(1).write.parquet(f"{path}/tmp{i}")
            os.makedirs(f"{path}/pieces", exist_ok=True)
            (name,) = (n for n in os.listdir(f"{path}/tmp{i}") if n.endswith(".parquet"))
            shutil.copy(f"{path}/tmp{i}/{name}", f"{path}/pieces/part-{i:05}.parquet")
        return {r.source_url: r.misplaced for r in misplaced_pieces(spark, path).collect()}

    assert misplaced(rows) == misplaced(rows[:2], rows[2:]) == {}
    assert misplaced([rows[0], rows[2], rows[1], *rows[3:]]) == {"u": 1}
    assert misplaced(rows[2:], rows[:2]) == {"u": 1}
    assert misplaced(rows[:2], [rows[3], rows[2]], rows[4:]) == {"u": 1}


def test_a_bar_for_every_count(spark):
    rows = [(i, "u", "a", "Positive" if i < 90 else "Mixed", None, None) for i in range(95)]
    enriched = enriched_rows(spark, rows)
    bars = {r.sentiment: len(r.bar) for r in report.sentiment_breakdown(enriched).collect()}
    assert bars == {"Positive": 90, "Mixed": 5}
    tens = report.sentiment_breakdown(enriched, reviews_per_mark=10).collect()
    assert {r.sentiment: len(r.bar) for r in tens} == {"Positive": 9, "Mixed": 1}


def test_ratings_of_generated_reviews(spark):
    from reviewloom.operators.generate import generate_reviews

    wanted = {
        0: [0, 1, 5, 1, 0, 5, 2], 1: [1, 1, 5, 1, 1, 5, 2], 3: [3, 2, 5, 1, 3, 5, 2], 4: [4, 3, 5, 2, 4, 5, 3],
        5: [5, 4, 5, 3, 5, 5, 4], 7: [5, 6, 5, 5, 7, 5, 6], None: [None] * 7,
    }
    products = spark.createDataFrame(
        [("t", n, "d" * 200, f"u{n}") for n in wanted],
        "product_title string, overall_rating int, description string, scraped_url string",
    )
    found = {n: [None] * 7 for n in wanted}
    for r in generate_reviews(products).collect():
        name, place = r.review_key.split("#")
        found[None if name == "uNone" else int(name[1:])][int(place)] = r.rating
    assert found == wanted
