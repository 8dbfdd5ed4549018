"""The whole run: pages to products, reviews, analysis, files and report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame

from reviewloom.functions.tokens import TokenCounter, word_tokens
from reviewloom.operators import report
from reviewloom.operators.asking import ask_chunks, chunk_prompts
from reviewloom.operators.chunks import MAX_TOKENS, preprocess_metrics, preprocess_reviews
from reviewloom.operators.completion import ClientFactory, CompletionSettings
from reviewloom.operators.generate import generate_reviews
from reviewloom.operators.merge import analyze_reviews, analyze_stored
from reviewloom.operators.pages import product_metadata
from reviewloom.sinks.documents import with_json_bytes, write_documents
from reviewloom.sinks.flat import export_rows, write_csv
from reviewloom.sources.tables import STORED_AS, committed, fetched


@dataclass
class Run:
    """Where a run wrote and, lazily, what it reports."""

    products_path: str
    enriched_path: str
    csv_path: str
    json_path: str
    report: dict[str, DataFrame] = field(repr=False)


def analyzed(
    reviews: DataFrame,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
    counter: TokenCounter = word_tokens,
    max_tokens: int = MAX_TOKENS,
    tasks: int | None = None,
) -> DataFrame:
    """Reviews to enriched reviews: one narrow stage, no shuffle.

    With a slow client the calls outweigh the data by far. ``tasks`` then deals
    the reviews out anew: the number of tasks running at once bounds the calls in
    flight, and a smaller task loses fewer answers with its executor.
    """
    if tasks is not None:
        reviews = reviews.repartition(tasks, "review_key")
    preprocessed = preprocess_reviews(reviews, counter, max_tokens)
    return analyze_reviews(preprocessed, client_factory, settings)


class Store:
    """The tables of a run under one folder, each written once.

    A run that begins finds none of them: an existing one is an error. One that goes on
    takes those that were written to their end, and writes the others anew.
    """

    def __init__(self, out_dir: str, run_id: str, resume: bool = False):
        self.base = f"{out_dir.rstrip('/')}/{run_id}"
        self.resume = resume
        # Whether what is written from now on has to be made anew.
        self.stale = False

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, table: DataFrame, name: str) -> DataFrame:
        path, spark = self.path(name), table.sparkSession
        if self.stale or not (self.resume and committed(spark, path)):
            mode = "overwrite" if self.resume else "errorifexists"
            table.write.mode(mode).options(**STORED_AS).parquet(path)
        return spark.read.parquet(path)

    def files(self, spark, name: str, done: str, write: Callable[[str], str]) -> str:
        """Files written by ``write``, complete where the folder ``done`` in them is."""
        path = self.path(name)
        if self.resume and not self.stale and committed(spark, f"{path}{done}"):
            return path
        return write(path)


def run_reviews(
    reviews: DataFrame,
    products: DataFrame,
    out_dir: str,
    run_id: str,
    generated_at: datetime,
    resume: bool = False,
    **options,
) -> Run:
    """Analyse a table of reviews and write everything under ``out_dir/run_id``.

    With ``rounds=n`` responses are a stored table that grows by n jobs, and a run that
    broke goes on with ``resume=True``: see ``Store`` and ``asking``. The chunks are then in
    the table ``preprocessed`` only, else in ``enriched``.
    """
    store = Store(out_dir, run_id, resume)
    return _run(reviews, store.keep(products, "products"), store, generated_at, **options)


def run_pages(
    pages: DataFrame,
    out_dir: str,
    run_id: str,
    scraped_at: datetime,
    url: str | None = None,
    resume: bool = False,
    **options,
) -> Run:
    """The run from pages: all of them, or the one with this address."""
    store = Store(out_dir, run_id, resume)
    # Stored first, so that each page is parsed once.
    stored = store.keep(product_metadata(fetched(pages, url), scraped_at), "products")
    return _run(generate_reviews(stored), stored, store, scraped_at, **options)


def _run(
    reviews: DataFrame,
    products: DataFrame,
    store: Store,
    generated_at: datetime,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
    counter: TokenCounter = word_tokens,
    max_tokens: int = MAX_TOKENS,
    tasks: int | None = None,
    rounds: int | None = None,
    ask_again: tuple[str, ...] = (),
) -> Run:
    if reviews.isEmpty():
        raise ValueError("no reviews to analyse")

    # Answers cost money and may differ when asked for again: they are asked for
    # once, and files and report are made from what was stored.
    if rounds is None:
        results = analyzed(reviews, client_factory, settings, counter, max_tokens, tasks)
    else:
        preprocessed = store.keep(preprocess_reviews(reviews, counter, max_tokens), "preprocessed")
        responses = ask_chunks(
            chunk_prompts(preprocessed), store.path("responses"), client_factory, settings,
            tasks or reviews.sparkSession.sparkContext.defaultParallelism, rounds, ask_again,
        )
        # The texts of the chunks stay where they are stored already.
        results = analyze_stored(preprocessed, responses).drop("chunks")
        store.stale = store.resume and bool(ask_again)
    enriched = store.keep(with_json_bytes(results), "enriched")
    spark = enriched.sparkSession
    csv_path = store.files(spark, "csv", "", lambda path: write_csv(export_rows(enriched), path, store.resume))
    json_path = store.files(
        spark, "json", "/pieces",
        lambda path: write_documents(enriched, products, path, generated_at, store.resume),
    )
    return Run(
        products_path=store.path("products"),
        enriched_path=store.path("enriched"),
        csv_path=csv_path,
        json_path=json_path,
        report={
            "header": report.report_header(products),
            "stats": report.report_stats(enriched),
            "sentiments": report.sentiment_breakdown(enriched, report.PER_PRODUCT),
            "samples": report.sample_summaries(enriched, report.PER_PRODUCT),
            "metrics": report.run_metrics(enriched),
            "preprocessing": preprocess_metrics(enriched),
        },
    )
