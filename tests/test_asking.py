"""Responses that are stored in rounds, taken up again and dealt over tasks."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from checks.offline_client import canned_answer, offline_client, reviewed_text
from reviewloom.operators import asking
from reviewloom.operators.completion import CompletionSettings
from reviewloom.operators.merge import analyze_reviews, analyze_stored
from reviewloom.plans.workflow import run_reviews
from test_output import WHEN, product_rows

REVIEW = "review_key int, review_id string, product_title string, author string, rating int, date string, review_text string, source_url string"


def prompt_rows(spark, n, words=3):
    rows = [(i // 10, i % 10, f"prompt {i}" + " word" * (i % words)) for i in range(n)]
    return spark.createDataFrame(rows, "review_key int, chunk_idx int, prompt string")


def noting(folder, broken=None):
    """A client that notes what it is asked, and dies at some prompts while ``broken`` exists."""

    def factory():
        def client(prompt, temperature, max_tokens):
            if broken and os.path.exists(broken) and int(prompt.split()[1]) % 3 == 1:
                raise SystemExit("the task is gone")
            with open(os.path.join(folder, str(os.getpid())), "a") as file:
                file.write(prompt + "\n")
            return prompt.upper()

        return client

    return factory


def noted(folder):
    return collections.Counter(
        line.strip() for name in os.listdir(folder) for line in open(os.path.join(folder, name))
    )


def told(responses):
    return {(r.review_key, r.chunk_idx): r.raw_response for r in responses.collect()}


def test_a_run_that_is_cut_off_asks_each_prompt_once(spark, tmp_path):
    folder = tmp_path / "noted"
    folder.mkdir()
    prompts, path = prompt_rows(spark, 60), str(tmp_path / "responses")
    first = asking.ask_chunks(prompts, path, noting(folder), tasks=3, rounds=4, most_rounds=2)
    some = told(first)
    assert 0 < len(some) < 60 and sum(noted(folder).values()) == len(some)
    rest = asking.ask_chunks(prompts, path, noting(folder), tasks=2, rounds=3)
    assert len(told(rest)) == 60 and told(rest).items() >= some.items()
    assert noted(folder) == collections.Counter(r.prompt for r in prompts.collect())
    # Nothing is open any more.
    asking.ask_chunks(prompts, path, noting(folder), tasks=2, rounds=2)
    assert sum(noted(folder).values()) == 60 and told(asking.newest(spark.read.parquet(path))) == told(rest)


def test_a_task_that_dies_costs_its_round_only(spark, tmp_path):
    folder, broken = tmp_path / "noted", tmp_path / "broken"
    folder.mkdir()
    # Rounds of one task; those before the first prompt that kills stand.
    prompts, path = prompt_rows(spark, 30, words=1), str(tmp_path / "responses")
    good = prompts.where("cast(split(prompt, ' ')[1] as int) % 3 != 1")
    asking.ask_chunks(good, path, noting(folder), tasks=2, rounds=2)
    broken.touch()
    with pytest.raises(Exception):
        asking.ask_chunks(prompts, path, noting(folder, str(broken)), tasks=1, rounds=2)
    assert sum(noted(folder).values()) == 20
    broken.unlink()
    done = asking.ask_chunks(prompts, path, noting(folder, str(broken)), tasks=1, rounds=2)
    assert len(told(done)) == 30 and set(noted(folder).values()) == {1}


def test_failures_are_kept_and_asked_again_on_request(spark, tmp_path):
    def failing():
        def client(prompt, temperature, max_tokens):
            if prompt.endswith("7"):
                raise RuntimeError("429")
            if prompt.endswith("8"):
                raise RuntimeError("401")
            return None if prompt.endswith("9") else "fine"

        return client

    folder = tmp_path / "noted"
    folder.mkdir()
    prompts, path = prompt_rows(spark, 10, words=1), str(tmp_path / "responses")
    quick = CompletionSettings(attempts=2, sleep=lambda seconds: None)
    rows = {r.chunk_idx: r for r in asking.ask_chunks(prompts, path, failing, quick, tasks=2).collect()}
    assert len(rows) == 10 and (rows[7].attempts, rows[7].error_class, rows[7].waited) == (2, "rate_limit", 6)
    assert (rows[8].attempts, rows[8].error_class) == (1, "auth") and rows[9].error_class is None
    again = asking.ask_chunks(prompts, path, noting(folder), quick, tasks=2, ask_again=("rate_limit",))
    rows = {r.chunk_idx: r for r in again.collect()}
    assert len(rows) == 10 and rows[7].raw_response == "PROMPT 7" and rows[8].error_class == "auth"
    assert noted(folder) == {"prompt 7": 1}


def test_a_giant_review_is_the_work_of_all_tasks(spark, tmp_path):
    rows = spark.range(10_000).select(
        F.lit(1).alias("review_key"), F.col("id").cast("int").alias("chunk_idx"),
        F.concat(F.lit("p "), F.repeat(F.lit("x"), (F.col("id") % 400).cast("int"))).alias("prompt"),
    )
    placed = asking.dealt(rows, 8, 1).groupBy("task").agg(F.sum(F.length("prompt")).alias("n")).collect()
    sizes = [r.n for r in placed]
    assert len(sizes) == 8 and max(sizes) < 1.1 * min(sizes)

    def factory():
        from pyspark import TaskContext

        return lambda prompt, temperature, max_tokens: f"{TaskContext.get().partitionId()} {len(prompt)}"

    done = asking.ask_chunks(rows, str(tmp_path / "r"), factory, tasks=8)
    found = done.orderBy("chunk_idx").collect()
    assert [int(r.raw_response.split()[1]) for r in found] == [2 + i % 400 for i in range(10_000)]
    assert {r.raw_response.split()[0] for r in found} == {str(i) for i in range(8)}


def test_portions_are_dealt_evenly():
    weights = {i: 1 + i % 7 for i in range(100)} | {200: 60}
    loads = collections.Counter()
    for name, place in asking.deal(weights, 5).items():
        loads[place] += weights[name]
    assert sorted(loads) == [0, 1, 2, 3, 4] and max(loads.values()) - min(loads.values()) <= 7


def reviews(spark):
    text = "Fine words here, and more of them. " * 120
    rows = [(i, str(i), "t", "a", 3, "d", text + f"End {i}." if i % 2 else "Short.", "u") for i in range(6)]
    return spark.createDataFrame([*rows, (9, "9", "t", None, None, "d", "", "u")], REVIEW)


def test_stored_and_direct_results_agree(spark, tmp_path):
    from reviewloom.operators.chunks import preprocess_reviews

    preprocessed = preprocess_reviews(reviews(spark))
    responses = asking.ask_chunks(asking.chunk_prompts(preprocessed), str(tmp_path / "r"), offline_client)
    stored = analyze_stored(preprocessed, responses)
    direct = analyze_reviews(preprocessed, offline_client)
    assert sorted(stored.columns) == sorted(direct.columns)
    columns = direct.columns
    assert sorted(map(repr, stored.select(columns).collect())) == sorted(map(repr, direct.collect()))
    chunked = {r.review_key: r.chunks for r in preprocessed.collect()}
    assert max(map(len, chunked.values())) > 2
    for r in responses.collect():
        assert r.raw_response == canned_answer(chunked[r.review_key][r.chunk_idx])


def test_reviews_without_chunks_count_one(spark):
    rows = spark.createDataFrame(
        [(1, None, "some text", 4, "A"), (2, ["x", "y"], "x y", 4, "A")],
        "review_key int, chunks array<string>, cleaned_text string, rating int, author string",
    )

    def factory():
        return lambda prompt, temperature, max_tokens: f"SUMMARY: {reviewed_text(prompt)}"

    found = {r.review_key: r for r in analyze_reviews(rows, factory).collect()}
    assert (found[1].chunks_analyzed, found[1].llm_summary) == (1, "some text")
    assert (found[2].chunks_analyzed, found[2].llm_summary) == (2, "x")


def test_a_broken_run_goes_on(spark, tmp_path):
    folder, broken = tmp_path / "noted", tmp_path / "broken"
    folder.mkdir()

    def factory():
        def client(prompt, temperature, max_tokens):
            if broken.exists() and "End 5." in prompt:
                raise SystemExit("the task is gone")
            with open(folder / str(os.getpid()), "a") as file:
                file.write(f"{len(prompt)}\n")
            return canned_answer(reviewed_text(prompt))

        return client

    arguments = (reviews(spark), product_rows(spark), str(tmp_path / "out"), "run", WHEN)
    broken.touch()
    with pytest.raises(Exception):
        run_reviews(*arguments, client_factory=factory, rounds=8, tasks=1)
    before = sum(noted(folder).values())
    broken.unlink()
    with pytest.raises(Exception, match="exist"):
        run_reviews(*arguments, client_factory=factory, rounds=2, tasks=1)
    run = run_reviews(*arguments, client_factory=factory, rounds=2, tasks=1, resume=True)
    enriched = spark.read.parquet(run.enriched_path)
    chunks = enriched.where("cleaned_text != ''").agg(F.sum("chunk_count")).first()[0]
    # At most the round that broke is asked twice, and it broke within one of eight parts.
    assert chunks <= sum(noted(folder).values()) <= chunks + chunks // 4 and before < chunks
    assert enriched.count() == 7 and spark.read.parquet(f"{run.json_path}/index").count() == 1
    # Complete: nothing is asked or written again.
    asked = sum(noted(folder).values())
    run_reviews(*arguments, client_factory=factory, rounds=2, tasks=1, resume=True)
    assert sum(noted(folder).values()) == asked


def test_without_tasks_all_cores_ask(spark, tmp_path):
    def factory():
        from pyspark import TaskContext

        return lambda prompt, temperature, max_tokens: str(TaskContext.get().partitionId())

    done = asking.ask_chunks(prompt_rows(spark, 400), str(tmp_path / "r"), factory)
    cores = spark.sparkContext.defaultParallelism
    assert {r.raw_response for r in done.collect()} == {str(i) for i in range(cores)}


def test_prompts_of_the_query_are_made_of_a_stored_table(spark, monkeypatch):
    from checks import queries as registered

    plans, made = [], asking.chunk_prompts

    def chunk_prompts(preprocessed):
        plans.append(preprocessed._jdf.queryExecution().executedPlan().toString())
        return made(preprocessed)

    monkeypatch.setattr(asking, "chunk_prompts", chunk_prompts)
    registered.stored_responses(spark, "/root/testdata/sf0.001")
    assert plans and not any("ArrowEvalPython" in text for text in plans)


def test_only_rounds_that_are_run_are_stored(spark, tmp_path):
    def factory():
        return lambda prompt, temperature, max_tokens: prompt

    path = str(tmp_path / "responses")
    asking.ask_chunks(prompt_rows(spark, 90), path, factory, tasks=2, rounds=3, most_rounds=1)
    waiting = spark.read.parquet(f"{path}_open")
    assert {r["round"] for r in waiting.select("round").distinct().collect()} == {0}
    assert waiting.count() == spark.read.parquet(path).count() < 90


def test_chunks_of_a_run_in_rounds_are_stored_once(spark, tmp_path):
    run = run_reviews(
        reviews(spark), product_rows(spark), str(tmp_path / "out"), "run", WHEN, rounds=1, client_factory=offline_client
    )
    enriched = spark.read.parquet(run.enriched_path)
    stored = spark.read.parquet(f"{tmp_path}/out/run/preprocessed")
    assert "chunks" not in enriched.columns
    sizes = {r.review_key: len(r.chunks) for r in stored.collect()}
    assert {r.review_key: r.chunks_analyzed for r in enriched.collect()} == sizes
