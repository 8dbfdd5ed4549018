"""Responses as a table that grows: prompts are asked in rounds and a broken run goes on.

A row of the table is an answered prompt: (review_key, chunk_idx) with the answer, the
attempts and the class of the last error. Each round is one job that appends what it
was told; what a round has written is never asked again. Within a round the prompts are
dealt to tasks by their length, chunk by chunk: a review of ten thousand chunks is the work
of all tasks, and its answers find their order again by ``chunk_idx``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.chunks import explode_chunks
from reviewloom.operators.completion import (
    ANSWER_TYPE,
    ClientFactory,
    CompletionSettings,
    ask_all,
)
from reviewloom.operators.prompts import build_prompt
from reviewloom.schemas import RESPONSE_FIELDS
from reviewloom.sources.tables import STORED_AS, exists

KEY = ("review_key", "chunk_idx")
# Portions per task and round of which weights are known, and portions in all.
PORTIONS_PER_TASK, MOST_PORTIONS = 16, 1 << 16
# Answers that are written at once where the client takes one prompt a call.
ANSWERS_AT_ONCE = 256


def chunk_prompts(preprocessed: DataFrame) -> DataFrame:
    """review_key, chunk_idx and prompt of every chunk that is not blank."""
    prompt = build_prompt(F.col("chunk"), F.col("rating"), F.col("author"))
    return explode_chunks(preprocessed).select(*KEY, prompt.alias("prompt"))


def read_responses(spark: SparkSession, path: str) -> DataFrame | None:
    """What has been answered, None before the first round."""
    return spark.read.parquet(path) if exists(spark, path) else None


def open_prompts(
    prompts: DataFrame, responses: DataFrame | None, ask_again: tuple[str, ...] = ()
) -> DataFrame:
    """Prompts without a stored response, or with failures only, of classes to ask again."""
    if responses is None:
        return prompts
    settled = F.col("error_class").isNull() | ~F.col("error_class").isin(*ask_again)
    return prompts.join(responses.where(settled).select(*KEY), list(KEY), "left_anti")


def portion(portions: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(portions)).cast("int")


def deal(weights: dict[int, int], bins: int) -> dict[int, int]:
    """Portions to bins, the heaviest first and each to the lightest bin so far."""
    heap = [(0, i) for i in range(bins)]
    found = {}
    for name in sorted(weights, key=lambda name: (-weights[name], name)):
        load, place = heapq.heappop(heap)
        found[name] = place
        heapq.heappush(heap, (load + weights[name], place))
    return found


def dealt(prompts: DataFrame, tasks: int, rounds: int) -> DataFrame:
    """Adds ``round`` and ``task``. The driver sees the weights of a bounded number of
    portions, not the prompts."""
    portions = max(tasks * rounds, min(tasks * rounds * PORTIONS_PER_TASK, MOST_PORTIONS))
    named = prompts.withColumn("portion", portion(portions))
    weights = named.groupBy("portion").agg(F.sum(F.length("prompt") + 1).alias("weight")).collect()
    places = deal({row.portion: row.weight for row in weights}, tasks * rounds)
    spark = prompts.sparkSession
    rows = [(name, place // tasks, place % tasks) for name, place in places.items()]
    table = spark.createDataFrame(rows, "portion int, round int, task int")
    # As many rows as portions, at most MOST_PORTIONS or one for each task of each round.
    return named.join(F.broadcast(table), "portion").drop("portion")


def _ask(client_factory: ClientFactory, settings: CompletionSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        size = settings.batch or ANSWERS_AT_ONCE
        for batch in batches:
            for first in range(0, len(batch), size):
                part = batch.slice(first, size)
                asked = (prompt.as_py() for prompt in part.column("prompt"))
                answers = pa.array(list(ask_all(client, asked, settings)), ANSWER_TYPE)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(name) for name in KEY], *answers.flatten()],
                    [*KEY, *[field.name for field in ANSWER_TYPE]],
                )

    return run


def ask_chunks(
    prompts: DataFrame,
    path: str,
    client_factory: ClientFactory,
    settings: CompletionSettings = CompletionSettings(),
    tasks: int | None = None,
    rounds: int = 1,
    ask_again: tuple[str, ...] = (),
    most_rounds: int | None = None,
) -> DataFrame:
    """All responses to ``prompts``, those stored at ``path`` and the ones still missing.

    The missing ones are asked in ``rounds`` jobs of ``tasks`` tasks, of which the first
    ``most_rounds`` are run, if it is given. A job that fails leaves what earlier ones have
    written; called again, only the rest is asked. Prompts whose failures are of a class
    in ``ask_again`` are asked once more, and their newest response counts. Without
    ``tasks`` there are as many as cores. Reads ``prompts`` twice: make them of a stored table.
    """
    spark = prompts.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    missing = open_prompts(prompts, read_responses(spark, path), ask_again)
    # One table of what is open, so that no round looks for it anew.
    waiting = f"{path}_open"
    turns = rounds if most_rounds is None else min(rounds, most_rounds)
    # What later calls deal anew is not stored now.
    placed = dealt(missing, tasks, rounds).where(F.col("round") < turns)
    placed.write.mode("overwrite").options(**STORED_AS).partitionBy("round").parquet(waiting)
    fields = [f"{name} {prompts.schema[name].dataType.simpleString()}" for name in KEY]
    schema = ", ".join([*fields, RESPONSE_FIELDS])
    held = spark.read.schema(f"{', '.join(fields)}, prompt string, task int, round int").parquet(waiting)
    spark.createDataFrame([], f"{schema}, asked_in int").write.mode("append").parquet(path)
    number = spark.read.parquet(path).agg(F.coalesce(F.max("asked_in"), F.lit(-1))).first()[0]
    for turn in range(turns):
        placed = held.where(F.col("round") == turn).repartitionById(tasks, F.col("task"))
        ordered = placed.sortWithinPartitions(*KEY).select(*KEY, "prompt")
        answers = ordered.mapInArrow(_ask(client_factory, settings), schema)
        told = answers.withColumn("asked_in", F.lit(number + 1 + turn))
        told.write.mode("append").options(**STORED_AS).parquet(path)
    return newest(spark.read.parquet(path))


def newest(responses: DataFrame) -> DataFrame:
    """One row per prompt: the answer, or of failures only the last one.

    An answered prompt is never asked again, so only failures are grouped.
    """
    told = F.col("error_class").isNull()
    answered = responses.where(told).drop("asked_in")
    fields = [name for name in answered.columns if name not in KEY]
    last = F.max_by(F.struct(*fields), "asked_in").alias("last")
    failed = responses.where(~told).groupBy(*KEY).agg(last).select(*KEY, "last.*")
    return answered.union(failed.join(answered.select(*KEY), list(KEY), "left_anti"))
