"""Quality rules as weak supervision: rules vote or abstain, and a model weighs them.

Each rule says good, bad or nothing about a text. Expectation-maximisation over the
counts of vote patterns estimates how often each rule is right about good and about
bad documents, with no label; a document is kept by its posterior probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import slices
from reviewloom.llm.text_signals import Signals, signals

KEEP_FROM = 0.5
EM_STEPS = 100
# Both accuracies are estimated. No rule is right or wrong always; of good documents it
# is right about half at least, which says which of the two sides is the good one. Of bad
# ones it may see one kind only and call all others good.
LEAST_ACCURACY, MOST_ACCURACY = {"good": 0.5, "bad": 0.001}, 0.999
PRIOR_WEIGHT = 10.0
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20

# Name, measure of a text with words, and up to where it is good and from where bad
# (or the other way round, where the first is larger). Between them a rule abstains.
RULES = (
    ("symbols per word", lambda s: s.n_symbols / s.n_words, 0.05, 0.3),
    ("symbols per character", lambda s: s.n_symbols / max(s.word_chars, 1), 0.02, 0.06),
    ("repeated lines", lambda s: s.n_dup_lines / max(s.n_lines, 1), 0.05, 0.5),
    ("repeated words", lambda s: s.n_repeat_words / s.n_words, 0.05, 0.2),
    ("most frequent word", lambda s: s.n_top / s.n_words if s.n_words >= 30 else 0.15, 0.12, 0.25),
    ("adjacent repeats", lambda s: s.n_adjacent / s.n_words, 0.02, 0.1),
    ("upper case", lambda s: s.n_upper / max(s.word_chars, 1), 0.1, 0.4),
    ("exclamations per word", lambda s: s.n_marks / s.n_words, 0.05, 0.3),
    ("word length", lambda s: abs(s.word_chars / s.n_words - 6.5), 3.0, 8.0),
)


class LabelModel(NamedTuple):
    """Chance that a rule says good of a good, and bad of a bad document."""

    prior: float
    right_good: np.ndarray
    right_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes (1 good, -1 bad, 0 nothing)."""
        good = np.full(len(votes), np.log(self.prior))
        bad = np.full(len(votes), np.log(1 - self.prior))
        for j in range(votes.shape[1]):
            up, down = votes[:, j] > 0, votes[:, j] < 0
            good += up * np.log(self.right_good[j]) + down * np.log(1 - self.right_good[j])
            bad += up * np.log(1 - self.right_bad[j]) + down * np.log(self.right_bad[j])
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def votes_of(s: Signals) -> list[int]:
    """One vote per rule; a text without words is not judged by them."""
    if not s.n_words:
        return [0] * len(RULES)
    found = []
    for _, measure, good, bad in RULES:
        value = measure(s)
        found.append(1 if value <= good else -1 if value >= bad else 0)
    return found


def estimate(votes: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    Without patterns the starting point is returned.
    """
    rules = votes.shape[1]
    model = LabelModel(0.9, np.full(rules, 0.99), np.full(rules, 0.5))
    if not counts.sum():
        return model
    for _ in range(EM_STEPS):
        good = model.posterior(votes) * counts
        bad = counts - good
        prior = float(np.clip((good.sum() + 0.9) / (counts.sum() + 1), 0.01, 0.99))
        right = []
        for weight, vote, start, least in (
            (good, 1, 0.99, LEAST_ACCURACY["good"]),
            (bad, -1, 0.5, LEAST_ACCURACY["bad"]),
        ):
            hits = (weight[:, None] * (votes == vote)).sum(0) + start * PRIOR_WEIGHT
            said = (weight[:, None] * (votes != 0)).sum(0) + PRIOR_WEIGHT
            right.append(np.clip(hits / said, least, MOST_ACCURACY))
        model = LabelModel(prior, *right)
    return model


def failed(s: Signals) -> bool:
    """What no vote can save: too few words, or too many in repeated windows."""
    return s.n_words < LEAST_WORDS or 100 * s.n_repeat_words > MOST_REPEAT_PERCENT * s.n_words


MEASURED = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, votes array<tinyint>"
)


def measure_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and votes of every row.

    A null text has no words. Rows are measured one by one; repeated rows and null or
    repeated ids stay as they are, and other columns are not read.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = [signals(text) for text in texts.to_pylist()]
            counts = np.array([s[:5] for s in found], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(counts[:, i]) for i in range(5)],
                    pa.array([failed(s) for s in found]),
                    pa.array([votes_of(s) for s in found], pa.list_(pa.int8())),
                ],
                [field.split()[0] for field in MEASURED.split(", ")],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return read.mapInArrow(run, MEASURED)


def fit_rules(measured: DataFrame) -> tuple[LabelModel, dict[tuple, float]]:
    """The model of all measured rows, and the posterior of every vote pattern.

    There are at most three to the number of rules patterns, whatever the input.
    """
    rows = measured.groupBy("votes").count().collect()
    votes = np.array([row.votes for row in rows], np.int64).reshape(len(rows), len(RULES))
    counts = np.array([row["count"] for row in rows], float)
    order = np.lexsort(votes.T)
    model = estimate(votes[order], counts[order])
    return model, {tuple(v): float(p) for v, p in zip(votes.tolist(), model.posterior(votes))}


def judge(measured: DataFrame, posteriors: dict[tuple, float]) -> DataFrame:
    """Adds quality_probability and kept to measured rows."""
    patterns = measured.sparkSession.createDataFrame(
        [(list(v), p) for v, p in posteriors.items()],
        "votes array<tinyint>, quality_probability double",
    )
    kept = ~F.col("base_failed") & (F.col("quality_probability") >= KEEP_FROM)
    return measured.join(F.broadcast(patterns), "votes").withColumn("kept", kept)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    model, _ = fit_rules(measure_documents(docs))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = [signals(text) for text in texts.to_pylist()]
            votes = np.array([votes_of(s) for s in found], np.int64)
            good = LabelModel(*shared.value).posterior(votes) >= KEEP_FROM
            yield batch.filter(pa.array(good & ~np.array([failed(s) for s in found])))

    return docs.mapInArrow(run, docs.schema)
