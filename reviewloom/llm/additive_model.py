"""A generalised additive model with pairwise interactions, as a quality classifier.

Every feature has a lookup table over its bins, and so have a few pairs of
features. Tables are learnt by boosting shallow trees on one feature at a time, in
cycles; a score is the sum of looked-up values, added for all rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import slices
from reviewloom.llm.text_signals import Signals, signals

# The model is fitted on about so many labelled rows at most, drawn by hash.
TRAINING_ROWS = 20_000
BINS = 48
PAIR_BINS = 12
CYCLES = 120
PAIRS = 8
RATE = 0.1
LEAVES = 4
SMOOTHING = 2.0
THRESHOLD = 0.7


def feature_names() -> list[str]:
    return [
        "log_words", "word_length", "distinct", "top", "adjacent", "repeat", "dup_lines",
        "upper", "symbols", "marks", "bars", "digits", "stops", "capital", "longest", "line_words",
    ]


def features(s: Signals) -> list[float]:
    """Shares of counts; 0 for a text without words."""
    n, chars, lines = max(s.n_words, 1), max(s.word_chars, 1), max(s.n_lines, 1)
    return [
        np.log1p(s.n_words), s.word_chars / n, s.n_distinct / n, s.n_top / n, s.n_adjacent / n,
        s.n_repeat_words / n, s.n_dup_lines / lines, s.n_upper / chars, s.n_symbols / chars,
        s.n_marks / chars, s.n_bars / chars, s.n_digits / chars, s.n_stops / n, s.n_capital / n,
        s.longest, s.n_words / lines,
    ]


class Model(NamedTuple):
    """Bin edges and tables of features, and for pairs their coarser edges and tables."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(rows), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            first = np.searchsorted(self.pair_edges[i], rows[:, i], "right")
            second = np.searchsorted(self.pair_edges[j], rows[:, j], "right")
            total += table[first, second]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Quantiles, and a cut above the smallest value, which many rows may share."""
    cuts = np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])
    least = values[values > values.min()]
    return np.unique(np.append(cuts, least.min() if len(least) else cuts))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTHING)


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree of at most LEAVES leaves on sums of gradients."""
    leaves = [(0, len(g))]
    sums_g, sums_h = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))

    def best(leaf: tuple[int, int]) -> tuple[float, int]:
        a, b = leaf
        if b - a < 2:
            return 0.0, a
        cuts = np.arange(a + 1, b)
        left_g, left_h = sums_g[cuts] - sums_g[a], sums_h[cuts] - sums_h[a]
        all_g, all_h = sums_g[b] - sums_g[a], sums_h[b] - sums_h[a]
        gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
        place = int(np.argmax(gains))
        return float(gains[place] - _gain(all_g, all_h)), int(cuts[place])

    while len(leaves) < LEAVES:
        (gain, cut), leaf = max((best(leaf), leaf) for leaf in leaves)
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], cut), (cut, leaf[1])]
    values = np.zeros(len(g))
    for a, b in leaves:
        values[a:b] = (sums_g[b] - sums_g[a]) / (sums_h[b] - sums_h[a] + SMOOTHING)
    return values


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid of sums into four by one cut per side: gain and values."""

    def corners(m: np.ndarray) -> list[np.ndarray]:
        c = m.cumsum(0).cumsum(1)
        a = c[:-1, :-1]
        low, right = c[-1:, :-1] - a, c[:-1, -1:] - a
        return [a, right, low, c[-1, -1] - a - low - right]

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gs, hs = corners(g), corners(h)
    gains = sum(_gain(x, y) for x, y in zip(gs, hs)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.zeros(g.shape)
    v = [x[i, j] / (y[i, j] + SMOOTHING) for x, y in zip(gs, hs)]
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :] = v[0], v[1]
    values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = v[2], v[3]
    return float(gains[i, j]), values


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost all features in cycles, then the pairs with the largest gain.

    Without rows, or with one label only, scores are constant.
    """
    width = len(feature_names())
    if len(labels) == 0:
        rows, labels = np.zeros((1, width)), np.full(1, 0.5)
    mean = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(mean / (1 - mean)))
    edges = [_edges(rows[:, j], BINS) for j in range(width)]
    pair_edges = [_edges(rows[:, j], PAIR_BINS) for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if labels.min() == labels.max():
        return Model(base, edges, tables, pair_edges, [], [])
    bins = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(edges)]
    coarse = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(pair_edges)]
    total = np.full(len(labels), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(CYCLES):
        for j, table in enumerate(tables):
            g, h = slopes()
            n = len(table)
            step = RATE * shallow_tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            table += step
            total += step[bins[j]]

    def grid(i: int, j: int, g: np.ndarray, h: np.ndarray):
        shape = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        code = coarse[i] * shape[1] + coarse[j]
        size = shape[0] * shape[1]
        return np.bincount(code, g, size).reshape(shape), np.bincount(code, h, size).reshape(shape)

    g, h = slopes()
    gains = {(i, j): quadrants(*grid(i, j, g, h))[0] for i, j in combinations(range(width), 2)}
    pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(CYCLES // 2):
        for (i, j), table in zip(pairs, pair_tables):
            step = RATE * quadrants(*grid(i, j, *slopes()))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(base, edges, tables, pair_edges, pairs, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a null id is not held out."""
    return F.coalesce(
        F.crc32(doc_id.cast("bigint").cast("string").cast("binary")) % 4 == 2, F.lit(False)
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fit on about ``rows`` labelled documents that are not held out.

    A sample by the hash of doc_id is taken of both tables before they meet. Null
    labels are left out; a document with several labels counts once for each.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    total = known.count()
    share = (1 << 30) * rows // max(total, rows)
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(1 << 30)) < share

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = [features(signals(text)) for text in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "features"],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    measured = read.where(drawn & ~held_out(F.col("doc_id"))).mapInArrow(
        measure, "doc_id bigint, features array<double>"
    )
    joined = measured.join(known.where(drawn).select("doc_id", "quality"), "doc_id")
    # In one order, so that sums of floating-point numbers come out alike.
    found = joined.orderBy("doc_id", "quality").select("features", "quality").collect()
    table = np.array([row.features for row in found], float)
    table = table.reshape(len(found), len(feature_names()))
    return fit(table, np.array([row.quality for row in found], float))


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    return model.score(np.array([features(signals(x)) for x in texts.to_pylist()], float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row with columns doc_id and text.

    A null text is scored as the empty one. Repeated rows and null or repeated ids
    are scored row by row; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_scores(Model(*shared.value), texts))],
                ["doc_id", "score"],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return read.mapInArrow(run, "doc_id bigint, score double")


def accepted_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of which the text scores ``threshold`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield batch.filter(pc.greater_equal(pa.array(_scores(Model(*shared.value), texts)), threshold))

    return docs.mapInArrow(run, docs.schema)
