"""Exact top-k inner products, a block of vectors at a time.

Vectors are ordered by their nearest of a few pivots and then by id; runs of that
order hold blocks, and each run and each block know the largest and smallest value of
every component. A query first meets only the extremes of the runs, which are a few
thousandths of the vectors. It is sent to the run of the highest bound, whose scores
raise its k-th score, and then to those other runs alone whose bounds reach that.
Within a run, blocks are taken in the order of the largest score they could hold, and
scored from their rows until no block's bound reaches the k-th score found. Bounds only
save work: no vector that could be among the k is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.tables import Workspace, hash_sample

# Vectors of a block, and of a run of blocks that one task holds at a time.
BLOCK = 256
RUN = 8192
# Queries that meet a run, or a slab of extremes, at a time (expected number).
QUERIES_AT_ONCE = 1024
# Runs of which the extremes make up a slab (expected number).
SLAB = 512
# Portions of queries that meet the same copy of a run or a slab; a run that more
# queries go to is copied, so that it is the work of more than one task.
PORTIONS = 16
# Vectors of the sample that gives pivots and a first bound for every query's k-th
# score; the sample bounds what is broadcast, not what is searched.
SAMPLE = 512
PIVOTS = 32

RUNS = (
    "run bigint, width int, high array<bigint>, low array<bigint>, "
    "ids binary, rows binary, highs binary, lows binary"
)
ASKED = "query bigint, query_id bigint, reached bigint, vector array<bigint>"
LIMITS = "query bigint, run bigint, bound bigint"
HITS = "query bigint, query_id bigint, vec_id bigint, score bigint"
# Scores lie above NONE, which can be negated, and up to MOST.
MOST = np.iinfo(np.int64).max
NONE = -MOST


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id and whole-number components floor(scale * x), x as double.

    Vectors that are null or hold null or non-finite components take no part.
    """
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.where(F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & sound)
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("vector"))


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of vectors; shorter ones end in zeros, which add nothing to a product."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = width if width is not None else int(lengths.max(initial=0))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    found = np.zeros((len(lengths), width), np.int64)
    found[np.arange(width) < lengths[:, None]] = values
    return found


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers; by floating point only where that is exact.

    Sums that no bigint holds become the least or greatest score.
    """
    if left.size == 0 or right.size == 0:
        return np.zeros((len(left), len(right)), np.int64)
    extremes = [max(abs(float(x.max())), abs(float(x.min()))) for x in (left, right)]
    largest = extremes[0] * extremes[1] * left.shape[1]
    if largest < 2**53:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    if largest < 2**62:
        return left @ right.T
    exact = left.astype(object) @ right.T.astype(object)
    return np.clip(exact, NONE + 1, MOST).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def bounds(queries: np.ndarray, highs: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """The largest score each block could hold for each query: its components' maxima
    summed, by the sign of the query's component."""
    signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    return products(signed, np.concatenate([highs, lows], axis=1))


def search_run(
    query_ids: np.ndarray, floors: np.ndarray, queries: np.ndarray,
    ids: np.ndarray, rows: np.ndarray, highs: np.ndarray, lows: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one run for each query, score NONE where there are fewer."""
    scores = np.full((len(queries), k), NONE)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)
    limit = bounds(queries, highs, lows)
    order = np.argsort(-limit, axis=1, kind="stable")
    alive = np.arange(len(queries))
    for step in range(len(highs)):
        block = order[alive, step]
        kth = np.maximum(scores[alive, k - 1], floors[alive])
        # A block whose bound equals the k-th score may hold a smaller id.
        going = limit[alive, block] >= kth
        alive, block, kth = alive[going], block[going], kth[going]
        for number in np.unique(block).tolist():
            here = block == number
            at = alive[here]
            held = slice(number * BLOCK, (number + 1) * BLOCK)
            scored = products(queries[at], rows[held])
            own = query_ids[at][:, None] == ids[held]
            scored[own] = NONE
            useful = (scored >= kth[here][:, None]).any(axis=1)
            at, scored = at[useful], scored[useful]
            if len(at):
                both = np.concatenate([scores[at], scored], axis=1)
                names = np.broadcast_to(ids[held], scored.shape)
                scores[at], found[at] = best(both, np.concatenate([found[at], names], axis=1), k)
    return scores, found


def build_runs(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows of RUNS from quantised vectors: a run's ids, rows, and its blocks' extremes."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"))
            width = max(rows.shape[1], shared.value.shape[1])
            scored = products(widened(rows, width), widened(shared.value, width))
            pivot = scored.argmax(axis=1) if scored.shape[1] else np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot.astype(np.int32)), *batch.columns], ["pivot", "vec_id", "vector"]
            )

    def cut(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, len(batch), RUN):
                part = batch.slice(first, RUN)
                rows = matrix(part.column("vector"))
                starts = np.arange(0, len(rows), BLOCK)
                highs, lows = (x.reduceat(rows, starts) for x in (np.maximum, np.minimum))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([rows.shape[1]], pa.int32()),
                        *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in (highs.max(0), lows.min(0))],
                        *[
                            pa.array([x.tobytes()])
                            for x in (part.column("vec_id").to_numpy(), rows, highs, lows)
                        ],
                    ],
                    _names(RUNS),
                )
                number += 1

    placed = vectors.mapInArrow(nearest, "pivot int, vec_id bigint, vector array<bigint>")
    ordered = placed.repartitionByRange("pivot", "vec_id").sortWithinPartitions("pivot", "vec_id")
    return ordered.select("vec_id", "vector").mapInArrow(cut, RUNS)


def first_scores(
    asked: DataFrame, sample_ids: np.ndarray, sample: np.ndarray, k: int
) -> DataFrame:
    """Rows of ASKED: queries with a score that their k-th best reaches at least, which
    is the k-th best among the sample."""
    shared = asked.sparkSession.sparkContext.broadcast((sample_ids, sample))

    def reach(batches) -> Iterator[pa.RecordBatch]:
        names, drawn = shared.value
        for whole in batches:
            for first in range(0, len(whole), QUERIES_AT_ONCE):
                batch = whole.slice(first, QUERIES_AT_ONCE)
                rows, ids = matrix(batch.column("vector")), batch.column("query_id").to_numpy()
                width = max(rows.shape[1], drawn.shape[1])
                scored = products(widened(rows, width), widened(drawn, width))
                scored[ids[:, None] == names] = NONE
                reached = np.full(len(ids), NONE)
                if scored.shape[1] >= k:
                    reached = np.partition(scored, -k, axis=1)[:, -k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("query_id"), pa.array(reached),
                     batch.column("vector")],
                    _names(ASKED),
                )

    return asked.mapInArrow(reach, ASKED)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _portion(key: str, count: Column) -> Column:
    """A number below ``count`` by the key's hash."""
    return F.pmod(F.xxhash64(key), count)


def _numbers(last: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))


def _limits(best_only: bool):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                asked, extremes = batch.column("asked")[i].values, batch.column("extremes")[i].values
                parts = [
                    matrix(x)
                    for x in (asked.field("vector"), extremes.field("high"), extremes.field("low"))
                ]
                width = max(x.shape[1] for x in parts)
                limit = bounds(*(widened(x, width) for x in parts))
                names = extremes.field("run").to_numpy()
                if best_only:
                    place = np.arange(len(limit))
                    held = limit.argmax(axis=1)
                else:
                    # A run whose bound equals the k-th score may hold a smaller id.
                    reaches = limit >= asked.field("reached").to_numpy()[:, None]
                    reaches &= asked.field("searched").to_numpy()[:, None] != names
                    place, held = np.nonzero(reaches)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked.field("query").to_numpy()[place]),
                        pa.array(names[held]),
                        pa.array(limit[place, held]),
                    ],
                    _names(LIMITS),
                )

    return run


def build_slabs(runs: DataFrame, count: int) -> DataFrame:
    """Rows of slab (from 0, below ``count``) and the extremes of its runs."""
    slab = _portion("run", F.lit(count)).alias("slab")
    return runs.groupBy(slab).agg(F.collect_list(F.struct("run", "high", "low")).alias("extremes"))


def reaching(asked: DataFrame, queries: int, slabs: DataFrame, count: int, best_only: bool) -> DataFrame:
    """Rows of LIMITS: each query's run of the highest bound in each slab, or all runs
    whose bounds reach the query's k-th score but the one it has ``searched``.

    Queries and extremes meet by the slab and a salt, so that no key is a third of the
    work; only the extremes are copied, once for PORTIONS portions of the queries.
    """
    portions = -(-queries // QUERIES_AT_ONCE) or 1
    salts = -(-portions // PORTIONS)
    groups = asked.groupBy(_portion("query", F.lit(portions)).alias("portion")).agg(
        F.collect_list(F.struct(*asked.columns)).alias("asked")
    )
    groups = groups.select(
        (F.col("portion") % salts).alias("salt"),
        "asked",
        F.explode(_numbers(F.lit(count - 1))).alias("slab"),
    )
    copies = slabs.withColumn("salt", F.explode(_numbers(F.lit(salts - 1))))
    met = groups.join(copies, ["slab", "salt"])
    return met.select("asked", "extremes").mapInArrow(_limits(best_only), LIMITS)


def _search(k: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                asked, width = batch.column("asked")[i].values, batch.column("width")[i].as_py()
                ids, rows, highs, lows = (
                    np.frombuffer(batch.column(x)[i].as_buffer(), np.int64)
                    for x in ("ids", "rows", "highs", "lows")
                )
                queries = matrix(asked.field("vector"))
                wide = max(width, queries.shape[1])
                blocks = -(-len(ids) // BLOCK)
                stored = [
                    widened(x.reshape(n, width), wide)
                    for x, n in ((rows, len(ids)), (highs, blocks), (lows, blocks))
                ]
                names = asked.field("query_id").to_numpy()
                reached = asked.field("reached").to_numpy()
                scores, found = search_run(names, reached, widened(queries, wide), ids, *stored, k)
                place, rank = np.nonzero(scores != NONE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked.field("query").to_numpy()[place]),
                        pa.array(names[place]),
                        pa.array(found[place, rank]),
                        pa.array(scores[place, rank]),
                    ],
                    _names(HITS),
                )

    return run


def search(pairs: DataFrame, asked: DataFrame, runs: DataFrame, k: int) -> DataFrame:
    """Rows of HITS: the k best of the run for each pair of query and run.

    Queries of a run go to it in portions; a run with many portions is copied, one
    without any is not moved.
    """
    portions = (F.count("*") / QUERIES_AT_ONCE + 1).cast("bigint")
    counts = pairs.groupBy("run").agg(portions.alias("portions"))
    portion = _portion("query", F.col("portions")).alias("portion")
    placed = pairs.join(counts, "run").select("query", "run", portion)
    groups = placed.join(asked, "query").groupBy("run", "portion").agg(
        F.collect_list(F.struct("query", "query_id", "reached", "vector")).alias("asked")
    )
    groups = groups.withColumn("salt", (F.col("portion") / PORTIONS).cast("bigint"))
    last = (F.col("portions") - 1) / PORTIONS
    copies = counts.select("run", F.explode(_numbers(last)).alias("salt"))
    met = runs.join(copies, "run").join(groups, ["run", "salt"])
    return met.select("asked", "width", "ids", "rows", "highs", "lows").mapInArrow(_search(k), HITS)


def top_k(
    vectors: DataFrame, every: int, k: int, workspace: Workspace, scale: int = 256,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each row whose id is divisible by
    ``every``, the k highest inner products with rows of another id.

    Ties go to the smaller id. All are returned where there are fewer than k. Shorter
    vectors count as ending in zeros. A repeated row is a candidate each time, and a
    repeated query has a list each time; rows with a null id take no part, nor do
    vectors of which ``quantised`` tells so. Components beyond a bigint, and scores
    beyond it, are its ends. Other columns are not read.
    """
    usable = workspace.keep(quantised(vectors, vec_id, vector, scale), "quantised")
    drawn = hash_sample(usable, SAMPLE, "vec_id").orderBy("vec_id").limit(2 * SAMPLE).collect()
    width = max((len(row.vector) for row in drawn), default=0)
    sample = np.zeros((len(drawn), width), np.int64)
    for i, row in enumerate(drawn):
        sample[i, : len(row.vector)] = row.vector
    # Ids repeat at most as rows do; a query's own row must not count in its bound.
    ids = np.array([row.vec_id for row in drawn], np.int64)
    runs = workspace.keep(build_runs(usable, sample[:PIVOTS]), "runs")
    rows = usable.where(F.col("vec_id") % every == 0).select(
        F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), "vector"
    )
    # Stored, so that a query keeps its number.
    asked = workspace.keep(first_scores(rows, ids, sample, k), "asked")
    count = -(-runs.count() // SLAB) or 1
    slabs = workspace.keep(build_slabs(runs, count), "slabs")
    queries = asked.count()
    highest = reaching(asked, queries, slabs, count, best_only=True)
    highest = highest.groupBy("query").agg(F.max(F.struct("bound", "run")).alias("highest"))
    first = workspace.keep(highest.select("query", F.col("highest.run").alias("run")), "first")
    hits = workspace.keep(search(first, asked, runs, k), "first_hits")
    kth = hits.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    raised = asked.join(first.withColumnRenamed("run", "searched"), "query").join(kth, "query", "left")
    raised = workspace.keep(
        raised.select(
            "query", "query_id", F.greatest("reached", "kth").alias("reached"), "vector", "searched"
        ),
        "raised",
    )
    others = reaching(raised, queries, slabs, count, best_only=False).select("query", "run")
    others = workspace.keep(others, "others")
    hits = hits.union(search(others, raised.drop("searched"), runs, k))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
