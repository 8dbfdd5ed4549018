"""Packing pieces of token ids into sequences by fitted length patterns.

A pattern is a few lengths that fill a sequence exactly. How often each pattern is
used is a non-negative least-squares fit to the histogram of lengths, rounded
within the supply; what remains is packed best-fit, longest first. All of that
works on the histogram, of which the size is the sequence length, never on the
pieces: these only look up the place of their rank among pieces of their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reviewloom.llm.arrow_text import slices
from reviewloom.llm.encoders import encoder
from reviewloom.llm.tables import Workspace

PIECE = "doc_id bigint, piece int, start bigint, ids binary"
# Text that is encoded at a time.
ENCODED_BYTES = 4 << 20
# Steps of the fit.
FIT_STEPS = 200
# Pieces of one length and salt are numbered in one task; there are more salts for
# more pieces, so that a length with a third of them is many tasks' work.
LEAST_SALTS = 64
PIECES_PER_SALT = 1 << 20


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, limit: int) -> DataFrame:
    """Pieces of at most ``limit`` ids of every text with ``end_id`` after it.

    Only longer documents are cut, into whole pieces and a last one that may be
    shorter. ``ids`` are unsigned 32-bit little-endian. A null text is the empty
    one: a piece of the end id alone. Columns besides doc_id and text are not read;
    repeated rows each have their own pieces.
    """

    def cut(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch, texts in slices(batches, size=ENCODED_BYTES):
            found = encode.encode(texts)
            ids = np.insert(found.values.astype("<u4"), found.starts[1:], end_id)
            starts = found.starts + np.arange(len(found.starts))
            counts = -(-np.diff(starts) // limit)
            rows = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            offsets = np.append(starts[rows] + piece * limit, starts[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(rows)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * limit),
                    pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(),
                        len(rows),
                        [None, pa.py_buffer(4 * offsets), pa.py_buffer(ids)],
                    ).cast(pa.binary()),
                ],
                ["doc_id", "piece", "start", "ids"],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return read.mapInArrow(cut, PIECE)


class Plan(NamedTuple):
    """Where pieces go: among pieces of length ``length[i]``, those of rank
    ``first[i]`` on are in sequences ``sequence[i]`` on, at ``offset[i]``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def patterns(histogram: np.ndarray, limit: int) -> np.ndarray:
    """All multisets of one to three lengths that occur and add up to ``limit``; 0 stands
    for no document. Columns fall from left to right, rows ascend."""
    occur = histogram > 0
    occur[0] = True
    lengths = np.flatnonzero(occur)
    found = []
    for longest in lengths[lengths >= -(-limit // 3)]:
        rest = limit - longest
        middle = lengths[(lengths <= min(longest, rest)) & (lengths >= -(-rest // 2))]
        middle = middle[occur[rest - middle]]
        found.append(np.column_stack([np.full(len(middle), longest), middle, rest - middle]))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns, by least squares: multiplicative steps
    x * (A'h) / (A'Ax), which keep x non-negative and never raise the error."""
    target = histogram.astype(float)
    target[0] = 0
    pull = target[rows].sum(axis=1)
    x = pull / max(pull.sum(), 1) * target.sum() / 3
    flat = rows.ravel()
    for _ in range(steps):
        made = np.bincount(flat, np.repeat(x, 3), minlength=len(target))
        made[0] = 0
        x = x * pull / np.maximum(made[rows].sum(axis=1), 1e-12)
    return x


def rounded(rows: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> list[tuple]:
    """Patterns with whole counts within the supply, which is used up in place.

    The running sum is rounded, not each count, so that many small counts of the
    same longest length add up to what they should.
    """
    total = np.floor(np.cumsum(x) + 0.5).astype(np.int64)
    counts = np.diff(total, prepend=0)
    used = []
    for i in np.flatnonzero(counts).tolist():
        lengths = [n for n in rows[i].tolist() if n]
        each = {n: lengths.count(n) for n in lengths}
        count = min(counts[i], *(histogram[n] // k for n, k in each.items()))
        if count > 0:
            for n, k in each.items():
                histogram[n] -= count * k
            used.append((tuple(lengths), int(count)))
    return used


def best_fit(histogram: np.ndarray, limit: int) -> list[tuple]:
    """Sequences of the remaining lengths, longest first, each into the smallest gap
    that takes it. Equal sequences are one entry with a count."""
    open_runs: dict[int, list] = {}
    gaps: list[int] = []
    closed = []

    def keep(lengths: tuple, gap: int, count: int) -> None:
        if gap == 0:
            closed.append((lengths, count))
            return
        if gap not in open_runs:
            open_runs[gap] = []
            insort(gaps, gap)
        open_runs[gap].append((lengths, count))

    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length]) if length else 0
        while left:
            place = bisect_left(gaps, length)
            if place < len(gaps):
                gap = gaps[place]
                lengths, count = open_runs[gap].pop()
                if not open_runs[gap]:
                    del open_runs[gap]
                    gaps.pop(place)
            else:
                gap, lengths, count = limit, (), left
            # After one such piece the gap is smaller still, so the next goes there too.
            fits = min(gap // length, left)
            filled = min(count, left // fits)
            keep(lengths + (length,) * fits, gap - fits * length, filled)
            left -= fits * filled
            if lengths and count > filled:
                keep(lengths, gap, count - filled)
    return closed + [run for runs in open_runs.values() for run in runs]


def plan(histogram: np.ndarray, limit: int) -> Plan:
    """Places for all pieces that the histogram counts, by length from 0 to ``limit``."""
    supply = histogram.astype(np.int64)
    rows = patterns(supply, limit)
    used = rounded(rows, fit(rows, supply), supply)
    used += best_fit(supply, limit)
    entries, sequence = [], 0
    taken = np.zeros(limit + 1, np.int64)
    for lengths, count in used:
        offset = 0
        for length in lengths:
            entries.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    columns = np.array(entries, np.int64).reshape(-1, 4)
    columns = columns[np.lexsort((columns[:, 1], columns[:, 0]))]
    return Plan(*columns.T, sequence)


def ranks(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 among pieces of the same length; no task has all of a length."""
    salts = max(LEAST_SALTS, pieces.count() // PIECES_PER_SALT)
    salted = pieces.withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int")
    )
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_salt")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    numbered = salted.withColumn("_place", F.row_number().over(within) - 1)
    joined = numbered.join(before, ["length", "_salt"])
    return joined.withColumn("rank", F.col("_before") + F.col("_place")).drop(
        "_salt", "_before", "_place"
    )


def pack(pieces: DataFrame, limit: int, workspace: Workspace) -> DataFrame:
    """Adds sequence_id and offset to pieces with columns doc_id, piece and length.

    ``length`` is 1 to ``limit``. ``pieces`` should be a stored table: it is read for
    the histogram and again for the places. Other columns are kept, apart from ones
    called rank, sequence_id or offset, which are replaced. Equal pieces are
    interchangeable. No pieces make no sequences.
    """
    pieces = pieces.drop("rank", "sequence_id", "offset")
    histogram = np.zeros(limit + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    # Plain arrays: a class of this package would have to be there to be unpickled.
    places = pieces.sparkSession.sparkContext.broadcast(tuple(plan(histogram, limit)[:4]))
    # Ranks are drawn by hash and order, and kept, so that no retry deals them anew.
    ranked = workspace.keep(ranks(pieces), "ranked_pieces")
    added = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    schema = StructType([*ranked.drop("rank").schema.fields, *added])

    def place(batches) -> Iterator[pa.RecordBatch]:
        lengths, first, sequences, offsets = places.value
        keys = (lengths << 40) + first
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            entry = np.searchsorted(keys, (length << 40) + rank, "right") - 1
            sequence = sequences[entry] + rank - first[entry]
            rest = batch.select([n for n in batch.schema.names if n != "rank"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(sequence), pa.array(offsets[entry])],
                [*rest.schema.names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limit: int, workspace: Workspace
) -> DataFrame:
    """Pieces of all documents with their digest and place; ids stay in the scan."""
    pieces = cut_pieces(docs, tokenizer, end_id, limit).select(
        "doc_id",
        "piece",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return pack(workspace.keep(pieces, "pieces"), limit, workspace)
