"""Exact removal of repeated passages by a multi-document Burrows-Wheeler transform.

A byte goes if a string of 50 bytes that covers it also starts in a document with a smaller
id. All strings of 50 bytes (windows) are compared by one transform of the collection,
built column by column: each round puts one more symbol of every text in front of what is
there, which moves its suffix to the place that the transform itself tells, and the lengths
of the prefixes that neighbours share are updated on the way. Neighbours that share 50
symbols hold the same window.

To deal the collection over tasks, windows are parted by content. Of the k-grams of a
window the one with the smallest hash is its key, so equal windows have equal keys, and
neighbouring windows, which mostly have the same one, stay together as a piece. Keys are
dealt to buckets. First only keys travel, to learn which of them one document only has;
then the pieces with other keys do, and a bucket's transform is that of its pieces. K-grams
that a sample shows to be frequent come last in the order: no key belongs to a common phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import offsets_of, slices, worker_state
from reviewloom.llm.tables import Workspace, hash_sample

WINDOW = 50
# Bytes of a symbol of the transform. Each text stands for as many strings, one from each of
# its first bytes on, so that windows at all places are there; there are fewer rounds.
STRIDE = 5
GRAM = 20
# Text of a slice, which is cut, sent and answered as a whole; a longer document is a
# slice of its own, worked on in segments of that size.
SLICE_BYTES = 4 << 20
# Windows of a piece at most; a text that repeats itself has one smallest gram for long.
PIECE_WINDOWS = 64
# Text of all windows of a bucket. Those that travel are mostly a small part of it; the
# more a bucket takes, the fewer rows go from each slice to each bucket.
BUCKET_BYTES = 12 << 20
# Symbols of a transform at most, but for those of one key: then 16 bits tell them apart.
TRANSFORM_SYMBOLS = 65_000
# The sample that finds frequent grams: documents, and the share of them that have one.
SAMPLE, FREQUENT_SHARE = 1000, 0.01
FREQUENT_BITS, SAMPLE_TASKS = 20, 8
# Windows that are hashed at once: what fits a processor's cache.
HASHED_AT_ONCE = 1 << 15
# Bits of a key that do not travel when only keys do; those that look alike may meet.
UNSENT_BITS = 16

NO_ID = np.iinfo(np.int64).max
SLICES = "slice bigint, size bigint, ids binary, known binary, lengths binary, body binary"
# What slices send to buckets, and what these answer.
SENT = "bucket bigint, slice bigint, segment int, payload binary"
ANSWERS = "slice bigint, segment int, bucket bigint, payload binary"
KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_MIX = np.uint64(0x9E3779B97F4A7C15)


# One transform


def transform(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform of several strings and the lengths of common prefixes of neighbours.

    ``symbols[starts[i]:starts[i + 1]]`` is string i, numbers from 1 on; 0 ends a string, and
    the end of an earlier string comes first. Round j inserts the suffixes of length j of
    all strings that long. Both results are read and written from front to back each
    round. Common prefixes are counted up to 254.
    """
    ends, lengths = starts[1:], np.diff(starts)
    count = len(lengths)
    # The empty suffixes, each after the last symbol of its string.
    bwt, common = symbols[ends - 1].copy(), np.zeros(count, np.uint8)
    places = np.arange(count)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        size = len(bwt)
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        # Symbols in order stand for the suffixes that begin with them, after the empty ones.
        shift = count - np.count_nonzero(bwt == 0)
        going = np.flatnonzero(lengths >= j)
        own = rank[places[going]]
        places[going] = own + shift
        # New neighbours: of an inserted suffix and the one before it, and the one after it.
        marks = np.zeros(size + 1, bool)
        marks[own] = marks[own + 1] = True
        touched = np.flatnonzero(marks[:size])
        first = bwt[order[touched]]
        alike = (touched > 0) & (first == bwt[order[touched - 1]]) & (first > 0)
        shared = np.zeros(len(touched), np.uint8)
        shared[alike] = _least(common, order[touched[alike] - 1] + 1, order[touched[alike]] + 1)
        # Only what changes: suffixes whose neighbour did not become another one keep theirs.
        shared[alike] = np.minimum(shared[alike], 253) + 1
        old = np.ones(size + len(going), bool)
        old[places[going]] = False
        added = np.where(lengths[going] > j, symbols[ends[going] - 1 - j], 0)
        bwt, common = _merged(old, bwt), _merged(old, common)
        bwt[places[going]] = added
        common[(touched + shift)[first > 0]] = shared[first > 0]
    return bwt, common


def _merged(old: np.ndarray, values: np.ndarray) -> np.ndarray:
    result = np.empty(len(old), values.dtype)
    result[old] = values
    return result


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first[i]:last[i]]``, none empty."""
    if not len(first):
        return np.zeros(0, values.dtype)
    # In falling order of their starts the gaps between ranges cost nothing.
    order = np.argsort(-first, kind="stable")
    ranges = np.column_stack([first[order], last[order]]).ravel()
    found = np.empty(len(first), values.dtype)
    found[order] = np.minimum.reduceat(np.append(values, values[-1]), ranges)[::2]
    return found


def phases(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as strings of symbols of STRIDE bytes, for each text one from each of its first
    STRIDE bytes on: symbols by rank from 1, starts of the strings, their lengths."""
    codes = np.zeros(len(data), np.int64)
    for i in range(STRIDE):
        codes[: len(data) - i] = codes[: len(data) - i] << 8 | data[i:]
    places = np.add.outer(starts[:-1], np.arange(STRIDE)).ravel()
    lengths = (np.subtract.outer(np.diff(starts), np.arange(STRIDE)) // STRIDE).ravel()
    before = np.append(0, np.cumsum(lengths))
    at = np.repeat(places - STRIDE * before[:-1], lengths) + STRIDE * np.arange(before[-1])
    known, symbols = np.unique(codes[at], return_inverse=True)
    kind = np.uint16 if len(known) < 1 << 16 else np.uint32
    return (symbols + 1).astype(kind), before, lengths


def first_ids(data: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window of every text, in order, the smallest id of a text that has it."""
    symbols, begins, lengths = phases(data, starts)
    bwt, common = transform(symbols, begins)
    rank = np.empty(len(bwt), np.int64)
    rank[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    # Suffixes with the same window are neighbours that share that many symbols.
    needed = WINDOW // STRIDE
    group = np.cumsum(common < needed)
    counts = np.diff(starts) - WINDOW + 1
    # Of each string: the number of the window at its first symbol.
    windows = np.add.outer(np.append(0, np.cumsum(counts))[:-1], np.arange(STRIDE)).ravel()
    where = np.empty(counts.sum(), np.int64)
    places = np.arange(len(lengths))
    for j in range(1, int(lengths.max()) + 1):
        going = np.flatnonzero(lengths >= j)
        places[going] = rank[places[going]]
        if j >= needed:
            # The suffix of length j begins with the window so many symbols before the end.
            where[windows[going] + STRIDE * (lengths[going] - j)] = group[places[going]]
    first = np.full(group[-1] + 1, NO_ID)
    np.minimum.at(first, where, np.repeat(ids, counts))
    return first[where]


# Pieces


class Cut(NamedTuple):
    """Pieces of a segment in text order: key, windows, and where the first window starts."""

    keys: np.ndarray
    windows: np.ndarray
    places: np.ndarray


class Pieces(NamedTuple):
    """Distinct pieces in the order of their keys, and where they occur."""

    keys: np.ndarray
    windows: np.ndarray
    content: pa.Array
    # Of each occurrence: its distinct piece, and where its first window starts.
    piece: np.ndarray
    places: np.ndarray


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, and powers of an odd number and of its inverse, for hashes of
    any part of a text from one running sum."""
    state = worker_state("windows")
    if "powers" not in state:
        base = 0xD6E8FEB86659FD93
        inverse = pow(base, -1, 1 << 64)
        size = HASHED_AT_ONCE + 2 * WINDOW
        up, down = (np.cumprod(np.full(size, x, np.uint64)) for x in (base, inverse))
        values = np.random.default_rng(12).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
        state["powers"] = values, up, down
    return state["powers"]


def hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes in a row of not many more than HASHED_AT_ONCE."""
    values, up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    found = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    found ^= found >> np.uint64(32)
    found *= _MIX
    found ^= found >> np.uint64(29)
    return found


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def window_keys(data: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A key of every window: of its grams that are not frequent the smallest hash, or
    where all are frequent a hash of the window."""
    last = np.iinfo(np.uint64).max
    keys = np.empty(max(len(data) - WINDOW + 1, 0), np.uint64)
    for at in range(0, len(keys), HASHED_AT_ONCE):
        part = data[at : at + HASHED_AT_ONCE + WINDOW - 1]
        grams = hashes(part, GRAM)
        grams[frequent[(grams >> np.uint64(64 - FREQUENT_BITS)).view(np.int64)]] = last
        found = smallest(grams, WINDOW - GRAM + 1)
        none = found == last
        if none.any():
            found[none] = hashes(part, WINDOW)[none]
        # Smallest hashes are small; mixed, they fill all buckets alike.
        keys[at : at + len(found)] = found * _MIX
    return keys


def cut_pieces(data: np.ndarray, starts: np.ndarray, frequent: np.ndarray) -> Cut:
    """Pieces of the texts ``data[starts[i]:starts[i + 1]]``: runs of windows with one key,
    none longer than PIECE_WINDOWS."""
    keys = window_keys(data, frequent)
    if not len(keys):
        none = np.zeros(0, np.int64)
        return Cut(keys, none, none)
    # Windows that reach into the next text are none.
    marks = np.zeros(len(data) + 1, np.int8)
    long = np.diff(starts) >= WINDOW
    marks[starts[:-1][long]] += 1
    marks[starts[1:][long] - WINDOW + 1] -= 1
    valid = np.cumsum(marks[: len(keys)], dtype=np.int8) > 0
    change = np.flatnonzero((keys[1:] != keys[:-1]) | (valid[1:] != valid[:-1])) + 1
    first = np.append(0, change)
    sizes = np.diff(np.append(first, len(keys)))
    first, sizes = first[valid[first]], sizes[valid[first]]
    parts = -(-sizes // PIECE_WINDOWS)
    inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    places = np.repeat(first, parts) + inside * PIECE_WINDOWS
    windows = np.minimum(np.repeat(sizes, parts) - inside * PIECE_WINDOWS, PIECE_WINDOWS)
    return Cut(keys[places], windows, places)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of a start and a size, one range after the other."""
    found = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes)
    found += np.arange(len(found))
    return found


def distinct_pieces(data: np.ndarray, cut: Cut) -> Pieces:
    sizes = cut.windows + WINDOW - 1
    offsets = np.append(0, np.cumsum(sizes))
    content = pa.py_buffer(data[spread(cut.places, sizes)])
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), content]
    )
    named = values.dictionary_encode()
    code = named.indices.to_numpy()
    once = np.unique(code, return_index=True)[1]
    order = np.argsort(cut.keys[once], kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return Pieces(
        cut.keys[once][order], cut.windows[once][order], named.dictionary.take(pa.array(order)),
        back[code], cut.places,
    )


class Slice:
    """A stored slice: texts with their ids, taken apart into segments."""

    def __init__(self, row: dict):
        body = pa.decompress(row["body"], row["size"], "zstd", asbytes=True) if row["size"] else b""
        self.data = np.frombuffer(body, np.uint8)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.starts = np.append(0, np.cumsum(np.frombuffer(row["lengths"], np.int64)))

    def segments(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Number, place, bytes, starts of texts and their numbers. Segments of one long text overlap
        by all but one byte of a window."""
        if len(self.data) <= SLICE_BYTES:
            # Texts without an id meet no other.
            keep = np.flatnonzero(self.known)
            if len(keep) == len(self.ids):
                yield 0, 0, self.data, self.starts, keep
            else:
                texts = [self.data[self.starts[i] : self.starts[i + 1]] for i in keep.tolist()]
                lengths = np.diff(self.starts)[keep]
                data = np.concatenate(texts or [self.data[:0]])
                yield 0, 0, data, np.append(0, np.cumsum(lengths)), keep
            return
        for number in np.flatnonzero(self.known).tolist():
            first, last = self.starts[number], self.starts[number + 1]
            for segment, at in enumerate(range(first, max(last - WINDOW + 1, first), SLICE_BYTES)):
                end = min(at + SLICE_BYTES + WINDOW - 1, last)
                yield segment, at, self.data[at:end], np.array([0, end - at]), np.array([number])


def texts_of(cut: Cut | Pieces, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The number of the text of every occurrence."""
    return numbers[np.searchsorted(starts, cut.places, "right") - 1]


def extremes(groups: np.ndarray, count: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest id of each of ``count`` groups."""
    low, high = np.full(count, NO_ID), np.full(count, -NO_ID)
    np.minimum.at(low, groups, ids)
    np.maximum.at(high, groups, ids)
    return low, high


def bucket_ranges(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, first, last) of pieces in the order of their keys; a bucket is a range."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number))
    if not len(number):
        return []
    return [(int(number[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


# Spark


def stored_slices(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows of SLICES, written once, so that a slice is the same whenever it is read."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, texts in slices(batches, size=SLICE_BYTES):
            offsets = offsets_of(texts)
            body = texts.buffers()[2]
            body = body.slice(offsets[0], offsets[-1] - offsets[0]) if body else pa.py_buffer(b"")
            ids = batch.column("doc_id")
            columns = [
                number, body.size, ids.fill_null(0).to_numpy().tobytes(),
                ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
                np.diff(offsets).tobytes(), pa.compress(body, "zstd", asbytes=True),
            ]
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(columns, kinds)],
                [field.split()[0] for field in SLICES.split(", ")],
            )
            number += 1

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return workspace.keep(read.mapInArrow(run, SLICES), "slices")


def frequent_grams(docs: DataFrame) -> np.ndarray:
    """Marks for the leading bits of gram hashes that are frequent in a sample of documents.

    The sample and the marks are of fixed size. They decide which bucket a window goes
    to, the same for equal windows, and nothing else.
    """
    sample = hash_sample(docs.select("doc_id", "text"), SAMPLE, "doc_id", "text")
    sample = sample.repartition(SAMPLE_TASKS, F.xxhash64("doc_id", "text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << FREQUENT_BITS, np.int32)
        for batch, texts in slices(batches, size=1):
            data = np.frombuffer(texts[0].as_py().encode(), np.uint8)
            for at in range(0, len(data) - GRAM + 1, HASHED_AT_ONCE):
                grams = hashes(data[at : at + HASHED_AT_ONCE + GRAM - 1], GRAM)
                # Once a document, or once a stretch of a long one.
                count[np.unique(grams >> np.uint64(64 - FREQUENT_BITS)).view(np.int64)] += 1
        often = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(often), pa.array(count[often].astype(np.int64))], ["place", "n"]
        )

    found = sample.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    least = max(10, int(SAMPLE * FREQUENT_SHARE))
    marks = np.zeros(1 << FREQUENT_BITS, bool)
    marks[[row.place for row in found.where(F.col("n") >= least).collect()]] = True
    return marks


def _row(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def _to_buckets(name: int, segment: int, rows: list[tuple[int, bytes]], schema: str) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "slice": pa.int64(), "segment": pa.int32(), "payload": pa.binary()}
    columns = {
        "bucket": [b for b, _ in rows], "slice": [name] * len(rows),
        "segment": [segment] * len(rows), "payload": [x for _, x in rows],
    }
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[x], kinds[x]) for x in names], names)


def _send_keys(marks: bytes, buckets: int):
    """Distinct keys of a slice to their buckets, and whether two of its ids have them."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(marks, bool)
        for row in _row(batches):
            part = Slice(row)
            for segment, _, data, starts, numbers in part.segments():
                cut = cut_pieces(data, starts, frequent)
                keys, group = np.unique(cut.keys, return_inverse=True)
                low, high = extremes(group, len(keys), part.ids[texts_of(cut, starts, numbers)])
                steps = np.diff(keys >> np.uint64(UNSENT_BITS), prepend=np.uint64(0))
                rows = [
                    (bucket, pack([(low != high)[a:b], np.append(keys[a] >> np.uint64(UNSENT_BITS), steps[a + 1 : b])]))
                    for bucket, a, b in bucket_ranges(keys, buckets)
                ]
                yield _to_buckets(row["slice"], segment, rows, SENT)

    return run


def _answer_keys(batches) -> Iterator[pa.RecordBatch]:
    """Tells every slice which of its keys more than one document has."""
    for number, rows in _by_bucket(batches):
        several, keys = [], []
        for row in rows:
            count, whole = unpack(row["payload"])
            several.append(np.frombuffer(whole, bool, count))
            keys.append(np.cumsum(np.frombuffer(whole, np.uint64, count, count), dtype=np.uint64))
        _, group, often = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        found = often > 1
        found[group[np.concatenate(several)]] = True
        at = 0
        for row, own in zip(rows, keys):
            bits = found[group[at : at + len(own)]]
            at += len(own)
            if bits.any():
                yield _to_buckets(row["slice"], row["segment"], [(number, pack([bits]))], ANSWERS)


def _by_bucket(batches) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each bucket, which stand together."""
    rows: list[dict] = []
    for row in _row(batches):
        if rows and rows[0]["bucket"] != row["bucket"]:
            yield rows[0]["bucket"], rows
            rows = []
        rows.append(row)
    if rows:
        yield rows[0]["bucket"], rows


def shared_pieces(data, starts, frequent, buckets: int, segment: int, answers: dict) -> Pieces:
    """The distinct pieces of a segment of which another document may have a window."""
    cut = cut_pieces(data, starts, frequent)
    keys, group = np.unique(cut.keys, return_inverse=True)
    wanted = np.zeros(len(keys), bool)
    for bucket, first, last in bucket_ranges(keys, buckets):
        answer = answers.get((segment, bucket))
        if answer:
            wanted[first:last] = np.frombuffer(unpack(answer)[1], bool)
    here = wanted[group]
    return distinct_pieces(data, Cut(*(x[here] for x in cut)))


def _send_pieces(marks: bytes, buckets: int):
    """Distinct pieces of a slice to their buckets, with the smallest and the largest id."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(marks, bool)
        for row in _row(batches):
            part, answers = Slice(row), _listed(row["shared"])
            for segment, _, data, starts, numbers in part.segments() if answers else ():
                pieces = shared_pieces(data, starts, frequent, buckets, segment, answers)
                ids = part.ids[texts_of(pieces, starts, numbers)]
                low, high = extremes(pieces.piece, len(pieces.keys), ids)
                rows = []
                for bucket, first, last in bucket_ranges(pieces.keys, buckets):
                    content = pieces.content[first:last]
                    offsets = offsets_of(content)
                    parts = [
                        pieces.windows[first:last].astype(np.uint8), np.diff(low[first:last], prepend=0),
                        high[first:last] - low[first:last],
                        np.frombuffer(content.buffers()[2], np.uint8)[offsets[0] : offsets[-1]],
                    ]
                    rows.append((bucket, pack(parts)))
                yield _to_buckets(row["slice"], segment, rows, SENT)

    return run


def _listed(answers: list[dict] | None) -> dict[tuple, bytes]:
    return {(x["segment"], x["bucket"]): x["payload"] for x in answers or []}


def pack(parts: list[np.ndarray]) -> bytes:
    """Arrays as compressed bytes, after their sizes."""
    whole = b"".join(x.tobytes() for x in parts)
    head = np.array([len(parts[0]), len(whole)], np.int64).tobytes()
    return head + pa.compress(whole, "zstd", asbytes=True)


def unpack(payload: bytes) -> tuple[int, bytes]:
    count, size = np.frombuffer(payload[:16], np.int64).tolist()
    return count, pa.decompress(payload[16:], size, "zstd", asbytes=True) if size else b""


class Bucket:
    """Pieces that were sent to a bucket, and the first id of each of their windows."""

    def __init__(self):
        self.senders, self.windows, self.low, self.high, self.content = [], [], [], [], []

    def add(self, sender: tuple, payload: bytes) -> None:
        count, whole = unpack(payload)
        windows = np.frombuffer(whole, np.uint8, count).astype(np.int64)
        low = np.cumsum(np.frombuffer(whole, np.int64, count, count))
        offsets = np.append(0, np.cumsum(windows + WINDOW - 1)) + 17 * count
        self.senders.append((*sender, count))
        self.windows.append(windows)
        self.low.append(low)
        self.high.append(low + np.frombuffer(whole, np.int64, count, 9 * count))
        self.content.append(
            pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(whole)]
            )
        )

    def settle(self, frequent: np.ndarray) -> Iterator[tuple]:
        """(slice, segment, first ids of all windows of its pieces) for senders of which a
        text has a window of an earlier one."""
        windows, low, high = (np.concatenate(x) for x in (self.windows, self.low, self.high))
        named = pa.concat_arrays(self.content).dictionary_encode()
        code = named.indices.to_numpy()
        content = named.dictionary
        count = len(content)
        first_low, last_high = extremes(code, count, low)[0], extremes(code, count, high)[1]
        offsets = offsets_of(content)
        data = np.frombuffer(content.buffers()[2], np.uint8)
        keys = _piece_keys(data, offsets, frequent)
        # A key that one document only has is not compared.
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        sizes = np.diff(np.append(edges, count))
        shared = np.minimum.reduceat(first_low[order], edges) != np.maximum.reduceat(last_high[order], edges)
        sizes, order = sizes[shared], order[np.repeat(shared, sizes)]
        lengths = np.diff(offsets)
        each = np.append(0, np.cumsum(lengths - WINDOW + 1))
        found = np.full(each[-1], NO_ID)
        for part in _portions(order, sizes, lengths):
            starts = np.append(0, np.cumsum(lengths[part]))
            firsts = first_ids(data[spread(offsets[part], lengths[part])], starts, first_low[part])
            found[spread(each[part], lengths[part] - WINDOW + 1)] = firsts
        at = 0
        for name, segment, pieces in self.senders:
            here = slice(at, at + pieces)
            at += pieces
            counts = windows[here]
            firsts = found[spread(each[code[here]], counts)]
            # What no text of the sender comes after is of no use to it.
            firsts = np.where(firsts < np.repeat(high[here], counts), firsts, NO_ID)
            if (firsts != NO_ID).any():
                yield name, segment, pack([firsts])


def _piece_keys(data: np.ndarray, offsets: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The key of every piece: that of its first window. Taken in portions."""
    keys = np.empty(len(offsets) - 1, np.uint64)
    step = max(1, SLICE_BYTES // (WINDOW + PIECE_WINDOWS))
    for first in range(0, len(keys), step):
        last = min(first + step, len(keys))
        a, b = offsets[first], offsets[last]
        keys[first:last] = window_keys(data[a:b], frequent)[offsets[first:last] - a]
    return keys


def _portions(order: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces for one transform: all of a key, and several keys up to the size of one."""
    ends = np.cumsum(sizes)
    symbols = np.append(0, np.cumsum(lengths[order]))[np.append(0, ends)]
    first = 0
    while first < len(sizes):
        last = int(np.searchsorted(symbols, symbols[first] + TRANSFORM_SYMBOLS, "right")) - 1
        last = max(last, first + 1)
        yield order[ends[first] - sizes[first] : ends[last - 1]]
        first = last


def _answer_pieces(marks: bytes):
    def run(batches) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(marks, bool)
        for number, rows in _by_bucket(batches):
            held = Bucket()
            while rows:
                row = rows.pop()
                held.add((row["slice"], row["segment"]), row["payload"])
            for name, segment, payload in held.settle(frequent):
                yield _to_buckets(name, segment, [(number, payload)], ANSWERS)

    return run


def _remove(marks: bytes, buckets: int):
    """Cuts a slice once more and takes away what its buckets' answers cover."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(marks, bool)
        for row in _row(batches):
            part, shared, firsts = Slice(row), _listed(row["shared"]), _listed(row["firsts"])
            # One more and one less where a removed stretch begins and ends.
            edges = np.zeros(len(part.data) + 1, np.int32)
            for segment, place, data, starts, numbers in part.segments() if firsts else ():
                pieces = shared_pieces(data, starts, frequent, buckets, segment, shared)
                each = np.append(0, np.cumsum(pieces.windows))
                earliest = np.full(each[-1], NO_ID)
                for bucket, first, last in bucket_ranges(pieces.keys, buckets):
                    answer = firsts.get((segment, bucket))
                    if answer:
                        earliest[each[first] : each[last]] = np.frombuffer(unpack(answer)[1], np.int64)
                counts = pieces.windows[pieces.piece]
                own = np.repeat(texts_of(pieces, starts, numbers), counts)
                gone = earliest[spread(each[pieces.piece], counts)] < part.ids[own]
                at, own = spread(pieces.places, counts)[gone], own[gone]
                # From the segment's bytes to those of the slice.
                text = np.searchsorted(numbers, own)
                at += (part.starts[own] - starts[text]) if not segment else place
                np.add.at(edges, at, 1)
                np.add.at(edges, at + WINDOW, -1)
            gone = np.cumsum(edges[:-1]) > 0
            rows = []
            for i, (a, b) in enumerate(zip(part.starts[:-1].tolist(), part.starts[1:].tolist())):
                cut = gone[a:b]
                spans = int(np.count_nonzero(cut[1:] & ~cut[:-1])) + int(cut[:1].sum())
                kept = hashlib.sha256(part.data[a:b][~cut]).hexdigest()
                rows.append((int(part.ids[i]) if part.known[i] else None, b - a, int(cut.sum()), spans, kept))
            kinds = (*[pa.int64()] * 4, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                [field.split()[0] for field in KEPT.split(", ")],
            )

    return run


def removed_repeats(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row with doc_id and text.

    A null text is the empty one. Rows with a null doc_id are neither earlier nor later
    than another: they lose nothing and take nothing. Rows that share an id lose what
    rows with a smaller one have, not what they have in common. Other columns are not read.
    """
    marks = frequent_grams(docs).tobytes()
    held = stored_slices(docs, workspace)
    size = held.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = size // BUCKET_BYTES + 1

    def met(sent: DataFrame) -> DataFrame:
        return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def listed(answers: DataFrame, name: str) -> DataFrame:
        entries = F.collect_list(F.struct("segment", "bucket", "payload"))
        return answers.groupBy("slice").agg(entries.alias(name))

    keys = met(held.mapInArrow(_send_keys(marks, buckets), SENT)).mapInArrow(_answer_keys, ANSWERS)
    shared = listed(workspace.keep(keys, "shared"), "shared")
    known = held.join(shared, "slice", "left")
    sent = met(known.mapInArrow(_send_pieces(marks, buckets), SENT))
    answers = workspace.keep(sent.mapInArrow(_answer_pieces(marks), ANSWERS), "firsts")
    return known.join(listed(answers, "firsts"), "slice", "left").mapInArrow(_remove(marks, buckets), KEPT)
