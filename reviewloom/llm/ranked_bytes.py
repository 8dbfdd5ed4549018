"""Token ids in files: frequency ranks in byte-aligned variable length.

A segment holds the ids of a run of documents. Its rank table lists its ids, the
most frequent first, by counts over all ids of the segment. Each id is stored as
its rank in one to four bytes; two bits per rank tell how many, four ranks to a
control byte, and control bytes stand apart from the data bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import Ragged, slices
from reviewloom.llm.encoders import encoder

SEGMENT = (
    "part int, segment int, before bigint, n_ids bigint, doc_ids array<bigint>, "
    "lengths array<bigint>, ranked binary, control binary, data binary"
)

# By control byte: where each of its four numbers starts, and the bytes of all.
_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
_ENDS = np.cumsum(_CODES + 1, axis=1)
STARTS = np.concatenate([np.zeros((256, 1), np.int64), _ENDS[:, :3]], axis=1)
TOTALS = _ENDS[:, 3]
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned numbers below 2^32."""
    numbers = np.ascontiguousarray(numbers, "<u4")
    codes = (numbers > 0xFF).astype(np.uint8)
    codes += numbers > 0xFFFF
    codes += numbers > 0xFFFFFF
    fours = np.zeros((-(-len(codes) // 4), 4), np.uint8)
    fours.ravel()[: len(codes)] = codes
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= codes[:, None]
    return control.tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again, by looking control bytes up in the tables above."""
    control = np.frombuffer(control, np.uint8)
    # The last control byte may stand for fewer than four numbers.
    data = np.frombuffer(data + bytes(8), np.uint8)
    firsts = np.zeros(len(control), np.int64)
    np.cumsum(TOTALS[control[:-1]], out=firsts[1:])
    places = (firsts[:, None] + STARTS[control]).ravel()[:count]
    found = data[places].astype(np.uint32)
    codes = _CODES[control].ravel()[:count]
    for byte in (1, 2, 3):
        longer = np.flatnonzero(codes >= byte)
        if not len(longer):
            break
        found[longer] |= data[places[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return found


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, most frequent first and small ones first among equals, and
    the rank of each id."""
    counts = np.bincount(ids)
    table = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    ranks = np.zeros(len(counts), np.uint32)
    ranks[table] = np.arange(len(table))
    return table.astype("<u4"), ranks[ids]


def _segment(part: int, number: int, before: int, ids: Ragged, doc_ids) -> pa.RecordBatch:
    table, ranks = ranked(ids.values)
    control, data = pack(ranks)
    columns = {
        "part": [part],
        "segment": [number],
        "before": [before],
        "n_ids": [len(ids.values)],
        "doc_ids": [doc_ids],
        "lengths": [np.diff(ids.starts)],
        "ranked": [table.tobytes()],
        "control": [control],
        "data": [data],
    }
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    kinds += [pa.list_(pa.int64())] * 2 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(columns.values(), kinds)], list(columns)
    )


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of every text, each document closed by ``end_id``, to ``path``.

    Documents stand in ascending order of doc_id, null ids first; rows that share
    an id follow the hash of their text. Null and empty texts are the end id alone.
    Columns other than doc_id and text are not read. No documents make no segment.
    """

    def write(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, before, number = TaskContext.get().partitionId(), 0, 0
        for batch, texts in slices(batches):
            found = encode.encode(texts)
            counts = np.diff(found.starts)
            ids = np.insert(found.values.astype(np.uint32), found.starts[1:], end_id)
            starts = found.starts + np.arange(len(counts) + 1)
            segment = Ragged(ids, starts)
            yield _segment(part, number, before, segment, batch.column("doc_id").to_pylist())
            number, before = number + 1, before + len(ids)

    read = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string"),
        F.xxhash64("text").alias("digest"),
    )
    ordered = read.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    ordered.select("doc_id", "text").mapInArrow(write, SEGMENT).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (unsigned 32-bit
    little-endian) of every document in files of ``write_ids``."""
    stored = spark.read.schema(SEGMENT).parquet(path)
    # One sum for each task that wrote: as many as the driver has tasks anyway.
    sums = stored.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).collect()
    firsts, total = {}, 0
    for row in sorted(sums, key=lambda row: row.part):
        firsts[row.part] = total
        total += row.n_ids
    part_starts = spark.sparkContext.broadcast(firsts)

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ranks = unpack(row["control"], row["data"], row["n_ids"])
                ids = np.frombuffer(row["ranked"], "<u4")[ranks].astype("<u4")
                starts = np.zeros(len(row["lengths"]) + 1, np.int64)
                np.cumsum(row["lengths"], out=starts[1:])
                first = part_starts.value[row["part"]] + row["before"]
                offsets = pa.py_buffer((4 * starts).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(first + starts[:-1]),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(starts) - 1, [None, offsets, pa.py_buffer(ids)]
                        ).cast(pa.binary()),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return stored.mapInArrow(read, "doc_id bigint, start bigint, ids binary")
