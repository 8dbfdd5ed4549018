"""Texts of Arrow batches as arrays of numbered words.

Python loops touch each distinct word of a slice once; everything that is
counted by occurrence stays in numpy.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text of so many bytes is worked on at once; a longer single text is one slice.
SLICE_BYTES = 12 << 20


class Split(NamedTuple):
    """Parts of several texts: ``codes[starts[i]:starts[i + 1]]`` are text i's
    parts as positions in ``parts``, the distinct ones."""

    codes: np.ndarray
    starts: np.ndarray
    parts: list[str]


def worker_state(owner: str) -> dict:
    """A dictionary that a worker process keeps between tasks, whatever is unpickled in it.

    It belongs to one kind of work: what another kind has left is dropped, so that a
    worker that lives through several stages holds the caches of one.
    """
    name = "_reviewloom_worker_state"
    state = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("state", {})
    if state.get("owner") != owner:
        state.clear()
        state["owner"] = owner
    return state


def slices(
    batches, column: str = "text", size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches with their texts; a null text is the empty one."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        if len(texts) == 0:
            continue
        ends = np.cumsum(np.diff(offsets_of(texts)))
        first = 0
        while first < len(texts):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(first, last - first), texts.slice(first, last - first)
            first = last


def offsets_of(texts: pa.Array) -> np.ndarray:
    """Byte offsets of a large_string array, a slice included."""
    found = np.frombuffer(texts.buffers()[1], np.int64)
    return found[texts.offset : texts.offset + len(texts) + 1]


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(offsets_of(texts))


def numbered(lists: pa.Array) -> Split:
    flat = lists.flatten().dictionary_encode()
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=starts[1:])
    return Split(flat.indices.to_numpy(zero_copy_only=False), starts, flat.dictionary.to_pylist())


def split_spaces(texts: pa.Array) -> Split:
    """Parts between single spaces; two spaces in a row have an empty part between them."""
    return numbered(pc.split_pattern(texts, " "))


class Ragged(NamedTuple):
    """Rows of different lengths: ``values[starts[i]:starts[i + 1]]`` is row i."""

    values: np.ndarray
    starts: np.ndarray

    def take(self, rows: np.ndarray) -> Ragged:
        lengths = np.diff(self.starts)[rows]
        starts = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(lengths, out=starts[1:])
        places = np.repeat(self.starts[:-1][rows] - starts[:-1], lengths)
        places += np.arange(starts[-1])
        return Ragged(self.values[places], starts)


def ragged(pieces: list[bytes], kind) -> Ragged:
    width = np.dtype(kind).itemsize
    starts = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) // width, out=starts[1:])
    return Ragged(np.frombuffer(b"".join(pieces), kind), starts)
