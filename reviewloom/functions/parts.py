"""Arrow batches in small parts, for Python calls that turn values into objects."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

# Texts become Python objects of up to four times their bytes, and a batch may have 64 MB.
PART_BYTES = 1 << 20


def parts(batches: Iterable[pa.Array], most_bytes: int = PART_BYTES) -> Iterator[pa.Array]:
    """All batches in order, as slices of at most so many bytes or of one row."""
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            if len(part) <= 1 or part.nbytes <= most_bytes:
                yield part
            else:
                half = len(part) // 2
                waiting += [part.slice(half), part.slice(0, half)]
