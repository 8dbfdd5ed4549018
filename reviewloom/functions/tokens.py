"""Token counters. A counter maps an array of texts to an array of counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.parts import parts
from reviewloom.functions.text import word_count

TokenCounter = Callable[[Column], Column]

# Fixed value: tokens per word where no vocabulary is used.
TOKENS_PER_WORD = 1.3


def estimate_tokens(text: Column) -> Column:
    return (word_count(text).cast("double") * F.lit(TOKENS_PER_WORD)).cast("int")


def word_tokens(texts: Column) -> Column:
    """Deterministic default: words times 1.3, cut to a whole number."""
    return F.transform(texts, estimate_tokens)


def bpe_tokens(load_encoding: Callable | str = "cl100k_base") -> TokenCounter:
    """Counter on a byte-pair vocabulary; the encoder is loaded once per task.

    ``load_encoding`` is an encoding name or a function returning an object with
    ``encode``. A text the encoder cannot take, or every text where the
    vocabulary cannot be loaded, is counted by words instead.
    """
    if isinstance(load_encoding, str):
        name = load_encoding

        def load():
            import tiktoken

            return tiktoken.get_encoding(name)
    else:
        load = load_encoding

    @F.arrow_udf("array<int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            encoding = load()
        except Exception:
            encoding = None

        def tokens(text: str) -> int:
            try:
                return len(encoding.encode(text))
            except Exception:
                return int(len(text.split()) * TOKENS_PER_WORD)

        for part in parts(batches):
            counts = [
                None if texts is None else [tokens(text) for text in texts]
                for texts in part.to_pylist()
            ]
            yield pa.array(counts, pa.list_(pa.int32()))

    return count
