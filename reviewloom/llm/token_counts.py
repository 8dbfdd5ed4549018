"""Token counts by a two-tier lookup of pre-token lengths, without moving a pre-token.

Tier one is a compact hash table of frequent pre-tokens and their lengths in tokens,
made from a sample of documents, of fixed size, and broadcast; tier two is a cache in
each worker. What neither knows is encoded. The table decides only how fast a length is
found: every whole text is counted exactly.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import byte_lengths, slices, split_spaces, worker_state
from reviewloom.llm.encoders import BYTE_PATTERN, PLAIN_BELOW, Encoder, encoder
from reviewloom.llm.tables import hash_sample

# The first tier: so many pre-tokens at most, in twice as many slots of 17 bytes, from
# about so many documents.
TABLE_PRE_TOKENS = 65_536
TABLE_BITS = 17
SAMPLE_DOCUMENTS = 4_000
SAMPLE_TASKS = 8
# Pre-tokens of more bytes have no slot.
SLOT_BYTES = 16
# The second tier, per worker. Longer pre-tokens are encoded each time.
CACHED_PRE_TOKENS = 200_000
LONGEST_KEPT = 64

_BYTE_PRE_TOKENS = regex.compile(BYTE_PATTERN)


class LengthTable(NamedTuple):
    """A hash table with open addressing: a pre-token's bytes, padded with zeros to two
    words, stand in the first free slot from its home on. A slot of length 0 is free."""

    keys: np.ndarray
    lengths: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The length of each key, 0 where it has no slot."""
        found = np.zeros(len(keys), np.int64)
        slots, open_ = homes(keys), np.arange(len(keys))
        while len(open_):
            at = slots[open_]
            taken = self.lengths[at] > 0
            equal = taken & (self.keys[at] == keys[open_]).all(1)
            found[open_[equal]] = self.lengths[at[equal]]
            open_ = open_[taken & ~equal]
            slots[open_] = (slots[open_] + 1) % len(self.lengths)
        return found


def homes(keys: np.ndarray) -> np.ndarray:
    mixed = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed = (mixed + keys[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def slot_keys(pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two words for each pre-token, and whether they tell all of it: neither a longer
    one nor one that ends in a zero byte can have a slot."""
    coded = [x.encode() for x in pre_tokens]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    padded = np.array(coded, f"S{SLOT_BYTES}").reshape(-1)
    whole = np.char.str_len(padded) == sizes
    return padded.view(np.uint64).reshape(-1, 2), whole


def length_table(pre_tokens: list[str], lengths: np.ndarray) -> LengthTable:
    """The table of at most half as many distinct pre-tokens as it has slots."""
    keys, whole = slot_keys(pre_tokens)
    keys, lengths = keys[whole], np.asarray(lengths)[whole]
    size = 1 << TABLE_BITS
    table = LengthTable(np.zeros((size, 2), np.uint64), np.zeros(size, np.uint8))
    slots, open_ = homes(keys), np.arange(len(keys))
    while len(open_):
        # Of those that want a free slot the first has it; all others go on by one.
        free = open_[table.lengths[slots[open_]] == 0]
        at, first = np.unique(slots[free], return_index=True)
        table.keys[at], table.lengths[at] = keys[free[first]], lengths[free[first]]
        open_ = np.setdiff1d(open_, free[first], assume_unique=True)
        slots[open_] = (slots[open_] + 1) % size
    return table


def pre_tokens(encode: Encoder, text: str) -> list[str]:
    """The pre-tokens of a text without special strings. One with characters on which
    libraries may differ is left whole, for the tokenizer library to part."""
    if max(text) >= PLAIN_BELOW:
        return [text]
    if encode.words:
        return encode.pre_tokens(text)
    return [text] if text[1:].isalpha() and text[0] == " " else _BYTE_PRE_TOKENS.findall(text)


def token_length(encode: Encoder, pre_token: str) -> int:
    if max(pre_token) >= PLAIN_BELOW:
        return len(encode.by_library(pre_token)) // 2
    if encode.words:
        return len(encode.word_ids(pre_token))
    return len(encode.merge.encode_single_piece(pre_token.encode()))


def _odd(part: str) -> bool:
    """Whether the tokens of a part depend on more than the space before it."""
    return not part or "<|" in part or part[0].isspace() or part[-1].isspace()


def _unit(encode: Encoder, part: str) -> str:
    """A part as it stands in a text, behind a space; words know none."""
    return part if encode.words else " " + part


def frequent_lengths(docs: DataFrame, path: str) -> LengthTable:
    """The table of the most frequent pre-tokens of parts that follow a space.

    Each of a fixed number of tasks returns its most frequent pre-tokens as one row; the
    driver adds up these few bounded rows.
    """

    def most_common(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        counts: Counter[str] = Counter()
        for _, texts in slices(batches):
            split = split_spaces(texts)
            each = np.bincount(split.codes, minlength=len(split.parts)).tolist()
            for part, n in zip(split.parts, each):
                if not _odd(part):
                    for found in pre_tokens(encode, _unit(encode, part)):
                        if len(found) <= SLOT_BYTES:
                            counts[found] += n
        top = counts.most_common(TABLE_PRE_TOKENS)
        yield pa.RecordBatch.from_pydict(
            {"pre_token": [[p for p, _ in top]], "n": [[n for _, n in top]]},
            pa.schema([("pre_token", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]),
        )

    sample = hash_sample(docs.select("doc_id", "text"), SAMPLE_DOCUMENTS, "doc_id")
    spread = sample.repartition(SAMPLE_TASKS, F.xxhash64("doc_id"), F.xxhash64("text"))
    counts: Counter[str] = Counter()
    for row in spread.mapInArrow(most_common, "pre_token array<string>, n array<bigint>").collect():
        for pre_token, n in zip(row.pre_token, row.n):
            counts[pre_token] += n
    kept = sorted(counts, key=lambda x: (-counts[x], x))[:TABLE_PRE_TOKENS]
    encode = encoder(path)
    return length_table(kept, np.array([token_length(encode, x) for x in kept], np.uint8))


class Lengths:
    """Lengths in tokens of pre-tokens: from the table, else the cache, else encoded."""

    def __init__(self, encode: Encoder, table: LengthTable, cache: dict[str, int]):
        self.encode, self.table, self.cache = encode, table, cache

    def _missed(self, pre_token: str) -> int:
        found = self.cache.get(pre_token)
        if found is None:
            found = token_length(self.encode, pre_token)
            if len(self.cache) < CACHED_PRE_TOKENS and len(pre_token) <= LONGEST_KEPT:
                self.cache[pre_token] = found
        return found

    def of_units(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit; each distinct pre-token of them is looked up once."""
        parted = [pre_tokens(self.encode, unit) for unit in units]
        numbers: dict[str, int] = {}
        flat = itertools.chain.from_iterable(parted)
        codes = np.array([numbers.setdefault(x, len(numbers)) for x in flat], np.int64)
        distinct = list(numbers)
        keys, whole = slot_keys(distinct)
        lengths = np.where(whole, self.table.find(keys), 0)
        for i in np.flatnonzero(lengths == 0).tolist():
            lengths[i] = self._missed(distinct[i])
        ends = np.cumsum(np.fromiter(map(len, parted), np.int64, len(parted)))
        before = np.concatenate([[0], np.cumsum(lengths[codes])])
        return np.diff(before[np.concatenate([[0], ends])])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row with columns doc_id and text.

    A null text counts as the empty one: no bytes, no tokens. Rows are counted one
    by one, so that repeated rows and repeated or null ids are kept as they are;
    other columns are not read. Special strings inside texts count as the single
    token that the library makes of them.
    """
    # A plain tuple: a class of this package would have to be there to be unpickled.
    table = docs.sparkSession.sparkContext.broadcast(tuple(frequent_lengths(docs, path)))

    def count(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        cache = worker_state("tokens").setdefault(f"lengths {path}", {})
        lengths = Lengths(encode, LengthTable(*table.value), cache)
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(byte_lengths(texts)),
                    pa.array(_counted(encode, texts, lengths)),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    read = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return read.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def _counted(encode: Encoder, texts: pa.Array, lengths: Lengths) -> np.ndarray:
    """Tokens of each text. A text's first part has no space before it; texts with
    an odd part are encoded whole."""
    split = split_spaces(texts)
    odd = np.fromiter(map(_odd, split.parts), bool, len(split.parts))
    known = np.zeros(len(split.parts), np.int64)
    plain = np.flatnonzero(~odd)
    known[plain] = lengths.of_units([_unit(encode, split.parts[i]) for i in plain.tolist()])
    before = np.concatenate([[0], np.cumsum(known[split.codes])])
    found = before[split.starts[1:]] - before[split.starts[:-1]]
    odds = np.concatenate([[0], np.cumsum(odd[split.codes])])
    whole = odds[split.starts[1:]] > odds[split.starts[:-1]]
    if not encode.words:
        heads = split.codes[split.starts[:-1][~whole]]
        firsts, back = np.unique(heads, return_inverse=True)
        units = [split.parts[i] for i in firsts.tolist()]
        found[~whole] += (lengths.of_units(units) - known[firsts])[back]
    for i in np.flatnonzero(whole).tolist():
        found[i] = len(encode.whole(texts[i].as_py())) // 2
    return found
