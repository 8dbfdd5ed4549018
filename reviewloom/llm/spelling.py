"""Spelling variants: words one edit apart, found by products of letter counts.

Words of one length are dealt into blocks. One edit changes the letter counts of a word by
one step (a letter more or less) or two (one letter for another): a squared distance of 1
or 2. A product of two blocks' letter counts gives all their squared distances at once;
pairs of at most two are compared letter by letter. Blocks meet only if they are of equal
or adjacent lengths and if the ranges of their counts leave such a pair open, which is
known before any word moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.tables import Workspace

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Of the runs in documents, one in so many loses a letter.
DELETE_ONE_IN = 199
LEAST_LETTERS = 6
LEAST_OCCURRENCES = 5
# A form occurs so many times as often as its variant.
FORM_FACTOR = 5
# Words of a block, which moves as one row, and of a part of it, which a product takes;
# letters of a block with long words.
BLOCK, PART = 4096, 256
BLOCK_LETTERS = 1 << 20
# Letters by whose counts words are put in order.
COMMON = "eainorst"
PAIRS_PER_TASK = 32
# Parts of decoded blocks that a task keeps, in letters.
KEPT_LETTERS = 1 << 23

BLOCKS = "block bigint, length int, low binary, high binary, letters binary, n binary"
LINKS = "word string, n bigint, other string, other_n bigint"


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """``run`` of every occurrence: the maximal runs of at least so many letters, A to Z
    lower-case, some of them without one letter by the checksum of doc_id and run."""
    pattern = F.lit(f"{LETTERS}{{{least},}}+")
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), pattern, F.lit(0))).alias("run"),
    )
    lower = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    sums = lower.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("sum"))
    place = (F.col("sum") % F.char_length("run")).cast("int")
    without = F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run"))
    )
    return sums.select(
        F.when(F.col("sum") % DELETE_ONE_IN == 0, without).otherwise(F.col("run")).alias("run")
    )


def counted_words(docs: DataFrame) -> DataFrame:
    """word and n of the runs with enough letters that occur often enough."""
    long = runs(docs, LEAST_LETTERS).where(F.char_length("run") >= LEAST_LETTERS)
    counts = long.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEAST_OCCURRENCES)


def letter_numbers(letters: bytes, length: int) -> np.ndarray:
    """Letters of words of one length, a row each, by number: a to z, then from U+00C0 on."""
    codes = np.frombuffer(letters, np.uint8).reshape(-1, length)
    return np.where(codes >= 0xC0, codes - (0xC0 - 26), codes - ord("a")).astype(np.uint8)


def letter_counts(numbers: np.ndarray) -> np.ndarray:
    """How often each of the 90 letters stands in each word."""
    rows = np.repeat(np.arange(len(numbers)) * 90, numbers.shape[1])
    found = np.bincount(rows + numbers.ravel(), minlength=len(numbers) * 90)
    # Squares stay exact in the shorter kind of number up to words of 2,000 letters.
    return found.reshape(-1, 90).astype(np.float32 if numbers.shape[1] <= 2000 else np.float64)


def apart(low_a, high_a, low_b, high_b) -> np.ndarray:
    """The least squared distance that ranges of counts leave open."""
    gaps = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    return (gaps * gaps).sum(axis=-1)


def within_two(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b of all rows with a squared distance of at most two.

    One product of blocks has all distances: |a|^2 + |b|^2 - 2ab, the squares as columns.
    """
    both = a.any(axis=0) & b.any(axis=0)
    ones = [np.ones((len(x), 1), x.dtype) for x in (a, b)]
    squares = [(x * x).sum(axis=1, keepdims=True) for x in (a, b)]
    left = np.hstack([-2 * a[:, both], squares[0], ones[0]])
    right = np.hstack([b[:, both], ones[1], squares[1]])
    return np.nonzero(left @ right.T <= 2)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters, those of b as long or one letter longer, are one edit apart."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    # Up to the added letter both agree, and after it with one place between them.
    unlike = a != b[:, :length]
    head = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length)
    shifted = (a != b[:, 1:])[:, ::-1]
    tail = np.where(shifted.any(axis=1), shifted.argmax(axis=1), length)
    return head + tail >= length


def blocks(words: DataFrame) -> DataFrame:
    """Rows of BLOCKS: words of one length, neighbours in the order of their commonest
    letters, with the least and the largest count of every letter."""
    # Words with much the same letters come together, so that few blocks can meet.
    counts = [
        (F.char_length("word") - F.char_length(F.replace("word", F.lit(x), F.lit("")))).alias(f"_{x}")
        for x in COMMON
    ]
    keyed = words.select("word", "n", F.char_length("word").alias("length"), *counts)
    keys = ["length", *[f"_{x}" for x in COMMON], "word"]

    def cut(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            first = 0
            while first < len(lengths):
                length = int(lengths[first])
                last = int(np.searchsorted(lengths, length, "right"))
                last = min(last, first + max(1, min(BLOCK, BLOCK_LETTERS // length)))
                part = batch.slice(first, last - first)
                letters = "".join(part.column("word").to_pylist()).encode("latin-1")
                counts = letter_counts(letter_numbers(letters, length)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([length], pa.int32()),
                        pa.array([counts.min(0).tobytes()]),
                        pa.array([counts.max(0).tobytes()]),
                        pa.array([letters]),
                        pa.array([part.column("n").to_numpy().tobytes()]),
                    ],
                    [field.split()[0] for field in BLOCKS.split(", ")],
                )
                number, first = number + 1, last

    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select("word", "n", "length").mapInArrow(cut, BLOCKS)


def meetings(held: DataFrame) -> DataFrame:
    """Pairs (a, b) of block numbers of equal or adjacent lengths, each pair once, whose
    ranges of counts leave a squared distance of two open. Only ranges move."""
    ranges = held.select("block", "length", "low", "high")
    one = ranges.select(
        F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
        F.explode(F.array("length", F.col("length") + 1)).alias("length"),
        F.col("length").alias("own"),
    )
    other = ranges.select(
        F.col("block").alias("b"), "length", F.col("low").alias("low_b"), F.col("high").alias("high_b")
    )
    pairs = one.join(other, "length").where((F.col("own") != F.col("length")) | (F.col("a") <= F.col("b")))

    def open_(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32).reshape(-1, 90)
                for c in ("low_a", "high_a", "low_b", "high_b")
            ]
            near = pa.array(apart(*ranges) <= 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"]
            )

    narrow = pairs.select("a", "b", "low_a", "high_a", "low_b", "high_b")
    return narrow.mapInArrow(open_, "a bigint, b bigint")


class Block:
    """A block's words as numbers and counts, with the ranges of its parts."""

    def __init__(self, letters: bytes, n: bytes, length: int):
        self.letters, self.length = letters, length
        self.n = np.frombuffer(n, np.int64)
        self.numbers = letter_numbers(letters, length)
        self.counts = letter_counts(self.numbers)
        starts = np.arange(0, len(self.n), PART)
        self.low = np.minimum.reduceat(self.counts, starts)
        self.high = np.maximum.reduceat(self.counts, starts)

    def words(self, places: np.ndarray) -> pa.Array:
        rows = np.frombuffer(self.letters, np.uint8).reshape(-1, self.length)[places]
        text, length = rows.tobytes().decode("latin-1"), self.length
        return pa.array([text[i : i + length] for i in range(0, len(text), length)], pa.string())


def block_links(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of two blocks that are one edit apart, each pair once."""
    near = apart(a.low[:, None], a.high[:, None], b.low[None], b.high[None]) <= 2
    found = []
    for i, j in np.argwhere(np.triu(near) if same else near).tolist():
        left, right = within_two(*(x.counts[k * PART : (k + 1) * PART] for x, k in ((a, i), (b, j))))
        left, right = left + i * PART, right + j * PART
        if same and i == j:
            left, right = left[left < right], right[left < right]
        edits = one_edit(a.numbers[left], b.numbers[right])
        found.append((left[edits], right[edits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _compare(batches) -> Iterator[pa.RecordBatch]:
    kept: dict[int, Block] = {}
    for row in (r for batch in batches for i in range(len(batch)) for r in batch.slice(i, 1).to_pylist()):
        if sum(len(x.letters) for x in kept.values()) > KEPT_LETTERS:
            kept.clear()
        for side, more in (("a", 0), ("b", row["longer"])):
            if row[side] not in kept:
                kept[row[side]] = Block(row[f"letters_{side}"], row[f"n_{side}"], row["length"] + more)
        a, b = kept[row["a"]], kept[row["b"]]
        left, right = block_links(a, b, row["a"] == row["b"])
        one, other = (a.words(left), pa.array(a.n[left])), (b.words(right), pa.array(b.n[right]))
        # Both directions, so that a word's links are in one place.
        for columns in ([*one, *other], [*other, *one]):
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in LINKS.split(", ")])


def near_words(words: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows of LINKS: every pair of words one edit apart, in both directions."""
    held = workspace.keep(blocks(words), "blocks")
    pairs = workspace.keep(meetings(held), "meetings")
    # Pairs are little to read and much to work on: so many to a task.
    tasks = pairs.count() // PAIRS_PER_TASK + 1
    for side in "ab":
        named = held.select(
            F.col("block").alias(side), F.col("length").alias(f"length_{side}"),
            F.col("letters").alias(f"letters_{side}"), F.col("n").alias(f"n_{side}"),
        )
        pairs = pairs.repartition(tasks, side).join(named, side)
    met = pairs.select(
        "a", "b", F.col("length_a").alias("length"), (F.col("length_b") - F.col("length_a")).alias("longer"),
        "letters_a", "n_a", "letters_b", "n_b",
    )
    return met.mapInArrow(_compare, LINKS)


def roots(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """word and root of (word, form): the end of each chain, by doubling steps. Chains end,
    as a form occurs more often than its word."""
    found, turn = forms.select("word", F.col("form").alias("root")), 0
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = workspace.keep(
            found.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            f"roots_{turn}",
        )
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found, turn = found.select("word", "root"), turn + 1


def spelling_variants(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of ``docs`` (doc_id and text).

    A form is the most frequent word one edit away (ties: the first in code-point order),
    if it occurs five times as often as the word; root is the end of the chain of forms.
    A null text has no words, and a null doc_id is the empty text before the colon of the
    checksum. Rows count each time they are repeated; other columns are not read.
    """
    words = workspace.keep(counted_words(docs), "words")
    links = workspace.keep(near_words(words, workspace), "links")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other"))).alias("best")
    near = links.groupBy("word").agg(F.count("*").alias("n_near"), best)
    judged = words.join(near, "word", "left").withColumn(
        "leads", -F.col("best.rank") >= FORM_FACTOR * F.col("n")
    )
    judged = workspace.keep(
        judged.select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("leads"), F.col("best.other")).alias("form"),
            F.when(F.col("leads"), -F.col("best.rank")).alias("form_n"),
        ),
        "judged",
    )
    ends = roots(judged.where("form is not null"), workspace)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

