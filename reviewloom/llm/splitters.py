"""Range partitioning into shards of near equal bytes, by sampled splitters.

Keys are sampled with a chance that follows the size of their rows; quantiles of the
sample part the keys into ranges, whose exact sizes are then summed. A shard is the range
of keys that fills seven eighths of it; what lies between two shards, its margin, is
parted again by a sample of its own, and these narrow ranges are dealt so that all shards
come out level. A range there that is overfull, as one with a hot key is, is subdivided
by a second key. Built from DataFrame functions only.

What the driver holds (sample, sums and boundaries) follows the number of shards, not
the number of rows.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.tables import Workspace

# Expected rows of a sample for each range, and ranges for each shard.
SAMPLED_PER_RANGE = 32
RANGES_PER_SHARD = 16
# The part of a shard, 1 / MARGIN, that levels sizes, and into how many its ranges are
# parted again.
MARGIN = 8
REFINED = 16
# A range of a margin is overfull if it is more than such a part of a shard, and is then
# divided into pieces of about such a part.
OVERFULL = 8
PIECE = 64
# Rows that are numbered in one task (expected number).
ROWS_AT_ONCE = 1 << 19
LOWEST = -(1 << 63)


def weighted_quantiles(sample: list[tuple[int, float]], ranges: int) -> list[int]:
    """Ascending boundaries that part the sample's weight into about so many ranges; a key
    with the weight of more than a range has one of its own."""
    total = sum(weight for _, weight in sample)
    found, passed, step = set(), 0.0, 1
    for key, weight in sorted(sample):
        passed += weight
        if passed >= step * total / ranges:
            found.add(key)
            step = int(passed * ranges / total) + 1
        if weight * ranges > total and key > LOWEST:
            found |= {key - 1, key}
    return sorted(found)


def range_of(key: Column, boundaries: list[int]) -> Column:
    """How many boundaries are below the key, by a step over groups of boundaries and
    one within the group."""
    if not boundaries:
        return F.lit(0)
    # Groups as large as their number, so that least is compared with each key.
    step = math.isqrt(len(boundaries) - 1) + 1
    groups = [boundaries[i : i + step] for i in range(0, len(boundaries), step)]
    firsts = F.lit([group[0] for group in groups])
    group = F.greatest(F.size(F.filter(firsts, lambda x: x < key)) - 1, F.lit(0))
    members = F.get(F.lit(groups), group)
    return group * step + F.size(F.filter(members, lambda x: x < key))


def bodies(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """The shard of each unit, given in order with their sizes, that lies within the body
    of one; the others touch a margin."""
    total, before, found = sum(size for _, size in sizes), 0, {}
    for unit, size in sizes:
        shard = before * shards // total
        if (before + size) * shards * MARGIN <= ((shard + 1) * MARGIN - 1) * total:
            found[unit] = shard
        before += size
    return found


def places(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """Units in order and their shards: bodies as they lie, then the others, the largest
    first, each to the emptiest shard."""
    found = bodies(sizes, shards)
    filled = [0] * shards
    for unit, size in sizes:
        if unit in found:
            filled[found[unit]] += size
    heap = [(size, shard) for shard, size in enumerate(filled)]
    heapq.heapify(heap)
    for unit, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if unit not in found:
            held, found[unit] = heapq.heappop(heap)
            heapq.heappush(heap, (held + size, found[unit]))
    return sorted(found.items())


def shard_by_bytes(rows: DataFrame, shards: int, key: str, size: str, tie: list[str]) -> DataFrame:
    """Adds ``shard`` and ``slot``, gapless from 0 within a shard.

    ``key`` is a bigint column by which rows are ranged (null keys are the lowest),
    ``size`` a positive bigint, and ``tie`` columns that tell rows of one key apart;
    they divide overfull ranges. ``rows`` should be a stored, narrow table: it is read
    several times. Columns named shard or slot are replaced. Rows that are equal in
    all these columns are interchangeable. No rows give no rows.
    """
    rows = rows.drop("shard", "slot")
    ranked = F.coalesce(F.col(key), F.lit(LOWEST))
    total, count = rows.agg(F.sum(size), F.count("*")).first()
    total = max(total or 0, 1)

    def sums(frame: DataFrame, unit: Column) -> list[tuple[int, int]]:
        found = frame.groupBy(unit.cast("bigint").alias("unit")).agg(F.sum(size).alias("size"))
        return sorted((row.unit, row["size"]) for row in found.collect())

    def sample(frame: DataFrame, wanted: int, held: int, unit: Column, salt: str) -> dict:
        """About ``wanted`` draws from rows that hold so many bytes: unit to (key, weight)."""
        # A row is drawn with the chance share; a larger one than a draw counts for as many.
        share = F.col(size) * F.lit(wanted / held)
        chance = F.pmod(F.xxhash64(*tie, F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = frame.where(chance < share).groupBy(unit.alias("unit"), ranked.alias("key"))
        found: dict = {}
        for row in drawn.agg(F.sum(F.greatest(share, F.lit(1.0))).alias("weight")).collect():
            found.setdefault(row.unit, []).append((row.key, row.weight))
        return found

    ranges = shards * RANGES_PER_SHARD
    first = sample(rows, ranges * SAMPLED_PER_RANGE, total, F.lit(0), "first")
    boundaries = weighted_quantiles(first.get(0, []), ranges)
    unit = range_of(ranked, boundaries)

    def margins() -> dict[int, int]:
        sizes = sums(rows, unit)
        held = bodies(sizes, shards)
        return {unit: size for unit, size in sizes if unit not in held}

    loose = margins()
    if loose:
        wanted = len(loose) * REFINED * SAMPLED_PER_RANGE
        inside = rows.where(unit.isin(list(loose)))
        second = sample(inside, wanted, sum(loose.values()), unit, "second")
        finer = (weighted_quantiles(drawn, REFINED) for drawn in second.values())
        boundaries = sorted(set(boundaries).union(*finer))
        unit = range_of(ranked, boundaries)
        loose = margins()
    parts = {
        end: -(-size * shards * PIECE // total)
        for end, size in loose.items()
        if size * shards * OVERFULL > total
    }
    # A unit is a range or, of an overfull one, a part by the second key.
    most = max(parts.values(), default=1)
    # The range is a column of its own, so that it is found once for each row.
    ranged, held = rows.withColumn("_range", unit.cast("bigint")), F.col("_range")
    part = F.lit(0).cast("bigint")
    for end, pieces in sorted(parts.items()):
        part = F.when(held == end, F.pmod(F.xxhash64(*tie), F.lit(pieces))).otherwise(part)
    measured = ranged.withColumn("_unit", held * F.lit(most) + part).drop("_range")
    placed = places(sums(measured, F.col("_unit")), shards)
    # The last unit of every stretch that shares a shard.
    lasts = [(u, s) for (u, s), after in zip(placed, [*placed[1:], (0, -1)]) if s != after[1]]
    shard = F.lit(0)
    if lasts:
        stretch = range_of(F.col("_unit"), [u for u, _ in lasts])
        shard = F.get(F.lit([s for _, s in lasts]), stretch)
    portion = F.pmod(F.xxhash64(*tie, F.lit("slot")), F.lit(count // ROWS_AT_ONCE + 1))
    dealt = measured.withColumns({"shard": shard, "_portion": portion}).drop("_unit")
    counts = dealt.groupBy("shard", "_portion").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_portion")) - F.col("_n")
    counts = counts.select("shard", "_portion", before.alias("_first"))
    order = Window.partitionBy("shard", "_portion").orderBy(key, *tie)
    numbered = dealt.withColumn("_place", F.row_number().over(order) - 1)
    return (
        numbered.join(counts, ["shard", "_portion"])
        .withColumn("slot", F.col("_first") + F.col("_place"))
        .drop("_portion", "_first", "_place")
    )


def shard_documents(docs: DataFrame, shards: int, workspace: Workspace) -> DataFrame:
    """doc_id, size (bytes of the text and one more), text_crc32, shard and slot.

    The key is a hash of the text, so that equal texts share a shard unless they are more
    than an eighth of one and lie in its margin. A null text has no bytes and is not equal
    to the empty one; null doc_ids are dealt like others. Rows equal in id and text are
    told apart by where they are stored, so that any number of them can be divided. Columns
    other than doc_id and text are not read.
    """
    measured = docs.select(
        F.col("doc_id").cast("bigint"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("text_key"),
    )
    stored = workspace.keep(measured, "sizes")
    # The number of the file, whose name has a random part too, and the row's in it.
    file = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    stored = stored.select("*", file.alias("file"), F.col("_metadata.row_index").alias("row"))
    tie = ["doc_id", "text_crc32", "file", "row"]
    return shard_by_bytes(stored, shards, "text_key", "size", tie).drop("text_key", "file", "row")
