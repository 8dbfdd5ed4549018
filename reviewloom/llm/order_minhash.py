"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it occurred
before: a repeated shingle is another item each time, up to LABELS times; what it says
beyond that does not count. (Without that bound, two texts that repeat one line by the
hundred would be alike, whatever else they say.) A sketch takes the few items with the
smallest hashes and keeps their order in the text, so that texts agree on it if they hold
the same items in the same order. Texts that agree on one of several sketches are
candidates. Of short texts few sketches would agree; so they are candidates also if they
share one of their rarest items, which none that are linked can miss.

In each group of candidates, a bucket, all are first compared with one of them; linked
texts become a component, and only members of different components are compared further.
Counts of the items settle most of these pairs, with no error and without the texts; an
alignment of the items within a band decides on the others.

Two texts are linked if the items they share in order are at least 0.8 of all, shared ones
counted once. Words are lower-case runs between white space; a text with fewer than five
has one shingle of all its words. Texts without words are alike. Classes are the
connected components of links and equal texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.arrow_text import slices, worker_state
from reviewloom.llm.tables import Workspace

SHINGLE = 5
SIMILARITY = 0.8
# Sketches of a text, and shingles in each: two long texts of similarity s agree on one of
# them with a chance of about 1 - (1 - s^8)^40, 0.9993 at 0.8. Sampling takes no shingle
# twice, so shorter ones agree less: 0.9985 at 68 of 85 shingles. With many shingles in a
# sketch, texts that only share a passage seldom meet: those of which the passage is
# a half do in one sketch of 250.
SKETCHES = 40
SAMPLED = 8
# Occurrences of a shingle that count.
LABELS = 4
# Short texts have at most so many items; all their links are found. Texts that are up to
# a link longer can be their partners.
EXACT = 64
PARTNERS = EXACT * 5 // 4
# Hashes of a text are made for so many shingles and sketches at once.
HASHED_AT_ONCE = 1 << 19
# Members of a bucket that are compared at once, by their counts.
BLOCK = 256
# Texts that are aligned with one other text in a task.
ALIGNED_AT_ONCE = 512
# Pairs of a text and a component that are aligned at first; more, if none is a link.
TRIED_FIRST = 4
# Words whose hashes a worker keeps, and how long they may be.
CACHED_WORDS, LONGEST_KEPT = 200_000, 64
# Text that is taken apart at a time.
SLICE_BYTES = 4 << 20
# Bins of a text's counts to an item, and the fewest: with so many, two texts' counts differ
# by little less than their items do.
BINS_PER_ITEM = 2
LEAST_BINS = 64

_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, (2, SKETCHES), np.int64).astype(np.uint64)
_SEEDS[1] |= np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LABEL = np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Hashes of words, those of the first many words of a worker at hand."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS and len(word) <= LONGEST_KEPT:
            self[word] = found
        return found


def shingles(text: str, hashes: dict) -> np.ndarray:
    """Hashes of the text's labelled shingles in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    coded = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(coded) - SHINGLE + 1)
    found = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(coded))):
        found = (found ^ coded[i : i + n]) * _MIX
        found ^= found >> np.uint64(29)
    labels = occurrences(found)
    if labels is None:
        return found
    # Another item for each label; the first one is the shingle itself.
    items = found + labels.astype(np.uint64) * _LABEL
    items[labels > 0] ^= items[labels > 0] >> np.uint64(31)
    items[labels > 0] *= _MIX
    return items[labels < LABELS]


def occurrences(found: np.ndarray) -> np.ndarray | None:
    """How often each shingle occurred before; None if none did."""
    order = np.argsort(found, kind="stable")
    ordered = found[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    if new.all():
        return None
    places = np.arange(len(found))
    earlier = np.empty(len(found), np.int64)
    earlier[order] = places - np.maximum.accumulate(np.where(new, places, 0))
    return earlier


def sketch(items: np.ndarray) -> np.ndarray:
    """SKETCHES hashes, each of the SAMPLED smallest items in text order, of all items where
    there are fewer; one that is the same for all texts without items."""
    if not len(items):
        return np.zeros(1, np.int64)
    if len(items) <= SAMPLED:
        # All sketches would be alike.
        return _sketches(items, *_SEEDS[:, :1])
    step = max(1, HASHED_AT_ONCE // len(items))
    return np.concatenate(
        [_sketches(items, *_SEEDS[:, i : i + step]) for i in range(0, SKETCHES, step)]
    )


def _sketches(items: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    hashed = (items ^ flips[:, None]) * factors[:, None]
    hashed ^= hashed >> np.uint64(32)
    size = min(SAMPLED, len(items))
    places = np.sort(np.argpartition(hashed, size - 1, axis=1)[:, :size], axis=1)
    result = np.zeros(len(flips), np.uint64)
    for column in places.T:
        result = (result ^ items[column]) * _MIX
        result ^= result >> np.uint64(29)
    return result.view(np.int64)


def common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence of shingles among alignments that stay
    within ``band`` of the diagonal; exact if the best one does.

    One bit per place of the band in a whole number; rows are taken in blocks, between
    which the window of places moves along.
    """
    a, b = a.tolist(), b.tolist()
    step = max(64, band)
    matched, low, high = 0, 0, 0
    row = 0
    for top in range(0, len(b), step):
        bottom = min(top + step, len(b))
        first, last = max(0, top - band), min(len(a), bottom + band + 1)
        if first >= len(a):
            break
        # Places left behind keep what they have; new ones come in unmatched.
        gone = max(0, first - low)
        if gone:
            matched += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
        low = first
        if last > high:
            row |= ((1 << (last - high)) - 1) << (high - low)
            high = last
        places: dict[int, int] = {}
        for i in range(low, high):
            places[a[i]] = places.get(a[i], 0) | 1 << (i - low)
        full = (1 << (high - low)) - 1
        for j in range(top, bottom):
            hits = row & places.get(b[j], 0)
            if hits:
                row = ((row + hits) | (row - hits)) & full
    return matched + (high - low) - row.bit_count()


def counts(found: np.ndarray) -> bytes:
    """Items in each of a power of two of bins, a byte each (255 stands for more)."""
    bins = LEAST_BINS
    while bins < BINS_PER_ITEM * len(found):
        bins *= 2
    places = (found >> np.uint64(32)) & np.uint64(bins - 1)
    return np.minimum(np.bincount(places.astype(np.int64), minlength=bins), 255).astype(
        np.uint8
    ).tobytes()


def least_distances(counts: bytes, others: list[bytes]) -> np.ndarray:
    """What the distances of a text to others are at least, by their counts."""
    own = np.frombuffer(counts, np.uint8).astype(np.int64)
    found = np.zeros(len(others), np.int64)
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    for size in np.unique(sizes).tolist():
        # Bins of the longer one are those of the shorter one, each in several.
        bins = min(size, len(own))
        here = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join(others[i] for i in here.tolist()), np.uint8)
        rows = rows.reshape(len(here), -1, bins).sum(1, dtype=np.int64)
        found[here] = np.abs(rows - own.reshape(-1, bins).sum(0)).sum(1)
    return found


def link_limit(n: int) -> float:
    """The largest distance (shingles not shared, of n in both texts) of a link."""
    return n * (1 - SIMILARITY) / (1 + SIMILARITY)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the items outside the best alignment are few enough for a link."""
    limit = link_limit(len(a) + len(b)) + 1e-6
    if abs(len(a) - len(b)) > limit:
        return False
    # Equal ends are part of a best alignment.
    head = 0
    least = min(len(a), len(b))
    if least:
        same = a[:least] == b[:least]
        head = least if same.all() else int(np.argmin(same))
        a, b = a[head:], b[head:]
        least -= head
    if least:
        same = a[::-1][:least] == b[::-1][:least]
        tail = least if same.all() else int(np.argmin(same))
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    # No alignment shares more than what both hold; items of a text are all different.
    shared = len(np.intersect1d(a, b, assume_unique=True))
    if len(a) + len(b) - 2 * shared > limit:
        return False
    return len(a) + len(b) - 2 * common(a, b, int(limit) + 1) <= limit


# Spark


SKETCHED = "doc_id bigint, digest binary, n bigint, sketch array<bigint>, short array<bigint>"
MEASURED = "node bigint, n bigint, counts binary, text string"


def _hashes() -> dict:
    return worker_state("shingles").setdefault("words", _Hashes())


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the digest of the text, its number of items, its sketches, and the items
    themselves of a text of at most PARTNERS."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for batch, texts in slices(batches, size=SLICE_BYTES):
            found = [shingles(text, hashes) for text in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array([len(x) for x in found]),
                    pa.array([sketch(x) for x in found], pa.list_(pa.int64())),
                    pa.array(
                        [x.view(np.int64) if len(x) <= PARTNERS else None for x in found],
                        pa.list_(pa.int64()),
                    ),
                ],
                [field.split()[0] for field in SKETCHED.split(", ")],
            )

    return docs.mapInArrow(run, SKETCHED)


def distinct_texts(named: DataFrame, workspace: Workspace) -> DataFrame:
    """A row per distinct text: node (a number), first_id, and what is sketched of it."""
    nodes = sketch_documents(named).groupBy("digest").agg(
        F.min("doc_id").alias("first_id"),
        *[F.first(c).alias(c) for c in ("n", "sketch", "short")],
    )
    # Numbered as it is written: from then on a text has one number.
    return workspace.keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def rare_entries(nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """bucket and node: short texts by the rarest of their items, for pairs of which
    one has at most EXACT.

    Linked texts share 4/5 of the items of each at least. So, whatever order all
    items stand in, the first n // 5 + 1 of each text have one in common. In the order
    of their frequency these are seldom those of a common passage; an item of one text
    only comes before all others and meets none.
    """
    held = nodes.select("node", "n", F.explode("short").alias("item"))
    often = held.groupBy("item").agg(F.count("*").alias("often")).where("often > 1")
    # Stored, so that Spark can split the join at an item that many texts have.
    often = workspace.keep(often, "often")
    listed = (
        held.join(often, "item")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("listed"))
    )
    # n - size of the items are in this text only.
    room = F.col("n") - F.col("n") % 5
    room = (room / 5 + 1 - (F.col("n") - F.size("listed"))).cast("int")
    first = listed.where(room > 0).select("node", F.explode(F.slice("listed", 1, room)).alias("x"))
    return first.select(F.xxhash64(F.lit("rare"), "x.item").alias("bucket"), "node")


def candidate_buckets(nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """bucket, leader (its smallest node) and node, for buckets of two texts or more."""
    entries = nodes.select("node", F.posexplode("sketch").alias("number", "value")).select(
        F.xxhash64("number", "value").alias("bucket"), "node"
    )
    # Stored: leaders and members are both made of them.
    entries = entries.union(workspace.keep(rare_entries(nodes, workspace), "rare"))
    ends = entries.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    leaders = workspace.keep(ends.where("leader != last").select("bucket", "leader"), "leaders")
    # A join that Spark can split at a large bucket, and the same at every size.
    return workspace.keep(entries.join(leaders.hint("merge"), "bucket").distinct(), "members")


def measured_texts(named: DataFrame, nodes: DataFrame, members: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows of MEASURED of all texts that are in a bucket: the one time that texts are
    looked up among all documents.

    One row has each text: one with the smallest of its ids, found by the id, so that a
    text with many copies is not gathered.
    """
    needed = nodes.join(members.select("node").distinct(), "node").select(
        "node", F.col("first_id").alias("doc_id"), F.col("digest").alias("wanted")
    )
    needed = workspace.keep(needed, "needed").hint("merge")
    found = named.join(needed, "doc_id").where(F.col("digest") == F.col("wanted"))
    # Partitioned by doc_id already.
    once = found.dropDuplicates(["doc_id", "node"]).select("node", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for batch, texts in slices(batches, size=SLICE_BYTES):
            items = [shingles(text, hashes) for text in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([counts(x) for x in items], pa.binary()),
                    batch.column("text"),
                ],
                [field.split()[0] for field in MEASURED.split(", ")],
            )

    return workspace.keep(once.mapInArrow(run, MEASURED), "texts")


class Links:
    """Finds components of linked texts, of which ``texts`` has rows of MEASURED."""

    def __init__(self, texts: DataFrame, workspace: Workspace):
        self.texts, self.workspace, self.written = texts, workspace, 0

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        self.written += 1
        return self.workspace.keep(frame, f"{name}_{self.written}")

    def sifted(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that lengths and counts leave open, with the least distance."""
        for x in "ab":
            pairs = pairs.join(
                self.texts.select(F.col("node").alias(x), F.col("counts").alias(f"counts_{x}"), F.col("n").alias(f"n_{x}")),
                x,
            )
        return pairs.mapInArrow(_sift, "a bigint, b bigint, least bigint")

    def aligned(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) of a stored table that are links.

        Texts are brought to the texts they are compared with, b; one that many are
        compared with is brought to several tasks.
        """
        shares = F.expr(f"cast(ceil(n / {ALIGNED_AT_ONCE}) as int)")
        sizes = self.keep(
            pairs.groupBy("b").agg(F.count("*").alias("n")).select("b", shares.alias("shares")), "sizes"
        )
        members = pairs.join(sizes, "b").select(
            F.col("a").alias("node"), "b", F.pmod(F.xxhash64("a"), "shares").cast("int").alias("share"), F.lit(1).alias("turn")
        )
        leaders = sizes.select(
            F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
            F.lit(0).alias("turn"),
        )
        wanted = self.keep(members.union(leaders), "wanted")
        found = self.texts.select("node", "text").join(wanted, "node")
        placed = found.select("b", "share", "turn", "node", "text").repartition("b", "share")
        ordered = placed.sortWithinPartitions("b", "share", "turn", "node")
        return self.keep(ordered.mapInArrow(_align, "a bigint, b bigint").distinct(), "links")

    def rooted(self, rows: DataFrame, roots: DataFrame | None, node: str, root: str) -> DataFrame:
        """Adds the root of a node, itself where it has no link."""
        if roots is None:
            return rows.withColumn(root, F.col(node))
        named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        joined = rows.join(named, node, "left")
        return joined.withColumn(root, F.coalesce("_root", node)).drop("_root")

    def merged(self, roots: DataFrame | None, links: DataFrame) -> DataFrame:
        """Roots after more links: these join components, not texts."""
        ends = self.rooted(self.rooted(links, roots, "a", "root_a"), roots, "b", "root_b")
        found = self.components(ends.where("root_a != root_b").select("root_a", "root_b"))
        if roots is None:
            return found
        both = self.rooted(roots.withColumnRenamed("root", "was"), found, "was", "root").select("node", "root")
        return self.keep(both.union(found.join(roots, "node", "left_anti")), "roots")

    def components(self, links: DataFrame) -> DataFrame:
        """node and root, the smallest node of its component, for all nodes in links.

        Every node takes its smallest neighbour for a parent, if that is smaller; parents
        are followed to the end by doubling steps, and what is left of the links
        joins the trees. Trees at least halve each time.
        """
        edges, roots = self.keep(links.toDF("node", "other").union(links.select(links.columns[::-1]).toDF("node", "other")).distinct(), "edges"), None
        while not edges.isEmpty():
            parents = edges.groupBy("node").agg(F.min("other").alias("root"))
            tops = self.followed(self.keep(parents.select("node", F.least("node", "root").alias("root")), "parents"))
            if roots is None:
                roots = tops
            else:
                roots = self.keep(self.rooted(roots.withColumnRenamed("root", "was"), tops, "was", "root").select("node", "root"), "roots")
            ends = self.rooted(self.rooted(edges, tops, "node", "x"), tops, "other", "y")
            edges = self.keep(ends.where("x != y").select(F.col("x").alias("node"), F.col("y").alias("other")).distinct(), "edges")
        if roots is None:
            return edges.select("node", F.col("other").alias("root"))
        return roots

    def followed(self, found: DataFrame) -> DataFrame:
        while True:
            above = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = self.keep(
                found.join(above, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")),
                "tops",
            )
            if found.where("moved").isEmpty():
                return found.select("node", "root")
            found = found.select("node", "root")

    def find(self, members: DataFrame) -> DataFrame:
        """node and root of all nodes that are linked with another.

        First each text is compared with the leader it meets in most buckets, then with
        the leaders of all its buckets that are in other components, and then with
        the members that are; of these a few for each text and component at a time.
        """
        met = members.where("node != leader").groupBy("node", "leader").agg(F.count("*").alias("times"))
        best = F.max(F.struct("times", (-F.col("leader")).alias("last"))).alias("best")
        star = met.groupBy("node").agg(best).select(F.col("node").alias("a"), (-F.col("best.last")).alias("b"))
        tried = self.keep(self.sifted(self.keep(star, "star")), "sifted")
        roots = self.merged(None, self.aligned(tried))

        apart = self.split(members, roots)
        pairs = apart.where("root != leader_root").select(F.col("node").alias("a"), F.col("leader").alias("b"))
        pairs = self.keep(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "led")
        open_ = self.keep(self.sifted(pairs), "sifted")
        roots = self.merged(roots, self.aligned(open_))
        tried = tried.union(open_)

        open_ = self.crossing(self.split(members, roots))
        open_ = self.keep(open_.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "open")
        first, size = 0, TRIED_FIRST
        while True:
            left = self.rooted(self.rooted(open_, roots, "a", "root_a"), roots, "b", "root_b")
            left = self.keep(left.where("root_a != root_b"), "left")
            if left.isEmpty():
                return roots
            nearest = Window.partitionBy("a", "root_b").orderBy("least", "b")
            tried = left.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= size)
            tried = self.keep(tried.select("a", "b", "least"), "tried")
            roots = self.merged(roots, self.aligned(tried))
            open_ = left.select("a", "b", "least").join(tried, ["a", "b"], "left_anti")
            first, size = first + size, 4 * size

    def split(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """Members, with roots, of buckets that have several components."""
        rooted = self.rooted(self.rooted(members, roots, "node", "root"), roots, "leader", "leader_root")
        rooted = self.keep(rooted, "rooted")
        several = rooted.where("root != leader_root").select("bucket").distinct()
        return self.keep(rooted.join(several, "bucket", "left_semi"), "split")

    def crossing(self, members: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of one bucket in different components that lengths and
        counts leave open.

        Members are compared in blocks: a row of a block moves once for each block of its
        bucket, not for each member. Buckets with the same members are compared once.
        """
        rows = members.where("node != leader").select("bucket", "node", "root")
        # Equal sets of members have equal marks, of 128 bits.
        marks = [F.bit_xor(F.xxhash64(F.lit(x), "node")).alias(x) for x in ("one", "two")]
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"), *marks)
        once = sizes.groupBy("size", "one", "two").agg(F.min("bucket").alias("bucket")).where("size > 1")
        parts = self.keep(
            once.select("bucket", F.expr(f"cast(ceil(size / {BLOCK}) as int)").alias("parts")), "parts"
        )
        held = self.keep(rows.join(parts, "bucket"), "held")
        # A text is in a bounded number of buckets; a pair is told by the first it shares.
        own = held.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("own"))
        placed = held.join(own, "node").join(self.texts.select("node", "n", "counts"), "node")
        placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
        one = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        # A block and another one, each pair of parts once.
        low, high = F.least("part", "other"), F.greatest("part", "other")
        met = one.select("bucket", low.alias("low"), high.alias("high"), "part", "node", "root", "n", "counts", "own")
        grouped = met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
        return grouped.mapInArrow(_cross, "a bigint, b bigint, least bigint")


def _sift(batches) -> Iterator[pa.RecordBatch]:
    """Pairs that lengths and counts leave open."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("counts_a", "counts_b", "n_a", "n_b"))
        least = np.full(len(batch), -1, np.int64)
        for i, (a, b, n_a, n_b) in enumerate(zip(*columns)):
            if abs(n_a - n_b) <= link_limit(n_a + n_b) + 1e-6:
                found = int(least_distances(a, [b])[0])
                if found <= link_limit(n_a + n_b) + 1e-6:
                    least[i] = found
        kept = pa.array(least >= 0)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).filter(kept) for c in "ab"], pa.array(least).filter(kept)], ["a", "b", "least"]
        )


def _cross(batches) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks of a bucket, or of one with itself, in different components."""
    for rows in _groups(batches, ("bucket", "low", "high")):
        part, node, root, n = (
            rows.column(c).to_numpy().astype(np.int64) for c in ("part", "node", "root", "n")
        )
        counts = rows.column("counts").to_pylist()
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        own = rows.column("own").combine_chunks()
        starts, buckets = own.offsets.to_numpy(), own.values.to_numpy()
        bucket = rows.column("bucket")[0].as_py()
        second = np.flatnonzero(part == high)
        for i in np.flatnonzero(part == low).tolist():
            fits = np.abs(n[second] - n[i]) <= (n[second] + n[i]) * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-6
            near = second[fits & (root[second] != root[i])]
            if low == high:
                near = near[node[near] < node[i]]
            if not len(near):
                continue
            least = least_distances(counts[i], [counts[j] for j in near.tolist()])
            open_ = least <= (n[near] + n[i]) * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-6
            near, least = near[open_], least[open_]
            shared = [
                np.intersect1d(buckets[starts[i] : starts[i + 1]], buckets[starts[j] : starts[j + 1]])[0]
                for j in near.tolist()
            ]
            once = np.array(shared, np.int64) == bucket
            near, least = near[once], least[once]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.maximum(node[near], node[i])),
                    pa.array(np.minimum(node[near], node[i])),
                    pa.array(least),
                ],
                ["a", "b", "least"],
            )


def _groups(batches, keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each key, which stand together; a group is of bounded size."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not len(batch):
            continue
        values = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        starts = [i for i in range(len(values)) if i == 0 or values[i] != values[i - 1]]
        for first, last in zip(starts, [*starts[1:], len(values)]):
            if held and name != values[first]:
                yield pa.Table.from_batches(held)
                held = []
            name = values[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _align(batches) -> Iterator[pa.RecordBatch]:
    hashes = _hashes()
    name, other = None, None
    for batch in batches:
        for part, texts in slices([batch], size=SLICE_BYTES):
            pairs = []
            rows = zip(*[part.column(c).to_pylist() for c in ("b", "share", "turn", "node")])
            for i, (b, share, turn, node) in enumerate(rows):
                if turn == 0:
                    if name != (b, share):
                        name, other = (b, share), shingles(texts[i].as_py(), hashes)
                elif linked(shingles(texts[i].as_py(), hashes), other):
                    pairs.append((node, b))
            columns = zip(*pairs) if pairs else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["a", "b"])


def _digest() -> F.Column:
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def near_duplicates(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """doc_id, node (the digest of its text), class_id, the smallest doc_id of its class, and
    component, a number of the class, for every row.

    A null text is the empty one. Rows with a null doc_id are in no class: class_id is
    null. Rows that repeat an id are each classed by their own text; two classes whose
    smallest id is the same one differ by their component. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    known = docs.where(F.col("doc_id").isNotNull())
    named = known.select(F.col("doc_id").cast("bigint"), text, _digest().alias("digest"))
    nodes = distinct_texts(named, workspace)
    members = candidate_buckets(nodes, workspace)
    links = Links(measured_texts(named, nodes, members, workspace), workspace)
    roots = links.find(members)
    rooted = links.keep(links.rooted(nodes.select("node", "digest", "first_id"), roots, "node", "root"), "rooted")
    smallest = links.keep(rooted.groupBy("root").agg(F.min("first_id").alias("class_id")), "classes")
    classed = links.keep(rooted.join(smallest, "root").select(F.col("digest").alias("node"), "class_id", F.col("root").alias("component")), "classed")
    rows = named.select("doc_id", F.col("digest").alias("node"))
    unnamed = docs.where(F.col("doc_id").isNull()).select(
        F.lit(None).cast("bigint").alias("doc_id"), _digest().alias("node"), *[F.lit(None).cast("bigint").alias(c) for c in ("class_id", "component")],
    )
    return rows.join(classed, "node").select("doc_id", "node", "class_id", "component").union(unnamed)


def deduplicated(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """One row of every class, one with the smallest doc_id, with all its columns.

    Where several texts of a class have that id, the one with the smallest digest stays.
    Rows with a null doc_id stay. A row that repeats the kept one's id and text goes; of
    such rows one stays.
    """
    classes = near_duplicates(docs, workspace)
    first = classes.where(F.col("doc_id") == F.col("class_id"))
    kept = first.groupBy("component").agg(F.min("node").alias("_node"), F.first("doc_id").alias("doc_id"))
    kept = workspace.keep(kept.select("doc_id", "_node"), "kept")
    named = docs.where(F.col("doc_id").isNotNull())
    joined = named.join(kept, "doc_id").where(_digest() == F.col("_node"))
    # Partitioned by doc_id already.
    once = joined.dropDuplicates(["doc_id", "_node"]).select(*docs.columns)
    return once.union(docs.where(F.col("doc_id").isNull()))
