"""Near duplicates against brute force with shingles of its own."""

import collections
import itertools

import numpy as np
import pytest

from reviewloom.llm import order_minhash, queries
from reviewloom.llm.tables import Workspace

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, shard int, n_tokens int, node string"
LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, 0, "") for i, t in rows], SCHEMA)


def classes(spark, rows):
    found = order_minhash.near_duplicates(frame(spark, rows), Workspace(spark)).collect()
    assert len(found) == len(rows)
    return collections.Counter((r.doc_id, r.class_id) for r in found)


def items(text):
    """Shingles with the number of the occurrence, of which the first four count."""
    words = (text or "").lower().split()
    seen, found = collections.Counter(), []
    for i in range(max(1, len(words) - 4) if words else 0):
        shingle = tuple(words[i : i + 5])
        if seen[shingle] < 4:
            found.append((shingle, seen[shingle]))
        seen[shingle] += 1
    return found


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def is_link(a, b):
    least = 4 * (len(a) + len(b)) / 9
    if len(set(a) & set(b)) < least:
        return False
    return 9 * lcs(a, b) >= 4 * (len(a) + len(b))


def brute_classes(rows):
    texts = {i: items(t) for i, t in rows}
    roots = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if roots[a] != roots[b] and is_link(texts[a], texts[b]):
            low, high = sorted((roots[a], roots[b]))
            roots = {k: low if r == high else r for k, r in roots.items()}
    return roots


def test_alignment():
    rng = np.random.default_rng(3)
    outcomes = collections.Counter()
    for _ in range(200):
        a = rng.permutation(400)[: rng.integers(1, 200)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 30)))
        b = np.insert(b, rng.integers(0, len(b) + 1, 3), np.array([997, 998, 999], np.uint64))
        if rng.random() < 0.3:
            b = np.roll(b, len(b) // 9)
        wanted = is_link(a.tolist(), b.tolist())
        assert order_minhash.linked(a, b) == wanted
        outcomes[wanted] += 1
    assert min(outcomes.values()) > 40


def test_counts_never_exceed_the_distance():
    rng = np.random.default_rng(6)
    for n in (0, 1, 60, 70, 500, 20_000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        others = [
            np.append(a[rng.random(n) >= share], rng.integers(0, 1 << 63, 9).astype(np.uint64))
            for share in (0, 0.1, 0.5, 1)
        ]
        found = order_minhash.least_distances(order_minhash.counts(a), [order_minhash.counts(b) for b in others])
        for b, least, share in zip(others, found.tolist(), (0, 0.1, 0.5, 1)):
            assert least <= len(np.setxor1d(a, b))
            if share == 0.5 and n >= 500:
                assert least > order_minhash.link_limit(len(a) + len(b))
    many = np.zeros(3000, np.uint64)
    few = order_minhash.counts(many[:300])
    assert order_minhash.least_distances(order_minhash.counts(many), [few])[0] <= 2700


def test_a_repeated_passage_is_another_text(spark):
    rng = np.random.default_rng(9)
    passage = " ".join(f"w{x}" for x in rng.integers(0, 9000, 300))
    line = " one more line of seven words here"
    other = " ".join(f"w{x}" for x in rng.integers(0, 9000, 300))
    third = " ".join(f"w{x}" for x in rng.integers(0, 9000, 300))
    boiler = "\nthe same closing line again and again and again " * 300
    rows = [(1, passage), (2, " ".join([passage] * 100)), (3, passage + line), (4, " ".join([passage] * 2)),
            (5, other + boiler), (6, third + boiler), (7, other + boiler * 2)]
    found = classes(spark, rows)
    assert found == collections.Counter({(1, 1): 1, (2, 2): 1, (3, 1): 1, (4, 4): 1, (5, 5): 1, (6, 6): 1, (7, 5): 1})
    assert brute_classes([r for r in rows if r[0] != 2]) == {1: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 5}


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    rows = [(100 + i, " ".join(base[:i] + ["changed"] + base[i + 1 :])) for i in range(60)]
    rows += [(200, "one two"), (201, "one  TWO"), (202, "one three"), (300, " ".join(base[:100]))]
    rows += [(1, None), (2, ""), (3, " "), (7, LONG), (7, LONG), (8, LONG + " end"), (None, "no id"), (9, "it's 2024!!")]
    found = classes(spark, rows)
    for i in range(60):
        assert found[100 + i, 100] == 1
    assert found[200, 200] and found[201, 200] and found[202, 202] and found[300, 300]
    assert found[7, 7] == 2 and found[8, 7] and found[2, 1] and found[3, 1] and found[None, None] == 1
    docs = frame(spark, rows)
    kept = order_minhash.deduplicated(docs, Workspace(spark))
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in left if i) == sorted({c for _, c in found if c}) and None in left
    assert classes(spark, []) == collections.Counter()


def test_one_of_two_texts_of_an_id_stays(spark):
    words = [f"x{i}" for i in range(200)]
    near = " ".join(words), " ".join(words[:-2] + ["other", "end"])
    docs = frame(spark, [(1, near[0]), (1, near[1]), (2, near[0]), (3, "something else"), (3, "and another thing")])
    left = order_minhash.deduplicated(docs, Workspace(spark)).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 3]


def test_all_links_of_short_texts_are_found(spark):
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    # Pairs of n and n + k items, at 0.8 and just below, cut off at the end or the start;
    # from 14 items on also with a word changed in place.
    shapes = [(n, k, cut) for n in range(4, 65) for k in (n // 4, n // 4 + 1) for cut in (0, 1)]
    shapes += [(n, 0, i) for n in range(14, 65, 2) for i in range(6)]
    for number, (n, k, cut) in enumerate(shapes):
        words = [f"p{number}w{i}" for i in range(n + k + 4)]
        other = words[: n + 4] if cut else words[k:]
        if not k:
            other = list(words)
            other[rng.integers(0, len(words))] = "changed"
        pairs.append((2 * number, 2 * number + 1))
        rows += zip(pairs[-1], (" ".join(words), " ".join(other)))
    texts = dict(rows)
    wanted = {}
    for a, b in pairs:
        wanted |= brute_classes([(a, texts[a]), (b, texts[b])])
    # Of the pairs that were cut, those with n of n + n // 4 items are links and no other.
    cut = [wanted[b] == a for (a, b), shape in zip(pairs, shapes) if shape[1]]
    assert cut == [k == n // 4 for n, k, _ in shapes if k]
    assert {wanted[b] == a for (a, b), shape in zip(pairs, shapes) if not shape[1]} == {True, False}
    assert classes(spark, rows) == collections.Counter((i, c) for i, c in wanted.items())


@pytest.mark.parametrize("block", [3, 256])
def test_a_large_group_with_outliers(spark, monkeypatch, block):
    """Chains at the limit: not all members of a component are linked with its leader."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    monkeypatch.setattr(order_minhash, "ALIGNED_AT_ONCE", 7)
    monkeypatch.setattr(order_minhash, "TRIED_FIRST", 1)
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(90):
        words = list(base)
        for k in rng.integers(0, 90, rng.integers(0, 5)):
            words[k] = f"c{rng.integers(0, 40)}"
        cut = rng.integers(0, 14)
        rows.append((i, " ".join(words[cut:] if i % 2 else words[: 90 - cut])))
    wanted = brute_classes(rows)
    assert 1 < len(set(wanted.values())) < 60
    found = {i: c for i, c in classes(spark, rows)}
    # Sketches find a link of longer texts with a chance only; none here is missed.
    assert found == wanted


def test_query_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = {r.doc_id: r.class_id for r in queries.op3_order_minhash(spark, SMALL).collect()}
    assert found == brute_classes(rows)
