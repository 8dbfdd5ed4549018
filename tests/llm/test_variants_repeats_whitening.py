"""Spelling variants, repeated passages and whitening against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from reviewloom.llm import queries, spelling, suffix_dedup, whitening
from reviewloom.llm.tables import Workspace

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, slice int, bucket string, n long, word string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 1, "w") for i, t in rows], SCHEMA)


# Spelling


def brute_variants(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    holes = collections.defaultdict(set)
    for w in n:
        holes[w].add(w)
        for k in range(len(w)):
            holes[w[:k] + w[k + 1 :]].add(w)
            holes[w[:k] + "?" + w[k + 1 :]].add(w)

    def edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = collections.defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if edit(a, b)}
    form = {}
    for w, count in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * count else None
    found = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return found


def variant_rows(docs, spark):
    rows = spelling.spelling_variants(docs, Workspace(spark)).collect()
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_variants_on_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = ["".join(rng.choice(list("abcdeéÀ×"), rng.integers(6, 10))) for _ in range(60)]
    rows = [(1, None), (2, ""), (None, "Étoiles " * 5), (None, "Étoiles " * 5), (3, "ABCDEÉ abcdeé " * 4)]
    for i in range(400):
        words = list(rng.choice(base, 40)) + base[:3] * 9
        for k in rng.integers(0, 40, 3):
            w = words[k]
            at = rng.integers(0, len(w))
            words[k] = rng.choice([w[:at] + w[at + 1 :], w[:at] + "e" + w[at:], w[:at] + "c" + w[at + 1 :]])
        rows.append((i % 350, " ".join(words)))
    # A chain: each word occurs more than five times as often as the next.
    rows += [(950, "unlike " * 400 + "unlikel " * 60 + "unlikely " * 8)]
    # Long runs, also longer than what a block of words holds.
    rows += [(900 + i, ("q" * 3000 + "z" * (i % 2) + " ") * 6) for i in range(2)]
    wanted = brute_variants(rows)
    assert any(f for _, f, *_ in wanted) and any(f and f != r for _, f, r, *_ in wanted)
    assert variant_rows(frame(spark, rows), spark) == wanted


def test_variants_without_rows(spark):
    assert variant_rows(frame(spark, []), spark) == set()
    assert variant_rows(frame(spark, [(1, None), (2, "short words")]), spark) == set()


def test_products_find_all_near_pairs(monkeypatch):
    monkeypatch.setattr(spelling, "PART", 16)
    rng = np.random.default_rng(3)
    words = {n: sorted({"".join(rng.choice(list("abý"), n)) for _ in range(90)}) for n in (6, 7)}
    blocks = {n: spelling.Block("".join(w).encode("latin-1"), np.zeros(len(w), int).tobytes(), n) for n, w in words.items()}
    for m, n in ((6, 6), (6, 7), (7, 7)):
        left, right = spelling.block_links(blocks[m], blocks[n], m == n)
        found = {(words[m][i], words[n][j]) for i, j in zip(left, right)}
        wanted = set()
        for a in words[m]:
            for b in words[n]:
                same = sum(x != y for x, y in zip(a, b)) == 1 and a < b if m == n else False
                wanted |= {(a, b)} if same or (m < n and a in {b[:k] + b[k + 1 :] for k in range(n)}) else set()
        assert found == wanted and len(left) == len(found)


# Repeats


def test_transform_and_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(60):
        texts = [rng.integers(1, 4, rng.integers(1, 14)).tolist() for _ in range(rng.integers(1, 9))]
        starts = np.append(0, np.cumsum([len(x) for x in texts]))
        bwt, common = suffix_dedup.transform(np.array(sum(texts, []), np.uint8), starts)
        # An end sorts before all symbols, those of earlier strings first.
        suffixes = sorted((x[i:] + [n - 99], n, i) for n, x in enumerate(texts) for i in range(len(x) + 1))
        assert bwt.tolist() == [texts[n][i - 1] if i else 0 for _, n, i in suffixes]
        wanted = [0]
        for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
            wanted.append(next(k for k in range(99) if a[k] != b[k] or a[k] < 0))
        assert common.tolist() == wanted


def brute_removed(rows):
    first = {}
    for i, text in rows:
        coded = (text or "").encode()
        for k in range(len(coded) - 49 if i is not None else 0):
            first[coded[k : k + 50]] = min(i, first.get(coded[k : k + 50], i))
    found = []
    for i, text in rows:
        coded = (text or "").encode()
        cut = np.zeros(len(coded), bool)
        for k in range(len(coded) - 49 if i is not None else 0):
            if first[coded[k : k + 50]] < i:
                cut[k : k + 50] = True
        spans = np.count_nonzero(np.diff(np.append(0, cut.astype(int))) == 1)
        kept = bytes(np.frombuffer(coded, np.uint8)[~cut])
        found.append((i, len(coded), int(cut.sum()), int(spans), hashlib.sha256(kept).hexdigest()))
    return collections.Counter(found)


def removed(docs, spark):
    return collections.Counter(map(tuple, suffix_dedup.removed_repeats(docs, Workspace(spark)).collect()))


def test_repeats_on_odd_rows(spark, monkeypatch):
    # Small slices and buckets, so that long texts have segments and there are many buckets.
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "TRANSFORM_SYMBOLS", 500)
    rng = np.random.default_rng(5)
    letters = list("abcdefgh é日🙂\n\x00")

    def prose(n):
        return "".join(rng.choice(letters, n))

    shared, short, long = prose(300), "x" * 49, prose(9000)
    rows = [
        (1, None), (2, ""), (3, short), (4, short), (5, "x" * 50), (6, "x" * 400), (7, "x" * 400),
        (8, prose(80) + shared + prose(80)), (9, shared), (9, shared + "tail"), (None, shared), (None, shared),
        (-5, prose(60) + shared[100:149]), (-4, prose(60) + shared[100:220] + prose(10)),
        (20, long), (21, prose(200) + long[2000:7000] + prose(200)), (10**15, long), (22, "ab" * 4000),
    ]
    rows += [(100 + i, prose(30) + shared[50:200] + prose(30)) for i in range(40)]
    rows += [(200 + i, prose(500)) for i in range(20)] + [(230, "the same " * 50), (231, "the same " * 50)]
    assert removed(frame(spark, rows), spark) == brute_removed(rows)


def test_keys_of_frequent_grams_still_meet(spark):
    rng = np.random.default_rng(6)
    text = "".join(rng.choice(list("abcdef"), 400))
    for marks in (np.zeros(1 << 20, bool), np.ones(1 << 20, bool), rng.random(1 << 20) < 0.5):
        data = np.frombuffer(text.encode(), np.uint8)
        keys = suffix_dedup.window_keys(np.concatenate([data, data]), marks)
        assert (keys[:351] == keys[400:751]).all()


def test_repeats_without_rows(spark):
    assert removed(frame(spark, []), spark) == collections.Counter()


def test_repeats_query_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = collections.Counter(map(tuple, queries.op12_suffix_dedup(spark, SMALL).collect()))
    assert found == brute_removed([tuple(r) for r in docs])


# Whitening


def brute_whitening(vectors):
    x = np.array([np.floor(64 * np.array(v, float)) for _, v in vectors]).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums).astype(object) ** 2).sum(axis=1)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, deviation, values, centred @ axes / np.sqrt(values)


def check_whitening(rows, vectors, components):
    n, deviation, values, wanted = brute_whitening(vectors)
    found = collections.defaultdict(dict)
    for r in rows:
        found[r.vec_id][r.component] = r
    assert sorted(found) == sorted(i for i, _ in vectors)
    matrix = np.array([[found[i][c].whitened for c in range(1, components + 1)] for i, _ in vectors])
    signs = np.sign((matrix * wanted[:, :components]).sum(axis=0))
    assert np.abs(matrix * signs - wanted[:, :components]).max() < 1e-6
    for (i, _), d in zip(vectors, deviation):
        for c, r in found[i].items():
            assert (r.n, r.deviation) == (n, d) and 0 <= r.identity_error < 1e-4
            assert abs(r.explained - values[c - 1] / values.sum()) < 1e-9


def test_whitening_on_odd_rows(spark):
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(5, 5))
    vectors = [(i, (rng.normal(size=5) @ mixed).tolist()) for i in range(300)]
    odd = [(900, None), (901, [None] * 5), (902, [1.0, float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf")] * 5)]
    rows = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in vectors + odd], "vec_id bigint, embedding array<double>, n int, whitened string"
    )
    found = whitening.whitened_components(rows, Workspace(spark)).collect()
    assert len(found) == 1500
    check_whitening(found, vectors, 5)
    none = whitening.whitened_components(rows.where("vec_id >= 900"), Workspace(spark))
    assert none.count() == 0


def test_whitening_of_repeated_null_and_short_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    rows = [(1, [1.0, 0.0, 0.5]), (1, [1.0, 0.0, 0.5]), (None, [0.25, 2.0]), (4, [-1.0, 0.5, 0.5]), (5, [])]
    full = [[1, 0, 0.5], [1, 0, 0.5], [0.25, 2, 0], [-1, 0.5, 0.5], [0, 0, 0]]
    n, deviation, values, _ = brute_whitening(list(enumerate(full)))
    found = whitening.whitened_components(spark.createDataFrame(rows, schema), Workspace(spark)).collect()
    got = collections.Counter((r.vec_id, r.deviation) for r in found)
    assert got == collections.Counter((i, d) for (i, _), d in zip(rows, deviation) for _ in range(3))
    # Equal vectors have no spread: nothing to divide by.
    alike = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], schema)
    for r in whitening.whitened_components(alike, Workspace(spark)).collect():
        assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (3, 0, None, None, None)


def test_squares_of_large_numbers_are_exact():
    rows = np.array([[1 << 40, -(1 << 39)], [3, 5 - (1 << 41)]])
    found = whitening.squares(rows)
    ints = rows.astype(object)
    assert found[0, 0] == (ints[:, 0] ** 2).sum() and found[0, 1] == ((ints[:, 0] + ints[:, 1]) ** 2).sum()


def test_too_large_entries_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1e300])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.whitened_components(rows, Workspace(spark)).collect()


def test_whitening_query_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    vectors = [(r.vec_id, r.embedding) for r in rows if r.embedding is not None]
    check_whitening(queries.op13_whitening(spark, SMALL).collect(), vectors, 32)
