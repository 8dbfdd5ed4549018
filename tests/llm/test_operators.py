"""Every operator against brute force, on odd rows and on a whole small table."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import differences, duck
from reviewloom.llm import (
    additive_model,
    block_topk,
    chat_parts,
    lexicon_bpe,
    pattern_packing,
    queries,
    ranked_bytes,
    splitters,
    token_counts,
    weak_supervision,
)
from reviewloom.llm.oracle import ORACLE_SQL
from reviewloom.llm.tables import Workspace

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, shard int, n_tokens int, node string"
LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b \n\tc"), (5, "x<|endoftext|> y <|startoftext|>"),
    (6, "Été ẞ ΣΑΣ ½ 日本 é \x1c\x85"), (7, LONG), (7, LONG), (8, LONG + " end"),
    (None, "no id"), (9, "it's we'll 2024!!"), (10, "🙂   end "), (11, "\\ <s>[INST]"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 9, 9, "x") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return {x: Tokenizer.from_file(x) for x in (queries.WORD_BPE, queries.BYTE_BPE)}


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def same(found, wanted):
    return collections.Counter(map(tuple, found)) == collections.Counter(wanted)


def test_lexicon_bpe(spark, odd, empty, library):
    t = library[queries.WORD_BPE]
    name = lexicon_bpe.build_lexicon(odd, queries.WORD_BPE, Workspace(spark))
    encoded = lexicon_bpe.encode_texts(odd, queries.WORD_BPE, name)
    rows = lexicon_bpe.decode_ids(encoded, queries.WORD_BPE).collect()
    wanted = [(i, tuple(ids(t, x)), t.decode(ids(t, x), skip_special_tokens=False)) for i, x in ODD]
    assert same([(r.doc_id, tuple(r.ids), r.text) for r in rows], wanted)
    name = lexicon_bpe.build_lexicon(empty, queries.WORD_BPE, Workspace(spark))
    assert lexicon_bpe.encode_texts(empty, queries.WORD_BPE, name).count() == 0


def test_automaton_is_minimal():
    words = sorted(x.encode() for x in ("tap", "taps", "top", "tops", "stop", "stops"))
    states, accepts, start = lexicon_bpe.minimal_automaton(words)
    accepted = []

    def walk(state, word):
        if accepts[state]:
            accepted.append(word)
        for byte, target in states[state].items():
            walk(target, word + bytes([byte]))

    walk(start, b"")
    assert sorted(accepted) == words
    # Start, t, st, the states before p, p with and without s: endings are shared.
    assert len(states) == 7


def test_token_counts(odd, empty, library):
    t = library[queries.BYTE_BPE]
    rows = token_counts.count_tokens(odd, queries.BYTE_BPE).collect()
    assert same(rows, [(i, len((x or "").encode()), len(ids(t, x))) for i, x in ODD])
    assert token_counts.count_tokens(empty, queries.BYTE_BPE).count() == 0


@pytest.mark.parametrize("path", [queries.BYTE_BPE, queries.WORD_BPE])
def test_token_counts_of_all_plain_characters(spark, library, path):
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in [*range(592), 0x3A9, 0x65E5, 0x1F642]]
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(600)]
    # Mostly letters, marks and spaces, so that many parts are counted by their pre-tokens.
    usual = [*"aábcst ' 0129.,!", " ", " ", "'s", "'ll", "\n", "\xa0", "\0"]
    texts += ["".join(rng.choice(usual, rng.integers(1, 60))) for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = token_counts.count_tokens(docs.union(docs), path).collect()
    assert same(
        [(r.doc_id, r.n_tokens) for r in rows],
        2 * [(i, len(ids(library[path], x))) for i, x in enumerate(texts)],
    )


def test_length_table():
    kept = [f"w{i * 7919 % 65_536:x}"[:16] for i in range(65_536)]
    sizes = np.arange(len(kept)) % 200 + 1
    table = token_counts.length_table([*kept, "seventeen letters", "zero\0"], [*sizes, 3, 4])
    assert np.count_nonzero(table.lengths) == len(kept)
    keys, whole = token_counts.slot_keys([*kept, "absent", "", "seventeen letters", "zero\0"])
    assert whole.tolist() == [True] * (len(kept) + 2) + [False] * 2
    assert (table.find(keys)[: len(kept)] == sizes).all()
    assert (table.find(keys[[len(kept), len(kept) + 1]]) == 0).all()
    # What the broadcast holds does not follow the data.
    assert sum(x.nbytes for x in table) == 17 << token_counts.TABLE_BITS
    none = token_counts.length_table([], np.zeros(0, np.uint8))
    assert none.find(keys).sum() == 0 and none.find(keys[:0]).shape == (0,)


def test_ranked_bytes(spark, odd, empty, library):
    t = library[queries.BYTE_BPE]
    path = Workspace(spark).path("ids")
    ranked_bytes.write_ids(odd, path, queries.BYTE_BPE, 2)
    rows = sorted(ranked_bytes.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
    start = 0
    for r in rows:
        assert r.start == start
        start += len(r.ids) // 4
    wanted = [(i, np.array(ids(t, x) + [2], "<u4").tobytes()) for i, x in ODD]
    assert same([(r.doc_id, bytes(r.ids)) for r in rows], wanted)
    ranked_bytes.write_ids(empty, path + "0", queries.BYTE_BPE, 2)
    assert ranked_bytes.read_ids(spark, path + "0").count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_byte_aligned_numbers(n):
    numbers = np.random.default_rng(n).integers(0, 1 << 32, n) >> np.arange(n) % 32
    assert ranked_bytes.unpack(*ranked_bytes.pack(numbers), n).tolist() == numbers.tolist()


def test_packing(spark, odd, empty, library):
    t = library[queries.WORD_BPE]
    rows = pattern_packing.pack_documents(odd, queries.WORD_BPE, 0, 64, Workspace(spark)).collect()
    wanted = []
    for i, x in ODD:
        whole = ids(t, x) + [0]
        for p in range(0, len(whole), 64):
            piece = np.array(whole[p : p + 64], "<u4")
            wanted.append((i, p // 64, p, len(piece), zlib.crc32(piece.tobytes())))
    assert same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], wanted)
    gapless([(r.sequence_id, r.offset, r.length) for r in rows], 64)
    none = pattern_packing.pack_documents(empty, queries.WORD_BPE, 0, 64, Workspace(spark))
    assert none.count() == 0


def gapless(rows, limit):
    sequences = collections.defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(4, 1.2, 5000).astype(int) + 1, 512)
    histogram = np.bincount(lengths, minlength=513)
    plan = pattern_packing.plan(histogram, 512)
    assert plan.sequences <= 1.01 * lengths.sum() / 512 + 1


def test_splitters(spark, empty):
    rows = [(i, "x" * (i % 97) if i % 3 else "hot", 1, 1, "") for i in range(3000)]
    rows += [(5, None, 1, 1, ""), (5, None, 1, 1, ""), (None, "q", 1, 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = splitters.shard_documents(docs, 8, Workspace(spark)).collect()
    size = lambda x: len((x or "").encode()) + 1
    wanted = [(i, size(x), zlib.crc32((x or "").encode())) for i, x, *_ in rows]
    assert same([(r.doc_id, r["size"], r.text_crc32) for r in found], wanted)
    slots, totals = collections.defaultdict(list), collections.Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        totals[r.shard] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len(totals) == 8 and max(totals.values()) < 1.05 * min(totals.values())
    assert splitters.shard_documents(empty, 8, Workspace(spark)).count() == 0


def test_shards_are_ranges(spark, monkeypatch):
    """Sizes are level and only a hot text is divided, one row repeated without end, too."""
    monkeypatch.setattr(splitters, "ROWS_AT_ONCE", 100)
    rows = [(i, LONG[: 40 + i * 7919 % 900] + str(i % 700), 5, 5, "") for i in range(2000)]
    rows += [(7, "one row " * 40, 5, 5, "")] * 1500 + [(9, LONG[:50_000], 5, 5, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("file", F.lit("x"))
    found = splitters.shard_documents(docs, 8, Workspace(spark)).collect()
    totals, held, slots = collections.Counter(), collections.defaultdict(set), collections.Counter()
    for r in found:
        totals[r.shard] += r["size"]
        held[r.text_crc32].add(r.shard)
        slots[r.shard, r.slot] += 1
    assert len(found) == len(rows) == len(slots)
    assert max(s for _, s in slots) + 1 == max(collections.Counter(s for s, _ in slots).values())
    assert max(totals.values()) < 1.02 * min(totals.values())
    assert len(totals) == 8
    # Only the row that is a third of all is divided; others of its text's size are not.
    assert [key for key, shards in held.items() if len(shards) > 1] == [
        zlib.crc32(("one row " * 40).encode())
    ]


def test_splitter_arithmetic():
    assert splitters.weighted_quantiles([(i, 1.0) for i in range(8)], 4) == [1, 3, 5, 7]
    assert splitters.weighted_quantiles([(5, 9.0), (1, 1.0)], 2) == [4, 5]
    # Shards of 80, of which 70 are the body.
    sizes = [(0, 10), (1, 60), (2, 11), (5, 65), (6, 4), (9, 10)]
    assert splitters.bodies(sizes, 2) == {0: 0, 1: 0, 5: 1, 6: 1}
    assert splitters.places(sizes, 2) == [(0, 0), (1, 0), (2, 1), (5, 1), (6, 1), (9, 0)]
    assert splitters.places([(7, 100)], 4) == [(7, 0)]
    assert splitters.places([], 4) == []


def test_chat_parts(spark):
    def part(kind, text=None, reference=None, tokens=None):
        return (kind, text, reference, tokens)

    turns = [
        (1, 0, "user", [part("text", "a<image>\\l"), part("image", None, "s3", 7), part("text", "]b")]),
        (1, 1, "assistant", [part("text", "</s>[INST]"), part("audio", None, "f")]),
        (1, 2, None, None), (1, 2, "tool [x]", [part("text", None)]), (2, None, "assistant", []),
    ]
    schema = f"conv_id bigint, turn bigint, role string, content {chat_parts.PARTS}"
    formatted = chat_parts.format_conversations(spark.createDataFrame(turns, schema))
    read = formatted.select(
        "conv_id", "attachments", "expanded_tokens",
        F.transform(
            chat_parts.read_bodies(F.col("formatted")), lambda t: chat_parts.read_parts(t["body"])
        ).alias("parts"),
        chat_parts.read_turns(F.col("formatted")).alias("turns"),
        chat_parts.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    one, two = sorted(read.collect(), key=lambda r: r.conv_id)
    assert [tuple(t) for t in one.turns] == [
        ("user", "a<image>\\l<image>]b"), ("assistant", "</s>[INST]<audio>"), ("", ""), ("tool [x]", ""),
    ]
    assert [[tuple(p) for p in t] for t in one.parts] == [
        [("text", "a<image>\\l"), ("image", None), ("text", "]b")],
        [("text", "</s>[INST]"), ("audio", None)], [], [],
    ]
    assert [tuple(a) for a in one.attachments] == [("image", "s3", 7), ("audio", "f", 128)]
    assert one.expanded_tokens == 135 and one.loss == "</s>[INST]<audio>"
    assert [tuple(t) for t in two.turns] == [("assistant", "")] and two.loss == ""
    assert chat_parts.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_chat_parts_of_odd_rows(spark):
    """Null ids, equal rows, columns of clashing names, a very long text and a conversation
    of very many turns, of which every second one is an answer."""
    rows = [(None, 3, "user", "no id"), (None, 3, "user", "no id"), (None, None, "assistant", "é🙂<s>")]
    rows += [(5, 0, "assistant", LONG * 10), (5, 1, "user", "")]
    rows += [(6, i, ("user", "assistant")[i % 2], f"<t{i}> 日本 é") for i in range(30_000)]
    schema = "conv_id bigint, turn bigint, role string, text string"
    turns = spark.createDataFrame(rows, schema).repartition(7)
    named = ("at", "marked", "head", "body", "attached", "placed", "formatted", "attachments")
    turns = turns.withColumns({x: F.lit(x) for x in named})
    turns = turns.withColumn("content", chat_parts.text_parts(F.col("text")))
    formatted = chat_parts.format_conversations(turns)
    read = formatted.select(
        "*",
        chat_parts.read_turns(F.col("formatted")).alias("turns"),
        chat_parts.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    found = {r.conv_id: r for r in read.collect()}
    for conv in (None, 5, 6):
        wanted = [r for r in rows if r[0] == conv]
        wanted.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        assert [tuple(t) for t in found[conv].turns] == [(role, text) for _, _, role, text in wanted]
        answers = [text for _, _, role, text in wanted if role == "assistant"]
        assert found[conv].loss == "".join(answers) and found[conv].attachments == []
        cut = [found[conv].formatted[s.start : s.start + s.length] for s in found[conv].loss_spans]
        assert len(cut) == len(answers) and not any("<" in x for x in cut)
    assert found.keys() == {None, 5, 6}


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(700)]
    vectors += [(800, None), (801, [None] * 4), (802, [float("nan")] * 4), (900, [0.5]), (None, [1.0])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    rows = block_topk.top_k(frame, 50, 5, Workspace(spark)).collect()
    usable = {i: np.floor(256 * np.array(v)) for i, v in vectors[:700]} | {900: np.array([128.0])}
    wanted = []
    for q in (i for i in usable if i % 50 == 0):
        n = {i: int((v[: len(usable[q])] * usable[q][: len(v)]).sum()) for i, v in usable.items()}
        best = sorted((i for i in n if i != q), key=lambda i: (-n[i], i))[:5]
        wanted += [(q, k, i, n[i]) for k, i in enumerate(best, 1)]
    assert same(rows, wanted)
    assert block_topk.top_k(frame.limit(0), 50, 5, Workspace(spark)).count() == 0


def test_top_k_in_many_runs(spark, monkeypatch):
    for name, value in {"RUN": 32, "BLOCK": 8, "QUERIES_AT_ONCE": 4, "SLAB": 3, "PORTIONS": 1, "SAMPLE": 40}.items():
        monkeypatch.setattr(block_topk, name, value)
    rng = np.random.default_rng(2)
    centres = 20 * rng.normal(size=(12, 6))
    rows = [(i, (centres[i % 12] + rng.normal(size=6)).round(2).tolist()) for i in range(900)]
    # Rows that repeat, a vector that many share, and ties of ids.
    rows += [rows[50], rows[50], *[(1000 + i, rows[7][1]) for i in range(300)]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    frame = frame.withColumn("query", F.lit("x")).withColumn("run", F.lit(0)).repartition(8)
    workspace = Workspace(spark)
    found = block_topk.top_k(frame, 50, 5, workspace).collect()
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    wanted = []
    for q, asked in whole:
        if q % 50 == 0:
            best = sorted((-int(v @ asked), i) for i, v in whole if i != q)[:5]
            wanted += [(q, k, i, -n) for k, (n, i) in enumerate(best, 1)]
    assert same(found, wanted)
    runs = spark.read.parquet(workspace.path("runs")).count()
    asked = spark.read.parquet(workspace.path("asked")).count()
    sent = spark.read.parquet(workspace.path("others")).count() + asked
    assert runs > 30 and sent < asked * runs / 4


def test_top_k_beyond_a_bigint(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [2.0, 2.0]), (4, [1e9, -1e9])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    most, found = (1 << 63) - 1, block_topk.top_k(frame, 50, 5, Workspace(spark)).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [
        (1, 1, most), (2, 3, most), (3, 4, most), (4, 2, -most + 1),
    ]


def test_base_counts(odd, empty):
    rows = weak_supervision.measure_documents(odd).collect()

    def base(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(covered)

    assert same(
        [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_repeat_words) for r in rows],
        [(i, *base(t)) for i, t in ODD],
    )
    assert weak_supervision.kept_documents(empty).count() == 0


def test_label_model_finds_the_bad():
    rng = np.random.default_rng(2)
    good = rng.random(4000) < 0.9
    right = rng.random((4000, 5)) < np.where(good[:, None], 0.995, 0.6)
    votes = np.where(right == good[:, None], 1, -1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = weak_supervision.estimate(patterns, counts.astype(float)).posterior(votes) >= 0.5
    assert (found == good).mean() > 0.97


def test_label_model_with_a_rule_wrong_on_a_third_of_the_good():
    rng = np.random.default_rng(7)
    good = rng.random(20_000) < 0.9
    votes = np.where(rng.random((20_000, 9)) < np.where(good[:, None], 0.002, 0.5), -1, 1)
    votes[good & (rng.random(20_000) < 1 / 3), 6] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_supervision.estimate(patterns, counts.astype(float))
    alone = np.where(np.arange(9) == 6, -1, 1)[None, :]
    assert model.posterior(alone)[0] > 0.99
    assert abs(model.right_good[6] - 2 / 3) < 0.02 and abs(model.prior - 0.9) < 0.02
    found = model.posterior(votes) >= 0.5
    assert found[good].mean() > 0.99 and found[~good].mean() < 0.06


def test_additive_model(spark, odd, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = additive_model.train(docs, labels)
    rows = additive_model.score_documents(docs, model).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.7) == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in additive_model.score_documents(odd, model).collect())
    assert additive_model.accepted_documents(empty, model).columns == empty.columns
    assert 0 < additive_model.train(empty, labels.limit(0)).score(np.zeros((1, 16)))[0] < 1


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), duck(SMALL), ORACLE_SQL[name]) is None


def test_pipeline(spark):
    docs = dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())
    rows = corpus_pipeline.run(spark, SMALL).collect()
    gapless([(r.sequence_id, r.offset, r.length) for r in rows], 2048)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows[:40]:
        piece = (ids(t, docs[r.doc_id]) + [0])[r.start : r.start + r.length]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
    kept = {r.doc_id for r in rows}
    assert 0.5 * len(docs) < len(kept) < len(docs)
    texts = [hashlib.md5(docs[d].encode()).digest() for d in kept]
    assert len(set(texts)) == len(texts)
