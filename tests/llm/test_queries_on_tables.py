"""The queries without SQL on a whole small table, against the libraries and plain Python."""

import collections
import hashlib
import os
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from reviewloom.llm import additive_model, queries, weak_supervision
from reviewloom.llm.tables import Workspace
from reviewloom.llm.text_signals import signals

SMALL = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def word_ids(texts):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    return {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def by_id(rows):
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, texts, word_ids):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    rows = by_id(queries.op1_bpe_transducer(spark, SMALL).collect())
    assert rows.keys() == texts.keys()
    for i, ids in word_ids.items():
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(rows[i]) == (i, len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_op5_and_op6(spark, texts):
    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    rows = by_id(queries.op5_token_counts(spark, SMALL).collect())
    assert {tuple(r) for r in rows.values()} == {
        (i, len(t.encode()), len(ids[i]), len(ids[i]) > 512) for i, t in texts.items()
    }
    rows, start = by_id(queries.op6_ranked_bytes(spark, SMALL).collect()), 0
    for i in sorted(texts):
        assert tuple(rows[i]) == (i, start, len(ids[i]) + 1, crc(ids[i] + [2]))
        start += len(ids[i]) + 1


def test_op7(spark, texts):
    docs, labels = (spark.read.parquet(f"{SMALL}/{x}.parquet") for x in ("documents", "labels"))
    model = additive_model.train(docs, labels)
    rows = by_id(queries.op7_additive_model(spark, SMALL).collect())
    for i, text in texts.items():
        # Bins and table look-ups one by one.
        x = additive_model.features(signals(text))
        total = model.base
        for value, edges, table in zip(x, model.edges, model.tables):
            total += table[sum(value >= e for e in edges)]
        for (j, k), table in zip(model.pairs, model.pair_tables):
            total += table[sum(x[j] >= e for e in model.pair_edges[j])][sum(x[k] >= e for e in model.pair_edges[k])]
        score = 1 / (1 + np.exp(-total))
        assert abs(rows[i].score - score) < 1e-12
        assert rows[i].predicted == int(rows[i].score >= 0.7)
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(rows[i].predicted, q) for i, q in known.items() if i in rows and rows[i].held_out]
    assert len(held) > 5 and np.mean([p == q for p, q in held]) >= 0.8


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_op8(spark, texts):
    rows = by_id(queries.op8_weak_supervision(spark, SMALL).collect())
    votes = {i: weak_supervision.votes_of(signals(t)) for i, t in texts.items()}
    patterns = collections.Counter(map(tuple, votes.values()))
    names = sorted(patterns, key=lambda v: v[::-1])
    model = weak_supervision.estimate(np.array(names), np.array([patterns[v] for v in names], float))
    for i, text in texts.items():
        r = rows[i]
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == base_counts(text)
        posterior = model.posterior(np.array([votes[i]]))[0]
        assert abs(r.quality_probability - posterior) < 1e-9
        assert r.kept == (not r.base_failed and posterior >= 0.5)
    assert 0.5 < np.mean([r.kept for r in rows.values()]) < 1


def packed_well(rows, limit, wanted):
    """The pieces that must be there, gapless, in few more sequences than the least."""
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        ends = np.cumsum([n for _, n in sorted(members)])
        assert [o for o, _ in sorted(members)] == [0, *ends[:-1]] and ends[-1] <= limit
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / limit + 2


def pieces(word_ids, kept):
    found = collections.Counter()
    for i in kept:
        whole = word_ids[i] + [0]
        for p in range(0, len(whole), 2048):
            part = whole[p : p + 2048]
            found[i, p // 2048, p, len(part), crc(part)] += 1
    return found


def test_op9(spark, word_ids):
    packed_well(queries.op9_pattern_packing(spark, SMALL).collect(), 2048, pieces(word_ids, word_ids))


def test_op10(spark, texts):
    rows = by_id(queries.op10_sampled_splitters(spark, SMALL).collect())
    totals, slots = collections.Counter(), collections.defaultdict(list)
    for i, text in texts.items():
        size = len(text.encode()) + 1
        r = rows[i]
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (size, zlib.crc32(text.encode()), "bytes", None)
        totals[r.shard] += size
        slots[r.shard].append(r.slot)
    assert sorted(totals) == list(range(8)) and max(totals.values()) < 1.05 * min(totals.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


# The pipeline's stages


def odd_documents(spark):
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
    prose = " ".join(f"plain{i % 83} words{i % 7} here{i}" for i in range(60)) + "."
    rows = [(1, None), (2, ""), (3, "too short"), (4, prose), (4, prose), (5, prose + " end"), (6, "## $$ %% || " * 60),
            (None, prose + " no id"), (7, long), (8, "Étoile 日本 " + prose[::-1])]
    extra = DOCUMENTS + ", shard int, votes string, score double, rank int, features string"
    table = [(i, t, "en", "s", len(t or ""), 1, "v", 0.5, 3, "f") for i, t in rows]
    return spark.createDataFrame(table, extra)


def test_stages_on_odd_rows_and_without_rows(spark):
    docs = odd_documents(spark)
    before = collections.Counter(docs.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns, name
        left = collections.Counter(after.collect())
        assert left <= before, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    kept = collections.Counter(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SMALL).collect())
    # Nothing to say, too few words or symbols only: out; a repeated row stays twice.
    assert not {1, 2, 3, 6} & kept.keys() and kept[4] == 2 and kept[None] == 1
    left = collections.Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect())
    assert left == collections.Counter([1, 3, 4, 6, None, 7, 8])
    packed = corpus_pipeline.best_fit_packing(spark, docs, SMALL).collect()
    assert collections.Counter(r.doc_id for r in packed if r.piece == 0) == collections.Counter(r.doc_id for r in docs.collect())
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), SMALL).count() == 0


def test_pipeline_packs_what_its_stages_keep(spark, word_ids):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    workspace = Workspace(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = workspace.keep(stage(spark, docs, SMALL), name.replace(" ", "_"))
    kept = {r.doc_id for r in docs.collect()}
    assert 0.5 * len(word_ids) < len(kept) < len(word_ids)
    packed_well(rows, 2048, pieces(word_ids, kept))


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from checks.compare import session
spark = session(2)
for name in {names!r}:
    print(name, entry.queries()[name](spark, {small!r}).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    names = [
        "op2_block_topk", "op5_token_counts", "op7_additive_model", "op9_pattern_packing",
        "op11_spelling_variants", "op12_suffix_dedup", "op13_whitening", "pipeline",
    ]
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK_")}
    script = SCRIPT.format(repo=str(REPO), names=names, small=SMALL)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.split()[0] in names] == names
