"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    additive_model,
    block_topk,
    chat_parts,
    lexicon_bpe,
    order_minhash,
    pattern_packing,
    ranked_bytes,
    spelling,
    splitters,
    suffix_dedup,
    token_counts,
    weak_supervision,
    whitening,
)
from reviewloom.llm.tables import Workspace, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

TOKEN_LIMIT = 512
END_ID = 2
PACK_LIMIT = 2048
PACK_END_ID = 0
SHARDS = 8


def op1_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    workspace = Workspace(spark)
    lexicon = lexicon_bpe.build_lexicon(docs, WORD_BPE, workspace)
    # Stored in between: a task has one Python worker at a time, and decoding starts anew
    # from files that outlive an executor.
    encoded = workspace.keep(lexicon_bpe.encode_texts(docs, WORD_BPE, lexicon), "encoded")
    return lexicon_bpe.decode_ids(encoded, WORD_BPE).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(
        table(spark, sf_dir, "embeddings"), every=50, k=5, workspace=Workspace(spark)
    )


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return order_minhash.near_duplicates(docs, Workspace(spark)).select("doc_id", "class_id")


CHAT_PROBE = "</s>[INST] ok [/INST]"


def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(
        [(-1, 0, "user", CHAT_PROBE), (-1, 1, "assistant", CHAT_PROBE)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = talks.union(probe).withColumn("content", chat_parts.text_parts(F.col("text")))
    formatted = chat_parts.format_conversations(turns)
    read = formatted.select(
        "conv_id",
        chat_parts.read_turns(F.col("formatted")).alias("turns"),
        chat_parts.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    listed = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_ranked_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).path("ids")
    ranked_bytes.write_ids(table(spark, sf_dir, "documents"), path, BYTE_BPE, END_ID)
    return ranked_bytes.read_ids(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op7_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = additive_model.train(docs, table(spark, sf_dir, "labels"))
    return additive_model.score_documents(docs, model).select(
        "doc_id",
        additive_model.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= additive_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = weak_supervision.measure_documents(table(spark, sf_dir, "documents"))
    stored = Workspace(spark).keep(measured, "measured")
    _, posteriors = weak_supervision.fit_rules(stored)
    return weak_supervision.judge(stored, posteriors).drop("votes")


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = pattern_packing.pack_documents(
        docs, WORD_BPE, PACK_END_ID, PACK_LIMIT, Workspace(spark)
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dealt = splitters.shard_documents(docs, SHARDS, Workspace(spark))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), Workspace(spark))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_repeats(table(spark, sf_dir, "documents"), Workspace(spark))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), Workspace(spark))


QUERIES = {
    "op1_bpe_transducer": op1_bpe_transducer,
    "op2_block_topk": op2_block_topk,
    "op3_order_minhash": op3_order_minhash,
    "op4_chat_parts": op4_chat_parts,
    "op5_token_counts": op5_token_counts,
    "op6_ranked_bytes": op6_ranked_bytes,
    "op7_additive_model": op7_additive_model,
    "op8_weak_supervision": op8_weak_supervision,
    "op9_pattern_packing": op9_pattern_packing,
    "op10_sampled_splitters": op10_sampled_splitters,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}
