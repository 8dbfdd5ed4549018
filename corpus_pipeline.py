"""The corpus pipeline: four stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it as
Parquet and reads it back as the next one's docs. All stages take a null text for the
empty one, work on every row by itself where ids are null or repeated, and give no rows
for no rows. All but the last return the columns of documents, and others that are there
under whatever name, as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import additive_model, order_minhash, pattern_packing, weak_supervision
from reviewloom.llm.tables import Workspace, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 0
SEQUENCE_TOKENS = 2048


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model, fitted on the given labels, accepts.

    Repeated rows are accepted or rejected alike; without labels all scores are one.
    """
    model = additive_model.train(docs, table(spark, sf_dir, "labels"))
    return additive_model.accepted_documents(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the quality rules keep.

    Empty texts and those of fewer than ten words go; repeated rows stay or go alike.
    """
    return weak_supervision.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: one with the smallest doc_id.

    Rows that repeat id and text are one document. Rows with a null doc_id all stay.
    """
    return order_minhash.deduplicated(docs, Workspace(spark))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences.

    An empty text is a piece of its end id; repeated rows have pieces of their own. Columns
    other than doc_id and text are not read.
    """
    return pattern_packing.pack_documents(
        docs, TOKENIZER, END_ID, SEQUENCE_TOKENS, Workspace(spark)
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("best-fit packing", best_fit_packing),
]

# No stage but the rules' base counts can be said in SQL: the model and the label
# model are fitted, classes are connected components, packing is a search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workspace.keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
