"""Documents to packed training sequences: four stages, each an operator of clickloom.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import attention_mil, ngram_join, packing, repetition
from clickloom.llm.common import kept, table
from clickloom.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = COLUMNS[1:]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the repetition limits let pass."""
    judged = repetition.repetition_rules(docs, carry=CARRIED)
    return judged.where("kept").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labels of what is left calls good."""
    model = attention_mil.train(docs, table(spark, sf_dir, "labels"))
    scored = attention_mil.score_documents(docs, model, carry=CARRIED)
    return scored.where(F.col("score") >= 0.5).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.keep_one(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", pack),
]

# Attention pooling and the tokenizer have no counterpart in SQL; tests compare the pipeline with
# its stages worked out one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
