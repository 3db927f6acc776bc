"""The corpus pipeline: which documents stay, in what mixture, and as which token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All stages but the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import attention, decisions, mixing, pieces, simhash
from millrace.llm.common import table, written
from millrace.llm.queries import MIXTURE, PIECES


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores 0.7 or more."""
    return attention.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return decisions.keep_passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that with the smallest doc_id."""
    return simhash.keep_first(docs, words=4, distance=4)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as op1's mixture takes them; what is short of its weight is repeated, in two epochs at most."""
    return mixing.take(docs, MIXTURE)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled piece ids of each document."""
    return pieces.encoded(docs, PIECES, seed=42, power=1.0)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mixture),
    ("SentencePiece encoding and decoding", sentence_pieces),
]

# Trained models and 64-bit hashes of shingles have no SQL form; tests hold near-dedup against plain code, run() by its row count.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the last one's rows are computed when they are read."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"stage-{n}")
    return docs
