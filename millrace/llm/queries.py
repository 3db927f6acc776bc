"""The registered query of each operator, over its whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import attention, decisions, dualtree, maglev, maxscore, mixing, phrases, pieces, records, simhash, subwords, suffixes, warc
from millrace.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENS = public_tokenizers.path("byte_bpe_50k.json")

MIXTURE = mixing.Mixture(
    domains={0: "web", 1: "books", 2: "code", 3: "forums"},
    weights={
        "domain": {"web": 5, "books": 3, "code": 2, "forums": 2},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
        "source": {"src0": 2, "src1": 3},
    },
    parts=3,
    whole=5,
    epochs=2,
    seed=42,
)

SHARDS = [f"shard-{i:02d}" for i in range(16)]
SLOTS = 2039  # a prime over a hundred times the number of shards
HOT_SHARE = 64  # a source with more than 1/64 of all rows is split


def op1_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is taken for three fifths of all tokens, in at most two epochs of a leaf."""
    return mixing.mixed(table(spark, folder, "documents"), MIXTURE)


def op2_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for each query vector by integer inner product."""
    return maxscore.top_k(table(spark, folder, "embeddings"), every=50, k=5)


def op3_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives of all pages tell of each when they are read back."""
    return warc.round_trip(table(spark, folder, "pages"), least=0).drop("record_id")


def op4_shard_placement(spark: SparkSession, folder: str) -> DataFrame:
    """The way, slot and shard of each document, placed by its source."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return maglev.place(docs, "source", "doc_id", SHARDS, SLOTS, HOT_SHARE)


def op5_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of each document by attention over its passages."""
    return attention.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of each document: 4-word shingles, at most 4 differing bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"), words=4, distance=4)


def op7_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of each document, and whether the base rules and the learned list keep it."""
    return decisions.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of each document by averaged subword vectors."""
    return subwords.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """Place, size and checksum of each document's token ids, read back from the record files."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return records.round_trip(table(spark, folder, "documents"), TOKENS, parts)


def op10_sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """A sampled segmentation of each document, with its checksum and whether it decodes to the text."""
    return pieces.encoded(table(spark, folder, "documents"), PIECES, seed=42, power=1.0)


def op11_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return dualtree.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of each language by score, of those found a hundred times."""
    return phrases.collocations(table(spark, folder, "documents"), least=100, top=2000)


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without its repeated strings of 200 bytes."""
    return suffixes.without_repeats(table(spark, folder, "documents"), least=200).drop("kept")


QUERIES = {
    name: fn
    for name, fn in globals().copy().items()
    if name.startswith("op") and callable(fn)
}
SQL = {
    "op1_mixture": mixing.sql(MIXTURE),
    "op2_maxscore": maxscore.sql(every=50, k=5),
    "op3_warc_bundles": warc.SQL,
    "op4_shard_placement": maglev.sql("documents", "source", "doc_id", SHARDS, SLOTS, HOT_SHARE),
    "op11_dual_tree": dualtree.sql(k=50),
    "op12_collocations": phrases.sql(least=100, top=2000),
}
