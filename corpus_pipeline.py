"""From raw documents to token ids: quality rules, exact and near duplicates, mixing, BPE.

Every stage takes what its predecessor kept and returns the columns of documents, the last
one the encoded documents. `run` writes each stage as a table in the shared folder and reads
it again, so a lost executor costs a task and not the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import bpe_codec, exact_dedup, mixing, quality, similar
from tslines.llm.common import ready, tokenizer_path
from tslines.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    ready(spark)
    return quality.passing(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    ready(spark)
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id. Near copies
    share at least 0.8 of their five-word shingles."""
    ready(spark)
    return similar.drop_similar(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    ready(spark)
    return mixing.repeat_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids of the whole text, their number, and the digest of the
    text they decode to."""
    ready(spark)
    coded = bpe_codec.encode(docs, tokenizer_path(TOKENIZER), ["doc_id", "source"], decoded=True)
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: SQL cannot express the closure of near copies, entropy balancing or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents` of a folder; the rows of the last."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
