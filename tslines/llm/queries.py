"""The queries of the thirteen operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tslines.llm import bpe_codec, chat, divergence, embedding_dedup, exact_dedup, hard_negatives, mixing, quality, simhash, token_counts, toxicity, url_filter, warc
from tslines.llm.common import ready, table, tokenizer_path
from tslines.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

OVER = 512
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER)


def _third(column: str):
    """crc32 of an id as text, modulo three."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 3


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, _third("id") != 1)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        (_third("doc_id") == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.copies(table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source", "rate", "copies")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    formatted = chat.format_chats(chats.unionByName(more))
    read = formatted.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    index = warc.write_bundles(pages, scratch_path(spark, "warc"))
    records = warc.read_records(index, payloads=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe_codec.encode(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), ["doc_id"], decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"), shift=(7, 10))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(ready(spark), folder)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_toxicity, op3_exact_dedup, op4_simhash, op5_url_filter, op6_quality, op7_mixing, op8_chat, op9_warc,
        op10_bpe, op11_hard_negatives, op12_embedding_dedup, op13_divergence, pipeline,
    )
}
