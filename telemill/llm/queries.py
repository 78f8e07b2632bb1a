"""The registered queries of the operators, each over the whole of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemill.llm import toxicity as toxic_texts
from telemill.llm.audit import filter_audit
from telemill.llm.bytebpe import decode, encode
from telemill.llm.counts import token_counts
from telemill.llm.exact import exact_duplicates
from telemill.llm.language import identify, learn
from telemill.llm.lattice import scored
from telemill.llm.lines import dedup_lines
from telemill.llm.near import near_duplicates
from telemill.llm.negatives import hard_negatives
from telemill.llm.packing import packed_documents
from telemill.llm.shards import shards
from telemill.llm.shared import documents, table
from telemill.llm.sketches import edited_versions

WINDOW = 2048
END_ID = 1


def packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_documents(documents(spark, folder), path, END_ID, WINDOW)


def counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def held_out(modulus: int, remainder: int = 1) -> Column:
    """Whether the key's check sum has this remainder; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == remainder


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = decode(encode(documents(spark, folder), path, public_tokenizers.PATTERN), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", (~held_out(5)).alias("learn"))
    found = scored(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumn("held_out", ~F.col("learn")).drop("learn")


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))


def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = identify(docs, learn(docs, ~held_out(3)))
    return found.select("doc_id", held_out(3).alias("held_out"), "lang_pred", "score", "spans")


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(documents(spark, folder))


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = edited_versions(documents(spark, folder))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards(documents(spark, folder))


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(documents(spark, folder), table(spark, folder, "labels"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxic_texts.learn(docs, table(spark, folder, "labels"), ~held_out(5, 0))
    found = toxic_texts.toxicity(docs, model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", "windows", "evidence", "top_gain")


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {
    "op1_packing": packing,
    "op2_token_counts": counts,
    "op3_byte_bpe": byte_bpe,
    "op4_lattice": language_model,
    "op5_near_dedup": near_dedup,
    "op6_language": language,
    "op7_line_dedup": line_dedup,
    "op8_exact_dedup": exact_dedup,
    "op9_fingerprints": fingerprints,
    "op10_sharding": sharding,
    "op11_filter_audit": audit,
    "op12_toxicity": toxicity,
    "op13_hard_negatives": negatives,
}
