"""A training corpus from documents: language, repeated lines, near duplicates, packing.

Each stage works on all that the stage before kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemill.llm import queries
from telemill.llm.language import in_a_language, learn
from telemill.llm.lines import dedup_lines
from telemill.llm.near import one_of_each
from telemill.llm.packing import packed_documents
from telemill.llm.shared import documents, swept
from telemill.session import drop_dir, scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or most of whose letters are in no language known, go. The
    model is learned from the rows that the language query learns from."""
    return in_a_language(docs, learn(docs, ~queries.held_out(3)))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated windows are taken out; a document that loses all its lines goes."""
    found = dedup_lines(docs)
    return found.where("n_removed = 0 OR n_removed < n_lines").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the smallest key."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token pieces with their places in sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_documents(docs, path, queries.END_ID, queries.WINDOW)


STAGES = [
    ("language ID", language),
    ("line dedup", repeated_lines),
    ("near duplicates", near_duplicates),
    ("packing", packing),
]

#: SQL knows neither the models nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    paths = []
    for name, stage in STAGES[:-1]:
        with swept(spark):  # what a stage stages is dropped when its own rows are written
            paths.append(scratch_dir(spark, f"llm-{name.replace(' ', '-')}"))
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(paths[-1])
        docs = spark.read.parquet(paths[-1])
    packed = STAGES[-1][1](spark, docs, sf_dir)
    for path in paths:  # the last stage has staged its pieces and reads them alone
        drop_dir(spark, path)
    return packed
