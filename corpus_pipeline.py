"""The corpus pipeline: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and gives the columns of ``docs`` for
the rows it keeps; the last gives one encoded row a document.  Between stages
``run`` writes Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlens.llm import decontaminate, language_id, sentencepiece_codec, simhash_dedup, toxicity
from meterlens.llm.common import store, table
from meterlens.llm.queries import tokenizer_file

PIECE_MODEL = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go."""
    return language_id.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, parity, decoded of every document left."""
    with open(tokenizer_file(PIECE_MODEL), "rb") as f:
        return sentencepiece_codec.encode(docs, f.read())


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", identify_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece_encoding", encode),
]

# SQL can express neither the trained models nor the encoding: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
