"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, collocations, decontaminate, filter_audit, fingerprints, language_id, quality, sentencepiece_codec,
               simhash_dedup, token_output, topk_search, toxicity, url_filter)
from .common import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file (given by the installed package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), model)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train_model(docs, table(spark, sf_dir, "labels")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    blocked = spark.createDataFrame([(h,) for h in url_filter.BLOCKED_HOSTS], "host string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, blocked)


def op7_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train_model(docs, table(spark, sf_dir, "labels")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train_model(docs))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    talk = talk.unionByName(chat_format.probe_rows(spark, talk))
    return chat_format.digest(chat_format.format_trees(chat_format.conversation_nodes(talk)))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.versions(table(spark, sf_dir, "documents")).drop("edited_diff", "next_diff")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.document_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_decontamination": op3_decontamination,
    "op4_token_output": op4_token_output,
    "op5_quality_nbsvm": op5_quality_nbsvm,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity_gru": op7_toxicity_gru,
    "op8_language_id": op8_language_id,
    "op9_chat_format": op9_chat_format,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_collocations": op11_collocations,
    "op12_fingerprints": op12_fingerprints,
    "op13_filter_audit": op13_filter_audit,
}
