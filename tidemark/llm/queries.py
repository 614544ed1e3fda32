"""The operators of this subpackage as registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe_counts,
    chat_format,
    credentials,
    decontamination,
    fill_middle,
    licenses,
    merkle,
    mixing,
    quality,
    recurrent_lm,
    simhash,
    toxicity,
    url_filter,
)
from tidemark.llm.sql import SQL
from tidemark.llm.tables import read_table


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.secret_report(read_table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, folder, "documents"))


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent_lm.score(read_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe_counts.token_counts(
        read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(read_table(spark, folder, "pages"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(read_table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return toxicity.severities(docs, toxicity.train(docs, read_table(spark, folder, "labels")))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(read_table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fim_report(read_table(spark, folder, "documents"))


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # One more conversation, which says what the template's own marks are made of.
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') "
        "AS extra(conv_id, turn, role, text)"
    )
    return chat_format.chat_report(rows.unionByName(extra))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.merkle_report(read_table(spark, folder, "documents"))


QUERIES = {
    run.__name__: run
    for run in (
        op1_secrets,
        op2_decontamination,
        op3_mixing,
        op4_lm_scores,
        op5_token_counts,
        op6_url_filter,
        op7_quality,
        op8_toxicity,
        op9_licenses,
        op10_simhash,
        op11_fill_middle,
        op12_chat_format,
        op13_merkle,
    )
}


__all__ = ["QUERIES", "SQL"]
