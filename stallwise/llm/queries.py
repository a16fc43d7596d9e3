"""Registered queries of the text operators, each over its whole table, and their SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stallwise.llm import (
    bpe,
    chat_trees,
    decontaminate,
    divergence,
    html_diff,
    language_fusion,
    mixing,
    order_minhash,
    pii_feistel,
    quality_qda,
    repair,
    rules_gbt,
    secrets_cnn,
)
from stallwise.llm.arrow import table

#: Only keeps the registered query repeatable; real data takes a secret key.
EXAMPLE_KEY = b"an example key, not a secret"
#: A conversation whose texts hold the template's own marks.
MARKS = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(["user", "assistant"])]


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonyms(table(spark, sf_dir, "documents"), EXAMPLE_KEY)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_trees.conversation_digests(rows.union(spark.createDataFrame(MARKS, "conv_id long, turn long, role string, text string")))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.main_text(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_fusion.languages_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_cnn.secret_digests(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_gbt.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_repairs(table(spark, sf_dir, "conversations"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_pii_pseudonyms,
        op2_order_minhash,
        op3_quality_classifier,
        op4_bpe_tokens,
        op5_decontamination,
        op6_chat_format,
        op7_html_text,
        op8_language_id,
        op9_quality_rules,
        op10_secret_scan,
        op11_source_divergence,
        op12_conversation_repair,
        op13_source_mix,
    )
}
ORACLE = {
    "op5_decontamination": decontaminate.ORACLE,
    "op6_chat_format": chat_trees.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_conversation_repair": repair.ORACLE,
}
