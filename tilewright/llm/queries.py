"""Queries over the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chaining, decontamination, importance, line_rules, mixing, near_dedup, oracles, personal_data, suffix_dedup, token_ids, toxicity
from .scratch import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents"))


def op6_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance": op1_importance,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_personal_data": op4_personal_data,
    "op5_line_rules": op5_line_rules,
    "op6_chaining": op6_chaining,
    "op7_toxicity": op7_toxicity,
    "op8_token_ids": op8_token_ids,
    "op9_near_dedup": op9_near_dedup,
    "op10_mixing": op10_mixing,
}

ORACLE_SQL: dict[str, str] = {"op5_line_rules": oracles.OP5_LINE_RULES, "op9_near_dedup": oracles.OP9_NEAR_DEDUP}
