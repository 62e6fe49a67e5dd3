"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    bbit_minhash, decontam, hard_negatives, license_rules, line_templates, nn_descent, page_templates, pivotal_mix, ranked_search, repeats,
    secrets, token_files, toxicity,
)
from starloom.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op5_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_templates.digest(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.digest(table(spark, sf_dir, "documents"))


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.digest(table(spark, sf_dir, "documents"))


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_mix.digest(table(spark, sf_dir, "documents"))


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.digest(table(spark, sf_dir, "embeddings"))


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.digest(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_toxicity, op2_secret_scan, op3_nn_descent, op4_bbit_minhash, op5_page_templates, op6_decontaminate, op7_line_templates,
    op8_license_rules, op9_pivotal_mix, op10_repeated_substrings, op11_hard_negatives, op12_ranked_search, op13_token_files)}
ORACLE: dict[str, str] = {
    "op7_line_templates": line_templates.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE, "op12_ranked_search": ranked_search.ORACLE}
