"""Registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermart.llm import alignment, ann, decontam, importance, langid, packing, pii, quality, sharding, simhash, suffix_dedup, toxicity, warc
from ordermart.llm.common import read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op1_query(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op2_query(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op3_query(read_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op4_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op5_query(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op6_query(read_table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op7_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op8_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op9_query(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op10_query(read_table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.op11_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.op12_query(read_table(spark, sf_dir, "documents"))


def op13_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op13_query(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_pii, op2_packing, op3_sharding, op4_quality_rules,
           op5_suffix_dedup, op6_warc, op7_decontamination, op8_toxicity, op9_simhash, op10_language_id, op11_importance, op12_alignment,
           op13_ann]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": warc.ORACLE, "op7_decontamination": decontam.ORACLE}
