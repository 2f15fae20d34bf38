"""The registered queries of the training-data operators and their SQL specification.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lakevault.llm import (
    decontaminate,
    html_text,
    language,
    lm_score,
    near_dedup,
    pack,
    quality_model,
    quality_rules,
    repair,
    repeats,
    search,
    shard,
    substrings,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.op1_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.op2_scores(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.op3_packing(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.op4_near_dedup(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op5_html(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.op6_shards(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op7_language(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.op8_substrings(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op9_quality(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op10_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op11_repeats(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.op12_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.op13_repair(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_lm_score,
        op3_packing,
        op4_near_dedup,
        op5_html_extraction,
        op6_sharding,
        op7_language_id,
        op8_substring_dedup,
        op9_quality_rules,
        op10_decontamination,
        op11_repeated_bytes,
        op12_ranked_search,
        op13_conversation_repair,
        pipeline,
    )
}

#: None for what SQL cannot express (a tokenizer, a model, Spark's hash)
ORACLE_SQL = {
    "pipeline": corpus_pipeline.ORACLE_SQL,
    "op4_near_dedup": near_dedup.ORACLE_OP4,
    "op8_substring_dedup": substrings.ORACLE_OP8,
    "op9_quality_rules": quality_rules.ORACLE_OP9,
    "op10_decontamination": decontaminate.ORACLE_OP10,
    "op11_repeated_bytes": repeats.ORACLE_OP11,
    "op12_ranked_search": search.ORACLE_OP12,
    "op13_conversation_repair": repair.ORACLE_OP13,
}
