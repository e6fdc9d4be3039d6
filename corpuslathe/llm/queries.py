"""Queries of the text operators; names pN_ are those of the problems in TESTDATA.md."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.llm import encoding, formatdup, langid, leakage, neardup, packing, sampling, sql
from corpuslathe.plans.registry import Registry, table

REG = Registry()

SCALARS = {"complexity_queue": "complexity_queue", "text_length_band": "text_length_band", "duration_state": "duration_state"}
ARRAYS = {"scene_tag": "scene_tags_json"}


@REG.query()
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_records(table(spark, d, "prompts"), "prompt_sha256", "prompt_text").select(F.col("id").alias("prompt_sha256"))


@REG.query()
def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restored_records(table(spark, d, "prompts"), "prompt_sha256", "prompt_text").withColumnRenamed("id", "prompt_sha256")


@REG.query(sql.P2_FOUND)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.near_duplicate_pairs(table(spark, d, "prompts"), "prompt_sha256", "prompt_text", width=3, threshold=0.6)
    return pairs.select(F.col("a").alias("prompt_sha256_a"), F.col("b").alias("prompt_sha256_b"))


@REG.query()
def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(table(spark, d, "prompts"), "prompt_sha256", "prompt_text", width=3, threshold=0.6).withColumnRenamed("id", "prompt_sha256")


@REG.query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    _, members = formatdup.format_groups(table(spark, d, "prompts"), "prompt_sha256", "prompt_text")
    pairs = formatdup.pairs_within(members, "content_key", "id")
    return pairs.select(F.col("a").alias("prompt_sha256_a"), F.col("b").alias("prompt_sha256_b"))


@REG.query()
def p3_records(spark: SparkSession, d: str) -> DataFrame:
    groups, _ = formatdup.format_groups(table(spark, d, "prompts"), "prompt_sha256", "prompt_text")
    return groups.select(F.col("representative").alias("prompt_sha256"), "copies")


def _sampled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return sampling.balanced_sample(table(spark, d, "prompt_strata"), table(spark, d, "sampling_targets"), "prompt_sha256", SCALARS, ARRAYS)


@REG.query(sql.P5_FOUND)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[1].where("unmet").select("dimension", "category")


@REG.query()
def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[0].withColumnRenamed("id", "prompt_sha256")


@REG.query()
def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[1]


@REG.query()
def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(spark, d, "documents"), "doc_id", "text")).withColumnRenamed("id", "doc_id")


@REG.query()
def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(packing.pack(packing.token_counts(table(spark, d, "documents"), "doc_id", "text")))


@REG.query(sql.P8_FOUND)
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    got = leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"), budget=1)
    return got.where("distance = 0").select("item_id", "doc_id")


@REG.query()
def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"), budget=2)


def _model(spark: SparkSession, d: str) -> langid.Model:
    return _trained(tuple(langid.training_texts(table(spark, d, "lang_samples"), table(spark, d, "documents"))))


@lru_cache(maxsize=2)
def _trained(texts: tuple[tuple[str, str], ...]) -> langid.Model:
    """The same texts give the same model, so it is trained once a process."""
    return langid.train(list(texts))


@REG.query()
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_languages(table(spark, d, "documents"), _model(spark, d)).where("not labelled").select("doc_id", "lang").distinct()


@REG.query()
def p9_languages(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_languages(table(spark, d, "documents"), _model(spark, d))


@REG.query()
def p9_stretches(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_stretches(table(spark, d, "documents"), _model(spark, d))
