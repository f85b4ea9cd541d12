"""The queries that apply each text operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import avi, bpe, line_dedup, mixing, oracles, pii, quality_model, quality_rules, quotes, simhash
from gridloom.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.summary(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf_dir, "documents"))


def op6_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avi.summary(table(spark, sf_dir, "documents"))


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.threads(table(spark, sf_dir, "conversations"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.summary(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_deleted", "text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_mixing, op3_simhash, op4_bpe, op5_token_counts, op6_avi, op7_quotes, op8_quality, op9_line_dedup, op10_quality_rules)}
ORACLES = oracles.ORACLES
