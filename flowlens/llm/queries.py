"""Registered queries of this subpackage: ``opN_<name>(spark, sf_dir)`` applies operator N to
its whole table and derives the columns of its contract; ORACLE has their DuckDB SQL where SQL
can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import (bpe, decontamination, edit_embedding, hard_negatives, language_id, lexical_search, quality, secret_scan, sharding,
                          simhash, token_counts, toxicity, warc)
from flowlens.llm.base import read_table, scratch
from flowlens.llm.oracle import ORACLE  # noqa: F401


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_read_back(read_table(spark, sf_dir, "pages"), scratch(spark, "warc"), keep=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignment(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.with_edits(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_warc, op3_decontamination, op4_sharding, op5_token_counts, op6_quality,
                                   op7_simhash, op8_edit_fingerprints, op9_secret_scan, op10_byte_bpe, op11_lexical_search,
                                   op12_language_id, op13_hard_negatives)}
