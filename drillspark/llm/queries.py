"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table
from .exact_dedup import exact_dedup
from .language import identify
from .language import learn as learn_languages
from .lines import line_dedup
from .near_dedup import near_dedup
from .packing import Packing, pack
from .pieces import round_trip
from .quality import quality
from .secrets import secret_report
from .substring import substring_dedup
from .toxicity import toxicity


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("clean_text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Packing(public_tokenizers.path("word_bpe_49k.json")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_languages(docs))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_quality_rules, op3_secret_scans, op4_sentencepiece, op5_best_fit_packing, op6_substring_dedup, op7_toxicity, op8_language_id, op9_minhash_near_dedup, op10_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
