"""A training corpus in five stages, each one operator of ``drillspark.llm``.

Every stage is written to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drillspark.llm.common import store, table
from drillspark.llm.language import known_language
from drillspark.llm.lines import line_dedup
from drillspark.llm.near_dedup import near_dedup
from drillspark.llm.packing import Packing, pack
from drillspark.llm.secrets import redact


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected; ``lang`` is the identified one. Null texts and those without a letter go."""
    return known_language(docs)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows. None is dropped, null texts stay null."""
    names = tuple(next(n for n in (f"{'_' * k}n_{what}" for k in range(1, 99)) if n not in docs.columns) for what in ("lines", "dropped"))
    out = line_dedup(docs, counts=names)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(names[1]) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; rows without doc_id stay."""
    gone = store(near_dedup(docs).where("not kept and doc_id is not null").select("doc_id").distinct(), "near-copies")
    rows = gone.count()
    return docs.join(F.broadcast(gone) if rows * 16 <= 4_000_000 else gone, "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark; n_chars follows. None is dropped, null texts stay null, repeated rows stay repeated."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens. A null or empty text is one piece of one token."""
    return pack(docs, Packing(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("language_id", language_id), ("line_dedup", boilerplate), ("near_dedup", near_duplicates), ("secret_scans", secrets), ("best_fit_packing", packing)]

#: Language models, Jaccard components and packing have no SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
