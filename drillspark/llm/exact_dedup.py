"""Operator 10, exact dedup: a persistent digest index, bucketed and sorted by hash.

New data is reduced to one row a digest before any shuffle, met with the index by a sort-merge anti-join, and what the index
has not seen is appended. DataFrame operations only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, shuffle_partitions, spread_lookup, store

SCHEMA = "digest BINARY, doc_id BIGINT"


class DigestIndex:
    """A table of (digest, doc_id of the accepted row) in ``path``; it can be opened again by any later session."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """``buckets`` counts only when the index is made; a later session has to name the same number."""
        self.spark, self.buckets = spark, buckets or shuffle_partitions(spark)
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({SCHEMA}) USING parquet OPTIONS ('compression' 'zstd') CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Index ``docs`` (doc_id, text) and return a row for each: doc_id, keep_id, group_size, kept, text_sha256.

        A null text counts as empty. Of equal texts new to the index, the largest doc_id stays (nulls come last); a text that
        the index has already stays with the row accepted then. group_size counts the rows of this call. Repeated rows of one
        doc_id share one verdict. No documents give no rows. Other columns are ignored. The call can be repeated after a
        failure: what was appended is then met again by the anti-join.
        """
        # digests are written once, so the texts are read once
        digests = store(docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest")), "digests", "zstd")
        groups = store(digests.groupBy("digest").agg(F.max("doc_id").alias("newest"), F.count(F.lit(1)).alias("group_size")), "digest-groups", "zstd")
        unseen = groups.join(self.table().hint("merge"), "digest", "left_anti")
        unseen.select("digest", F.col("newest").alias("doc_id")).repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        verdicts = groups.select("digest", "group_size").join(self.table().select("digest", F.col("doc_id").alias("keep_id")).hint("merge"), "digest")
        out = spread_lookup(digests, verdicts, "digest", "group_size", digests.count(), F.col("doc_id"), weights=groups)
        return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Exact dedup against the index in ``path``, or against a new one in the shared folder."""
    spark = docs.sparkSession
    return DigestIndex(spark, path or fresh_path(spark, "digest-index"), buckets).ingest(docs)
