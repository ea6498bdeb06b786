"""Operator 3, secret scans: an incremental ledger of blobs.

Every version of a text is addressed by its SHA-256. Only pairs of blob and rule version that the ledger lacks are scanned,
and findings are joined back to every path (document) that holds the blob. DataFrame operations only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_SHARE, deal_lookup, fresh_path, shuffle_partitions, spread_lookup, store


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; a match counts if its ``group`` has ``least`` characters. ``needs`` is a text that every match contains."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: str = ""


#: The three kinds of the contract, in its order. A run of hex digits is matched from 32 on, which selects the same runs.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Kinds that the method adds.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, "eyJ"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, "gh"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "xox"),
    Rule("map", r"AIza[A-Za-z0-9_-]{35}", 0, 1, "AIza"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<start:int,end:int,rank:int,kind:string>>"


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in code points: what lies between matches and the matches themselves, laid end to end."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)

    def step(acc, x):
        start = acc["at"] + F.length(x["between"])
        end = start + F.length(x["whole"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"))
        # the last piece has no match after it: nulls keep what is there
        return F.when(x["whole"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.when(F.length(x["judged"]) >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans")))

    none = F.array().cast(SPAN)
    found = F.aggregate(F.arrays_zip(whole.alias("whole"), judged.alias("judged"), between.alias("between")), F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    hit = F.size(whole) > 0
    return F.when(text.contains(rule.needs) & hit if rule.needs else hit, found).otherwise(none)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns but text, and ``found``: the spans of all rules."""
    found = F.concat(*[_spans(F.col("text"), r, i) for i, r in enumerate(rules)])
    return texts.withColumn("found", found).drop("text")


class SecretLedger:
    """Two tables under ``path`` that any later session can open again.

    ``findings`` has a row for each blob and rule version that has been scanned; ``versions`` says which blob a path (doc_id) had
    in which ingested batch, so what an old version held can be joined back to all paths that ever had it.
    """

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES, buckets: int | None = None):
        self.spark, self.rules, self.version, self.buckets = spark, rules, rule_version(rules), buckets or shuffle_partitions(spark)
        tag = hashlib.md5(path.encode()).hexdigest()[:16]
        self.name, self.history_name = f"secret_ledger_{tag}", f"secret_versions_{tag}"
        clustered = f"CLUSTERED BY (blob) SORTED BY (blob) INTO {self.buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (blob BINARY, rule_version STRING, found {SPAN.replace('array<struct<', 'ARRAY<STRUCT<')}) USING parquet {clustered} LOCATION '{path}/findings'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.history_name} (doc_id BIGINT, blob BINARY, batch BIGINT) USING parquet LOCATION '{path}/versions'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name).where(F.col("rule_version") == self.version)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Scan what the ledger lacks of ``docs`` (doc_id, text) and return a row for each: doc_id, blob, found (spans).

        A null text is an empty one and holds nothing. Copies and repeated rows are scanned once. No documents give no rows. The
        call makes one batch of versions; it can be repeated after a failure, which makes another batch of the same blobs.
        """
        blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
        paths = store(docs.select("doc_id", blob.alias("blob")), "blob-paths")
        batch = self.spark.table(self.history_name).agg(F.coalesce(F.max("batch"), F.lit(0)) + 1).first()[0]
        paths.distinct().select("doc_id", "blob", F.lit(batch).cast("long").alias("batch")).write.insertInto(self.history_name)
        # rows without doc_id count as 0 here: they only have to be told from others with another blob
        own = F.coalesce("doc_id", F.lit(0))
        blobs = store(paths.groupBy("blob").agg(F.min(own).alias("_from"), F.count(F.lit(1)).alias("_paths")), "blobs")
        total = paths.count()
        unseen = blobs.join(self.table().select("blob").hint("merge"), "blob", "left_anti")
        hot = [r[0] for r in unseen.where(F.col("_paths") * HOT_SHARE >= F.lit(total)).select("blob").collect()]
        texts = docs.select(own.alias("_own"), F.coalesce("text", F.lit("")).alias("text"), blob.alias("_blob"))
        # one row of each unseen blob goes to the scan. Blobs of many rows are reduced task by task before a text is shuffled;
        # of others one doc_id's rows are met, and both columns are in the key, so copies do not meet in one task
        rare = unseen.where(~F.col("blob").isin(hot)) if hot else unseen
        chosen = rare.join(texts, (F.col("_blob") == F.col("blob")) & (F.col("_own") == F.col("_from"))).groupBy("blob", "_from").agg(F.first("text").alias("text")).select("blob", "text")
        if hot:
            chosen = chosen.union(texts.where(F.col("_blob").isin(hot)).groupBy("_blob").agg(F.first("text").alias("text")))
        once = scan(chosen, self.rules)
        once.select("blob", F.lit(self.version).alias("rule_version"), "found").repartition(self.buckets, "blob").write.insertInto(self.name)
        for name in (self.name, self.history_name):
            self.spark.catalog.refreshTable(name)
        findings = blobs.select("blob", "_paths").join(self.table().select("blob", "found").hint("merge"), "blob")
        return spread_lookup(paths, findings, "blob", "_paths", total, F.col("doc_id"), weights=blobs).drop("_paths")

    def history(self) -> DataFrame:
        """Every version of every path that has been ingested, with its findings by this rule version: doc_id, batch, blob, found.

        ``found`` is null where a version has not been scanned by these rules.
        """
        versions = self.spark.table(self.history_name)
        return deal_lookup(versions, self.table().select("blob", "found"), "blob", F.xxhash64("doc_id", "batch"), versions, "left").select("doc_id", "batch", "blob", "found")


def secret_spans(docs: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets for every document, by the ledger in ``path`` or a new one in the shared folder."""
    spark = docs.sparkSession
    return SecretLedger(spark, path or fresh_path(spark, "secret-ledger"), rules).ingest(docs)


def secret_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, counts of the three base kinds, a digest of their spans, and all spans as kind:start:end."""
    found, base = F.col("found"), [r.kind for r in BASE_RULES]
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in base]
    return secret_spans(docs, path).select("doc_id", *counts, F.sha2(_joined(F.filter(found, lambda s: s["rank"] < len(base))).cast("binary"), 256).alias("base_sha256"), _joined(found).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; all columns stay, n_chars follows the text if it is there.

    Null texts stay null. Spans that overlap are replaced together. Documents without findings pass unchanged.
    """
    found = secret_spans(docs).where(F.size("found") > 0)
    found = store(found.groupBy("doc_id", "blob").agg(F.first("found").alias("found")), "secret-findings")
    rows = found.count()
    others = [c for c in docs.columns if c != "text"]
    # the document's own columns travel in a struct, so none can clash with a name used here
    own = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("doc"), F.col("doc_id").alias("own_id"), F.col("text").alias("body"), F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("own_blob"))
    on = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_blob") == F.col("blob"))
    joined = own.join(F.broadcast(found) if rows * 256 <= 16_000_000 else found, on, "left")
    text = F.col("body")

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out")))

    clean = F.aggregate(F.array_sort("found"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    out = joined.withColumn("clean", F.when(F.col("found").isNull(), text).otherwise(clean))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("clean").alias(c)
        if c == "n_chars":
            return F.when(F.col("found").isNull(), F.col("doc")[c]).otherwise(F.length("clean").cast(docs.schema[c].dataType)).alias(c)
        return F.col("doc")[c].alias(c)

    return out.select(*[column(c) for c in docs.columns])
