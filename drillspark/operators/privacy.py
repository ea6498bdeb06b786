"""The privacy gate (PV1, PV2, PV4, PV5, AGG23, JN20-JN22, FLT21, SNK12)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import norm_name

SUFFIX = r"(?i)(" + "|".join(re.escape(s) for s in sorted(dims.ORG_SUFFIXES, key=len, reverse=True)) + ")"
LOOK_BACK = 12


def allowlist(manifest: DataFrame) -> DataFrame:
    """AGG23, SET1, FLT21: (kind, name) of invented wells, organisations, fields and rigs of a manifest's synthetic items."""
    kinds = (("well", "well_name"), ("org", "operator"), ("org", "contractor"), ("field", "field"), ("rig", "rig"))
    rows = manifest.where(F.col("synthetic").eqNullSafe(F.lit(True))).select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), norm_name(F.col(c)).alias("name")) for k, c in kinds if c in manifest.columns])))
    return rows.where("name <> ''").distinct()


def exempt(value: Column) -> Column:
    """PV4, PV5: redacted, or of a public dataset."""
    low = F.lower(value)
    return value.rlike(dims.REDACTED) | F.greatest(*[F.contains(low, F.lit(m)) for m in dims.PUBLIC_MARKERS])


def covered(name: Column, known: list[str]) -> Column:
    """JN22: a known name that makes up four fifths of the candidate; the list is bounded by the caller."""
    return F.exists(F.array(*[F.lit(k) for k in known]) if known else F.array().cast("array<string>"), lambda k: F.contains(name, k) & (F.length(k) >= 0.8 * F.length(name)))


def name_findings(values: DataFrame, allow: DataFrame) -> DataFrame:
    """JN20, JN21: values (location, kind, value) that look like a real organisation or well and are on no list: (severity, location, message, evidence)."""
    rows = values.where(F.trim("value") != "").withColumn("name", norm_name(F.col("value")))
    unknown = rows.join(allow.select("kind", "name"), ["kind", "name"], "left_anti").where(~exempt(F.col("value")))
    org, well = (F.col("kind") == "org") & F.col("value").rlike(SUFFIX), (F.col("kind") == "well") & F.trim("value").rlike(dims.WELL_SHAPE)
    message = F.when(org, F.concat(F.lit("may be a real organisation: "), F.regexp_extract("value", SUFFIX, 1))).when(well, "may be a real well")
    return unknown.where(org | well).select(F.lit("error").alias("severity"), "location", message.alias("message"), F.left("value", F.lit(60)).alias("evidence"))


def mentions(texts: DataFrame, allow: DataFrame) -> DataFrame:
    """PV2, JN22: every suffix of an organisation in texts (location, text) with up to 12 characters before it; known, redacted and public names are exempt.

    Places are found by laying what stands between matches end to end, so mentions that overlap are all seen. A known name that
    covers a candidate is one of its long substrings, so names meet the list by equality and no list is broadcast unchecked.
    """
    found = F.regexp_extract_all("text", F.lit(SUFFIX), F.lit(1))
    between = F.split("text", SUFFIX, -1)

    def step(acc, x):
        # no more than the look-back is kept of what has been passed
        before = F.right(F.concat(acc["seen"], x["between"]), F.lit(LOOK_BACK))
        candidate = F.struct(F.concat(before, x["suffix"]).alias("candidate"), x["suffix"].alias("suffix"))
        passed = F.struct(F.right(F.concat(before, x["suffix"]), F.lit(LOOK_BACK)).alias("seen"), F.concat(acc["out"], F.array(candidate)).alias("out"))
        return F.when(x["suffix"].isNull(), acc).otherwise(passed)

    start = F.struct(F.lit("").alias("seen"), F.array().cast("array<struct<candidate:string,suffix:string>>").alias("out"))
    rows = texts.where(F.col("text").rlike(SUFFIX)).select("location", F.inline(F.aggregate(F.arrays_zip(found.alias("suffix"), between.alias("between")), start, step, lambda a: a["out"])))
    rows = rows.withColumn("name", norm_name(F.col("candidate"))).where(~exempt(F.col("candidate")))
    orgs = allow.where("kind = 'org'").select(F.col("name").alias("known")).distinct()
    n = F.length("name")
    widths = F.sequence(F.ceil(n * 0.8).cast("int"), n)
    parts = F.flatten(F.transform(widths, lambda w: F.transform(F.sequence(F.lit(1), n - w + 1), lambda i: F.substring(F.col("name"), i, w))))
    known = rows.where(n > 0).select("name").distinct().select("name", F.explode(F.array_distinct(parts)).alias("known")).join(orgs, "known", "left_semi").select("name").distinct()
    open_ = rows.join(known, "name", "left_anti")
    return open_.select(F.lit("warning").alias("severity"), "location", F.concat(F.lit("text has the shape of an organisation: "), F.col("suffix")).alias("message"), F.concat(F.lit("…"), F.col("candidate")).alias("evidence"))


def scan(manifest: DataFrame, texts: DataFrame, allow: DataFrame, check_fields: bool = False) -> DataFrame:
    """PV1: findings over manifest items and free texts; items not marked synthetic and files outside the samples are errors."""
    names = [("org", "operator"), ("org", "contractor"), ("well", "well_name")] + ([("field", "field"), ("rig", "rig")] if check_fields else [])
    values = manifest.select(F.inline(F.array(*[F.struct(F.concat(F.col("file"), F.lit(f":{c}")).alias("location"), F.lit(k).alias("kind"), F.coalesce(F.col(c), F.lit("")).alias("value")) for k, c in names])))
    real = manifest.where(~F.col("synthetic").eqNullSafe(F.lit(True))).select(F.lit("error").alias("severity"), F.col("file").alias("location"), F.lit("is not marked synthetic").alias("message"), F.col("synthetic").cast("string").alias("evidence"))
    outside = manifest.where(F.col("file").rlike(r"(^/|\.\.)")).select(F.lit("error").alias("severity"), F.col("file").alias("location"), F.lit("lies outside the dataset").alias("message"), F.col("file").alias("evidence"))
    return real.unionByName(outside).unionByName(name_findings(values, allow)).unionByName(mentions(texts, allow))


def rendered(findings: DataFrame) -> DataFrame:
    """SNK12: errors first, then by place."""
    rank = F.when(F.col("severity") == "error", 0).otherwise(1)
    return findings.orderBy(rank, "location").select(F.concat_ws("  ", F.when(rank == 0, "✗").otherwise("!"), F.concat(F.lit("["), F.col("location"), F.lit("]")), "message", "evidence").alias("line"))
