"""Aggregates and the 24-hour rule over time_log (AGG1-AGG7, AGG22, AGG26, WIN1, WIN9, WIN12, VAL1, VAL2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import clock_exact, span

STANDARD_HOURS, TOLERANCE = 24.0, 0.01


def exact_sum(hours: Column, digits: int = 4) -> Column:
    """Sums as decimals, so order and partitioning never show."""
    return F.sum(hours.cast(f"decimal(18,{digits})"))


def day_hours(log: DataFrame) -> DataFrame:
    """AGG1: report_id, sum_hours, entries."""
    return log.groupBy("report_id").agg(exact_sum(F.col("hours")).cast("double").alias("sum_hours"), F.count(F.lit(1)).alias("entries"))


def category_hours(log: DataFrame) -> DataFrame:
    """AGG2, AGG4: hours and share of each category in a report; code UNKNOWN is a category of its own."""
    category = F.when(F.col("code") == "UNKNOWN", "UNKNOWN").otherwise(F.coalesce("category", F.when(F.col("is_npt"), "npt").otherwise("flat")))
    sums = log.groupBy("report_id", category.alias("category")).agg(exact_sum(F.col("hours")).cast("double").alias("hours"))
    total = F.sum("hours").over(W.partitionBy("report_id"))
    return sums.withColumn("share", F.col("hours") / F.coalesce(F.nullif(total, F.lit(0.0)), F.lit(1.0)))


def code_hours(log: DataFrame) -> DataFrame:
    """AGG3, SRT4: hours of each code in a report, most first."""
    return log.groupBy("report_id", "code").agg(exact_sum(F.col("hours")).cast("double").alias("hours")).orderBy("report_id", F.desc("hours"), "code")


def report_kpi(log: DataFrame) -> DataFrame:
    """AGG5-AGG7, AGG26, AGG28: one pass for all conditional totals of a report."""
    hours, drilled = F.col("hours"), F.col("code").isin("DRILL", "REAM")
    when = lambda cond: F.coalesce(exact_sum(F.when(cond, hours)), F.lit(0)).cast("double")
    connection = F.col("ilt_action") == "connection"
    return log.groupBy("report_id").agg(
        F.count(F.lit(1)).alias("entries"), exact_sum(hours).cast("double").alias("sum_hours"),
        when(F.col("category") == "productive").alias("productive_hours"), when(F.col("category") == "flat").alias("flat_hours"),
        when(F.col("is_npt")).alias("npt_hours"), F.count_if("is_npt").alias("npt_entries"),
        F.nullif(F.bround(when(drilled), 2), F.lit(0.0)).alias("drill_hours"),
        F.nullif(F.bround(when(F.col("code") == "REAM"), 2), F.lit(0.0)).alias("ream_hours"),
        F.count_if(connection).alias("connections"), when(connection).alias("connection_hours"),
    )


def cumulative(log: DataFrame) -> DataFrame:
    """WIN9."""
    w = W.partitionBy("report_id").orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    return log.withColumn("cum_hours", F.bround(exact_sum(F.col("hours")).over(w).cast("double"), 2))


def interval_sweep(rows: DataFrame, key: str = "report_id", start: str = "start_h", end: str = "end_h", tolerance: float = TOLERANCE) -> DataFrame:
    """WIN1 row by row: the gap and the overlap before each interval, by a running maximum of ends."""
    before = W.partitionBy(key).orderBy(start, end).rowsBetween(W.unboundedPreceding, -1)
    s, cursor = F.col(start), F.greatest(F.coalesce(F.max(end).over(before), F.lit(0.0)), F.lit(0.0))
    swept = rows.withColumn("_cursor", cursor)
    gap = F.when(s > F.col("_cursor") + tolerance, s - F.col("_cursor")).otherwise(0.0)
    over = F.when(s < F.col("_cursor") - tolerance, F.least("_cursor", end) - s).otherwise(0.0)
    return swept.withColumn("gap", gap).withColumn("overlap", over).withColumnRenamed("_cursor", "cursor")


def continuity(log: DataFrame, expected: float = STANDARD_HOURS, tolerance: float = TOLERANCE) -> DataFrame:
    """WIN1, AGG22: gaps and overlaps of a report's clocked entries; null unless four fifths of them (two at least) have clocks."""
    s, e = clock_exact(F.col("start")), clock_exact(F.col("end"))
    clocked = log.withColumn("start_h", s).withColumn("_e", e).withColumn("end_h", F.when(F.col("_e") < F.col("start_h"), F.lit(expected)).otherwise(F.col("_e")))
    both = F.col("start_h").isNotNull() & F.col("end_h").isNotNull()
    counts = clocked.groupBy("report_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(both).alias("_clocked"))
    swept = interval_sweep(clocked.where(both)).groupBy("report_id").agg(
        F.sum("gap").alias("_gap"), F.sum("overlap").alias("_overlap"), F.max("end_h").alias("_last"),
        F.array_sort(F.collect_list(F.when(F.col("gap") > 0, F.concat_ws("-", F.format_number("cursor", 2), F.format_number("start_h", 2))))).alias("gaps"),
    )
    ok = F.col("_clocked") >= F.greatest(F.lit(2), F.floor(F.col("_n") * 0.8))
    trailing = F.when(F.col("_last") < expected - tolerance, expected - F.col("_last")).otherwise(0.0)
    return counts.join(swept, "report_id", "left").select("report_id", F.when(ok, F.bround(F.col("_gap") + trailing, 4)).alias("gap_hours"), F.when(ok, F.bround("_overlap", 4)).alias("overlap_hours"), F.when(ok, F.col("gaps")).alias("gaps"))


def span_mismatch(log: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """VAL2: entries whose clocks and hours disagree."""
    width = span(clock_exact(F.col("start")), clock_exact(F.col("end")))
    return log.withColumn("span_hours", width).where(F.abs(F.col("span_hours") - F.col("hours")) > tolerance)


def fill_gap(log: DataFrame, expected: float = STANDARD_HOURS, tolerance: float = TOLERANCE) -> DataFrame:
    """WIN12: a report short of its hours gets one UNKNOWN row with what is missing; columns that the log has and the row lacks are null."""
    short = log.groupBy("report_id").agg(exact_sum(F.col("hours")).cast("double").alias("_sum"), F.max("ord").alias("_ord")).where(F.col("_sum") < expected - tolerance)
    row = short.select(
        "report_id", (F.col("_ord") + 1).alias("ord"), F.bround(expected - F.col("_sum"), 4).alias("hours"), F.lit("UNKNOWN").alias("code"), F.lit("flat").alias("category"),
        F.lit(False).alias("is_npt"), F.lit("derived_from_total").alias("duration_source"),
    ).select(*[c for c in ("report_id", "ord", "hours", "code", "category", "is_npt", "duration_source") if c in log.columns])
    return log.unionByName(row, allowMissingColumns=True)


def verify(log: DataFrame, expected: float = STANDARD_HOURS, tolerance: float = TOLERANCE) -> DataFrame:
    """VAL1: valid by the reported sum; sum_hours is the sum after filling; delta keeps the reported one. Messages come in rule order (AGG24)."""
    sums = day_hours(log).withColumn("delta", F.bround(F.col("sum_hours") - expected, 4))
    spans = span_mismatch(log, tolerance).groupBy("report_id").agg(F.count(F.lit(1)).alias("span_mismatches"))
    joined = sums.join(continuity(log, expected, tolerance), "report_id").join(spans, "report_id", "left")
    valid = F.abs("delta") <= tolerance + 1e-9
    messages = F.array_compact(F.array(
        F.when(~valid, F.format_string("hours sum to %.2f, not %.2f", F.col("sum_hours"), F.lit(expected))),
        F.when(F.col("delta") < -tolerance, F.format_string("%.2f h filled as UNKNOWN", -F.col("delta"))),
        F.when(F.col("gap_hours") > 0, F.concat(F.lit("gaps: "), F.array_join(F.slice("gaps", 1, 6), ", "))),
        F.when(F.col("overlap_hours") > 0, F.format_string("%.2f h overlap", F.col("overlap_hours"))),
        F.when(F.col("span_mismatches") > 0, F.format_string("%d entries whose clocks and hours disagree", F.col("span_mismatches"))),
    ))
    filled = F.when(F.col("delta") < -tolerance, F.lit(expected)).otherwise(F.bround("sum_hours", 4))
    return joined.select("report_id", valid.alias("valid"), F.lit(expected).alias("expected_hours"), filled.alias("sum_hours"), "delta", "gap_hours", "overlap_hours", "gaps", messages.alias("messages"))
