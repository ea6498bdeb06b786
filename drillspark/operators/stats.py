"""Statistics of a dataset (VAL11, AGG8-AGG15, JN13, SRT3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import OPERATIONS
from .classify import category_of


def counters(rows: DataFrame, columns: list[str]) -> DataFrame:
    """AGG8: all counters at once: each column alone, all together, and the total, by grouping sets."""
    sets = [[F.col(c)] for c in columns] + [[F.col(c) for c in columns], []]
    return rows.groupingSets(sets, *columns).agg(F.count(F.lit(1)).alias("n")).select(*columns, "n")


def dataset_stats(items: DataFrame, truth: DataFrame) -> DataFrame:
    """VAL11: one row over manifest items (file, well_name, report_date, template_id, unit_system, synthetic) and their truths.

    ``truth`` has a row an item: file, phase, sum_hours, npt_hours, connection_count, time_log (array of code, hours,
    npt_category), bit_records, mud. Items without truth are counted as samples (JN13). All figures are counts and sums; which
    items lack a truth or break the rule, and which wells there are, ``without_truth``, ``violations`` and ``wells`` say as tables.
    """
    entry = lambda cond: F.coalesce(F.aggregate(F.filter("time_log", cond), F.lit(0.0), lambda a, e: a + F.coalesce(e["hours"], F.lit(0.0))), F.lit(0.0))
    is_npt = lambda e: F.coalesce(e["npt_category"], F.lit("")) != ""
    of = lambda e: category_of(e["code"], OPERATIONS)
    joined = items.join(truth.withColumn("_there", F.lit(True)), "file", "left")
    there = F.col("_there").isNotNull()
    hours = lambda c: F.bround(F.coalesce(F.sum(c), F.lit(0.0)), 2)
    flow = F.col("mud").isNotNull()
    valid = F.abs(F.coalesce("sum_hours", F.lit(0.0)) - 24) <= 0.01
    out = joined.agg(
        F.count(F.lit(1)).alias("sample_count"), F.count_if(there).alias("with_truth"), F.count_if(~there).alias("missing"),
        F.count_distinct(F.nullif(F.col("well_name"), F.lit(""))).alias("wells"), F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"),
        F.count_if("synthetic").alias("synthetic"), F.count_if(there & valid).alias("compliant"), F.count_if(there & ~valid).alias("violations"),
        hours(F.when(there, F.col("sum_hours"))).alias("total_hours"), hours(F.when(there, entry(is_npt))).alias("npt_hours"),
        hours(F.when(there, entry(lambda e: ~is_npt(e) & (of(e) == "productive")))).alias("productive_hours"), hours(F.when(there, entry(lambda e: ~is_npt(e) & (of(e) != "productive")))).alias("flat_hours"),
        F.count_if(there & (F.col("npt_hours") > 0)).alias("npt_days"), F.coalesce(F.sum("connection_count"), F.lit(0)).alias("connections"), F.count_if(F.col("connection_count") > 0).alias("connection_days"),
        F.count_if(F.size("bit_records") > 0).alias("bit_days"), F.count_if(flow).alias("mud_days"),
    )
    return out.withColumn("npt_rate", F.try_divide("npt_hours", "total_hours")).withColumn("compliance", F.try_divide("compliant", "with_truth"))


def without_truth(items: DataFrame, truth: DataFrame) -> DataFrame:
    """JN13: the files of items that have no truth."""
    return items.select("file").join(truth.select("file"), "file", "left_anti")


def violations(items: DataFrame, truth: DataFrame) -> DataFrame:
    """AGG11: (file, sum_hours) of items whose day does not sum to 24 hours."""
    return items.select("file").join(truth.select("file", "sum_hours"), "file").where(F.abs(F.coalesce("sum_hours", F.lit(0.0)) - 24) > 0.01)


def wells(items: DataFrame) -> DataFrame:
    """AGG9: the distinct wells."""
    return items.where(F.col("well_name") != "").select("well_name").distinct()


def availability(rows: DataFrame, fields: list[str]) -> DataFrame:
    """AGG14: (field, available): rows that have a value, in one pass."""
    counts = rows.agg(*[F.count(c).alias(c) for c in fields])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("available")) for c in fields])))


def most_common(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """SRT3: values by count, most first; of equal counts the one that sorts first."""
    out = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return out.limit(n) if n else out
