"""Reports of a well in order of date (WIN2-WIN5, SRT1). One shuffle by well; nothing outside a well is looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def carry_forward(reports: DataFrame) -> DataFrame:
    """WIN2, WIN3: start depth, progress and rate of penetration from the well's previous depth that is not zero.

    Only where one of start depth and progress is missing and the depth has not fallen. Rows without a well name are left alone.
    ``file_ord`` decides between equal dates.
    """
    order = W.partitionBy("well_name").orderBy("dtim_start", "file_ord").rowsBetween(W.unboundedPreceding, -1)
    previous = F.last(F.nullif(F.col("md_m"), F.lit(0.0)), ignorenulls=True).over(order)
    out = reports.withColumn("_prev", F.when(F.coalesce(F.col("well_name"), F.lit("")) != "", previous))
    md = F.nullif(F.col("md_m"), F.lit(0.0))
    open_ = (F.col("md_in_start_m").isNull() | F.col("progress_m").isNull()) & (md >= F.col("_prev"))
    start = F.when(open_, F.coalesce("md_in_start_m", "_prev")).otherwise(F.col("md_in_start_m"))
    progress = F.when(open_, F.coalesce("progress_m", F.bround(md - F.col("_prev"), 2))).otherwise(F.col("progress_m"))
    out = out.withColumn("_start", start).withColumn("progress_m", progress).withColumn("md_in_start_m", F.col("_start")).drop("_start", "_prev")
    rate = F.bround(F.try_divide(F.col("progress_m"), F.nullif(F.col("etim_drill_h"), F.lit(0.0))), 2)
    return out.withColumn("rop_av_m_per_h", F.coalesce("rop_av_m_per_h", F.when(F.col("progress_m") != 0, rate)))


def depth_regression(reports: DataFrame) -> DataFrame:
    """WIN5: reports whose depth is below the well's last known one."""
    order = W.partitionBy("well_name").orderBy("dtim_start", "file_ord").rowsBetween(W.unboundedPreceding, -1)
    return reports.withColumn("previous_md_m", F.last("md_m", ignorenulls=True).over(order)).where(F.col("md_m") + 1e-6 < F.col("previous_md_m"))


def bit_continuity(bits: DataFrame) -> DataFrame:
    """WIN4: bits that start above where the last one came out."""
    order = W.partitionBy("report_id").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    return bits.withColumn("previous_out_m", F.last("depth_out_m", ignorenulls=True).over(order)).where(F.col("depth_in_m") + 0.55 < F.col("previous_out_m"))


def ordered(reports: DataFrame) -> DataFrame:
    """SRT1."""
    return reports.orderBy("well_name", "dtim_start", "file_ord")
