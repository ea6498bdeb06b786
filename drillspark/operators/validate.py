"""Rules over reports (VAL3-VAL6): each is a row of (field, severity, condition, message), all checked in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import dims


def broken(rules: list[tuple[int, tuple[str, str, Column, Column]]]) -> Column:
    """Numbered rules as an array of (field, severity, message, ord) of those that a row breaks."""
    return F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(f).alias("field"), F.lit(s).alias("severity"), msg.cast("string").alias("message"), F.lit(i).alias("ord"))) for i, (f, s, cond, msg) in rules]))


def issues(rows: DataFrame, keys: list[str], rules: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """keys, field, severity, message, ord: one row for every rule that a row breaks."""
    return rows.select(*keys, F.inline(broken(list(enumerate(rules)))))


def _off(a: Column, b: Column) -> Column:
    return F.try_divide(F.abs(a - b), F.abs(b))


def numeric_issues(reports: DataFrame, log: DataFrame, bits: DataFrame, mud: DataFrame) -> DataFrame:
    """VAL3: report_id, field, severity, message of all numeric rules."""
    md, start, progress = F.nullif(F.col("md_m"), F.lit(0.0)), F.col("md_in_start_m"), F.col("progress_m")
    drilled = log.groupBy("report_id").agg(F.sum(F.when(F.col("code").isin("DRILL", "REAM"), F.col("hours"))).alias("_drill"))
    r = reports.join(drilled, "report_id", "left")
    rate = F.bround(F.try_divide(progress, F.col("_drill")), 2)
    rop = F.col("rop_av_m_per_h")
    of_reports = issues(r, ["report_id"], [
        ("md_m", "error", md + 1e-9 < start, F.format_string("depth %.2f is above its start %.2f", md, start)),
        ("progress_m", "warning", F.abs(F.bround(md - start, 2) - progress) > 0.55, F.format_string("progress %.2f, but depths differ by %.2f", progress, md - start)),
        ("tvd_m", "error", F.col("tvd_m") > md + 1e-9, F.format_string("vertical depth %.2f exceeds depth %.2f", F.col("tvd_m"), md)),
        ("rop_av_m_per_h", "warning", (F.col("_drill") > 0.1) & (_off(rop, F.nullif(rate, F.lit(0.0))) > 0.35), F.format_string("rate %.2f, from progress %.2f", rop, rate)),
    ])
    cause = F.coalesce(F.col("npt_category"), F.lit(""))
    npt = F.col("category") == "npt"
    of_log = issues(log, ["report_id"], [
        ("hours", "error", F.col("hours") < 0, F.format_string("negative hours %.2f", F.col("hours"))),
        ("is_npt", "error", npt != F.col("is_npt"), F.concat(F.lit("flag and category disagree: "), F.col("category"))),
        ("code", "warning", (F.col("code") == "UNKNOWN") & (F.col("duration_source") == "reported"), F.concat(F.lit("unknown operation: "), F.coalesce("operation", F.lit("")))),
        ("npt_category", "warning", (F.col("code") == "REPAIR") & (cause == ""), F.lit("repair without a cause")),
    ])
    width = F.bround(F.col("depth_out_m") - F.col("depth_in_m"), 2)
    bit_rate = F.bround(F.try_divide(F.col("footage_m"), F.nullif(F.col("hours"), F.lit(0.0))), 2)
    previous = F.last("depth_out_m", ignorenulls=True).over(W.partitionBy("report_id").orderBy("ord").rowsBetween(W.unboundedPreceding, -1))
    of_bits = issues(bits.withColumn("_prev", previous), ["report_id"], [
        ("depth_out_m", "error", width < 0, F.format_string("bit comes out at %.2f above %.2f", F.col("depth_out_m"), F.col("depth_in_m"))),
        ("footage_m", "warning", F.abs(width - F.col("footage_m")) > 0.55, F.format_string("footage %.2f, but depths differ by %.2f", F.col("footage_m"), width)),
        ("rop_m_per_h", "warning", _off(F.col("rop_m_per_h"), F.nullif(bit_rate, F.lit(0.0))) > 0.2, F.format_string("bit rate %.2f, from footage %.2f", F.col("rop_m_per_h"), bit_rate)),
        ("depth_in_m", "warning", F.col("depth_in_m") + 0.55 < F.col("_prev"), F.format_string("bit goes in at %.2f, the last came out at %.2f", F.col("depth_in_m"), F.col("_prev"))),
    ])
    of_mud = issues(mud, ["report_id"], [
        ("density_gcc", "warning", ~F.col("density_gcc").between(0.5, 3.0), F.format_string("density %.2f", F.col("density_gcc"))),
        ("fl_ml", "error", F.col("fl_ml") < 0, F.format_string("fluid loss %.2f", F.col("fl_ml"))),
    ])
    return of_reports.unionByName(of_log).unionByName(of_bits).unionByName(of_mud)


def backfill_bit_rate(bits: DataFrame) -> DataFrame:
    """The rate that VAL3 fills in where a bit has none."""
    rate = F.bround(F.try_divide(F.col("footage_m"), F.nullif(F.col("hours"), F.lit(0.0))), 2)
    return bits.withColumn("rop_m_per_h", F.coalesce("rop_m_per_h", F.when(F.col("footage_m") != 0, rate)))


def verdicts(verified: DataFrame, found: DataFrame) -> DataFrame:
    """VAL4, FLT22: a report is ok if its time log is valid and no rule of severity error is broken."""
    errors = found.groupBy("report_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = verified.select("report_id", "valid").join(errors, "report_id", "left").na.fill(0, ["errors", "warnings"])
    return out.withColumn("ok", F.col("valid") & (F.col("errors") == 0))


#: Allowed values of the report's enumerations.
ENUMS = {"category": ("productive", "flat", "npt"), "npt_category": ("equipment", "wellbore", "weather", "logistics", "third_party", "safety", "other"), "npt_responsibility": ("contractor", "operator", "third_party", "force_majeure", "undetermined"), "ilt_action": ("connection", "trip_stand", "ream_cycle", "circulate_cycle"), "duration_source": ("reported", "derived_from_clock", "derived_from_total")}


def schema_errors(reports: DataFrame, log: DataFrame) -> DataFrame:
    """VAL5, VAL6, SRC10: required fields, enumerations, ranges and clock shapes as one constraint table; sorted by path when read (SRT7)."""
    need = lambda c: (c, "error", F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit("is required"))
    ranged = lambda c, a, b: (c, "error", ~F.col(c).between(a, b), F.concat(F.lit(f"is not in {a} to {b}: "), F.col(c).cast("string")))
    of_reports = issues(reports, ["report_id"], [*[need(c) for c in ("well_name", "dtim_start", "dtim_end", "md_m")], ranged("md_m", 0, 20000), ranged("hole_diameter_in", 0, 60)])
    enums = [(c, "error", ~F.col(c).isin(list(v)), F.concat(F.lit("is not allowed: "), F.col(c))) for c, v in ENUMS.items() if c in log.columns]
    codes = ("code", "error", ~F.col("code").isin([o.code for o in dims.OPERATIONS]), F.concat(F.lit("is not allowed: "), F.col("code")))
    clocks = [(c, "error", ~F.col(c).rlike(r"^([01]\d|2[0-4]):[0-5]\d$"), F.concat(F.lit("is no clock: "), F.col(c))) for c in ("start", "end") if c in log.columns]
    return of_reports.unionByName(issues(log, ["report_id"], [codes, *enums, *clocks, ranged("hours", 0, 24)]))
