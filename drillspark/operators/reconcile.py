"""Truth against payload (VAL7, JN16, JN17, WIN5): every rule is a column; broken ones are rows of problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.units import approx
from .classify import is_connection, is_npt
from .validate import broken


def _sum(entries: Column, keep) -> Column:
    return F.bround(F.aggregate(F.filter(entries, keep), F.lit(0.0), lambda a, e: a + F.coalesce(e["hours"].cast("double"), F.lit(0.0))), 2)


def _count(entries: Column, keep) -> Column:
    return F.size(F.filter(entries, keep))


def _differs(a: Column, b: Column, same) -> Column:
    """Whether aligned arrays differ somewhere; only asked where they are equally long."""
    return (F.size(a) == F.size(b)) & F.exists(F.zip_with(a, b, same), lambda x: ~x)


def check_dataset(days: DataFrame) -> DataFrame:
    """VAL7: (well_name, report_date, field, severity, message, ord) over days (well_name, report_date, ord, payload struct, truth struct).

    All rules but one look at a day alone. They are judged first, so that a well's days are sorted as depths and broken rules,
    not with payload and truth.
    """
    none = lambda c: F.coalesce(c, F.array())
    before = W.partitionBy("well_name").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    log, truth_log = none(F.col("payload.time_log")), none(F.col("truth.time_log"))
    any_ = lambda e: F.lit(True)
    connection = lambda e: F.coalesce(is_connection(e["operation"]), F.lit(False))
    npt = lambda e: is_npt(e["category"], e["npt_category"])
    details, bits, truth_bits = none(F.col("truth.connections")), none(F.col("payload.bit_records")), none(F.col("truth.bit_records"))
    md, start, progress = F.col("payload.report.md_m"), F.col("payload.report.md_in_start_m"), F.col("payload.report.progress_m")
    flow = F.try_element_at(F.filter(none(F.col("payload.mud")), lambda m: m["sample_point"] == "flowline"), F.lit(1))
    shorter = lambda a, n: F.slice(a, F.lit(1), n)
    pairs = F.least(F.size(bits), F.size(truth_bits))
    b, tb = shorter(bits, pairs), shorter(truth_bits, pairs)
    say = F.lit
    rules = list(enumerate([
        ("sum_hours", "error", ~approx(_sum(log, any_), F.lit(24.0)), F.format_string("hours sum to %.2f", _sum(log, any_))),
        ("time_log", "error", F.size(log) != F.size(truth_log), F.format_string("%d entries, truth has %d", F.size(log), F.size(truth_log))),
        ("time_log.hours", "error", _differs(truth_log, log, lambda t, p: approx(t["hours"], p["hours"])), say("hours of an entry differ")),
        ("time_log.code", "error", _differs(truth_log, log, lambda t, p: t["code"].eqNullSafe(p["code"])), say("the code of an entry differs")),
        ("connection_count", "error", ~F.col("truth.connection_count").eqNullSafe(_count(log, connection)), say("connections differ")),
        ("connections", "error", F.size(details) != _count(log, connection), say("connection details differ in number")),
        ("connection_hours", "error", (F.size(details) == _count(log, connection)) & ~approx(_sum(details, any_), _sum(log, connection), 0.02), say("hours of connections differ")),
        ("npt_hours", "error", ~approx(F.col("truth.npt_hours"), _sum(log, npt), 0.02), say("NPT hours differ")),
        ("npt_events", "error", F.size(none(F.col("truth.npt_events"))) != _count(log, npt), say("NPT entries differ in number")),
        ("md_m", "error", ~approx(F.col("truth.md_m"), md, 0.005), say("depths differ")),
        ("progress_m", "error", ~approx(F.col("truth.progress_m"), progress, 0.005), say("progress differs")),
        ("md_regression", "error", F.col("_md") + 1e-6 < F.col("_prev"), F.format_string("depth %.2f after %.2f", F.col("_md"), F.col("_prev"))),
        ("progress", "error", start.isNotNull() & md.isNotNull() & ~approx(F.bround(md - start, 2), progress, 0.02), say("progress is not the difference of depths")),
        ("bit_records", "error", F.size(bits) != F.size(truth_bits), say("bit records differ in number")),
        ("bit_footage", "error", _differs(tb, b, lambda t, p: approx(t["footage_m"], p["footage_m"], 0.02)), say("bit footage differs")),
        ("bit_depths", "error", F.exists(b, lambda p: F.coalesce(~approx(F.bround(p["depth_out_m"] - p["depth_in_m"], 2), p["footage_m"], 0.02) & p["depth_out_m"].isNotNull() & p["depth_in_m"].isNotNull() & p["footage_m"].isNotNull(), F.lit(False))), say("bit footage is not the difference of depths")),
        ("bit_dull_grade", "error", _differs(tb, b, lambda t, p: t["dull_grade"].eqNullSafe(p["dull_grade"])), say("wear grades differ")),
        ("mud", "error", flow.isNull(), say("no flowline sample")),
        ("mud_density", "error", flow.isNotNull() & ~approx(F.col("truth.mud.density_gcc"), flow["density_gcc"], 0.005), say("mud density differs")),
        ("mud_fl", "error", flow.isNotNull() & ~approx(F.col("truth.mud.fl_ml"), flow["fl_ml"], 0.02), say("fluid loss differs")),
        ("mud_viscosity", "error", flow.isNotNull() & ~approx(F.col("truth.mud.funnel_viscosity_s"), flow["funnel_viscosity_s"], 0.02), say("viscosity differs")),
    ]))
    alone, along = [r for r in rules if r[1][0] != "md_regression"], [r for r in rules if r[1][0] == "md_regression"]
    slim = days.select("well_name", "report_date", "ord", md.alias("_md"), broken(alone).alias("_found"))
    rows = slim.withColumn("_prev", F.last("_md", ignorenulls=True).over(before))
    found = F.concat(F.filter("_found", lambda x: x["ord"] < along[0][0]), broken(along), F.filter("_found", lambda x: x["ord"] > along[0][0]))
    return rows.select("well_name", "report_date", F.inline(found))
