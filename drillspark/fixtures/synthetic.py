"""Invented wells and days with known answers (SRC12, SRC15, GEN1-GEN3, WIN13, JN24, SC54).

A day is a row of ``spark.range`` and every choice a hash of (seed, well, day, what), so a dataset of any size is the same
whatever its partitioning. Hours are whole tenths up to the end, so a day sums to 24 hours exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.classify import category_of, literal_map

DAY_TENTHS, JOINT_M = 240, 9.5
PHASES = ("surface", "drilling", "trip_out", "trip_in", "casing")
LAYOUTS = ("cn_vertical", "iadc_classic", "regional_xls")
#: Metres drilled in a day of a phase, from and to.
FOOTAGE = {"surface": (60.0, 160.0), "drilling": (120.0, 320.0), "trip_out": (0.0, 30.0), "trip_in": (20.0, 80.0), "casing": (0.0, 0.0)}
#: What a day of a phase is made of: text, code, and tenths of hours from and to. None stands for the connections.
BLOCKS = {
    "surface": (("安装防喷器", "BOP", 40, 70), ("功能试验", "TEST", 20, 40), ("表层旋转钻进", "DRILL", 40, 80), None),
    "drilling": (("旋转钻进", "DRILL", 100, 140), None, ("循环洗井", "CIRCULATE", 10, 20), ("短程起钻", "TRIP_OUT", 10, 25), ("下钻", "TRIP_IN", 10, 25)),
    "trip_out": (("起钻", "TRIP_OUT", 110, 150), ("更换钻头", "BIT_CHANGE", 10, 20), ("循环洗井", "CIRCULATE", 15, 30)),
    "trip_in": (("下钻", "TRIP_IN", 100, 140), ("循环洗井", "CIRCULATE", 10, 20), ("旋转钻进", "DRILL", 20, 50), None),
    "casing": (("划眼", "REAM", 20, 35), ("下套管", "CASING", 100, 130), ("固井", "CEMENT", 40, 60), ("套管试压", "TEST", 10, 20)),
}
#: Lost time by pool: how much of the probability it has, and (text, code, tenths, cause, responsibility).
LOST = (
    (1.0, (("顶驱故障", "REPAIR", 25, "equipment", "contractor"), ("泥浆泵故障", "REPAIR", 30, "equipment", "contractor"), ("更换筛布", "REPAIR", 10, "equipment", "contractor"))),
    (0.5, (("遇卡，活动解卡", "STUCK", 35, "wellbore", "operator"), ("井漏，堵漏", "STUCK", 40, "wellbore", "operator"))),
    (0.3, (("等天气好转", "WAIT", 30, "weather", "force_majeure"),)),
    (0.3, (("等器材", "WAIT", 60, "logistics", "third_party"),)),
)
CONNECTION = "接单根"
#: Who an invented report says it is of.
PARTIES = {"operator": "虚构作业者", "contractor": "虚构承包商", "rig": "虚构7号"}
BLOCK = "struct<operation:string,code:string,tenths:int,npt_category:string,npt_responsibility:string,ilt_action:string,shift:string,minutes:double>"


@dataclass(frozen=True)
class Plan:
    wells: int = 3
    days: int = 7
    seed: int = 20261008
    npt_probability: float = 0.45
    first_date: str = "2026-03-01"


def quantised(hours: Column) -> Column:
    """SC54: hours as whole tenths."""
    return F.bround(hours * 10).cast("int")


def clock_of(tenths: Column) -> Column:
    """HH:MM of tenths of hours since midnight; the end of the day is 24:00."""
    return F.format_string("%02d:%02d", (tenths / 10).cast("int"), F.pmod(tenths, F.lit(10)) * 6)


def uniform(plan: Plan, *what) -> Column:
    """A number in [0, 1) that only (seed, well, day, what) decide."""
    parts = [w if isinstance(w, Column) else F.lit(w) for w in what]
    return F.pmod(F.xxhash64(F.lit(plan.seed), "well", "day", *parts), F.lit(1 << 32)) / float(1 << 32)


def layout_of(phase: Column) -> Column:
    """SRC15: the template of a phase, by its place in the list; an unknown phase is the place after the last."""
    at = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in PHASES]), phase), F.lit(0)) - 1, F.lit(len(PHASES)))
    return F.element_at(F.array(*[F.lit(x) for x in LAYOUTS]), (F.pmod(at, F.lit(len(LAYOUTS))) + 1).cast("int"))


def days(spark: SparkSession, plan: Plan = Plan()) -> DataFrame:
    """GEN2: one row a day with its phase and depths, which only ever grow along a well; a day before ``casing`` ends no well."""
    n = plan.days
    rows = spark.range(plan.wells * n).select((F.col("id") / n).cast("int").alias("well"), F.pmod("id", F.lit(n)).cast("int").alias("day"))
    turn = F.pmod("day", F.lit(3))
    phase = F.when(F.col("day") == 0, "surface").when(F.col("day") == n - 1, "casing").when(turn == 2, "trip_out").when(turn == 0, "trip_in").otherwise("drilling")
    rows = rows.withColumn("phase", phase)
    low, high = (F.element_at(literal_map({p: v[i] for p, v in FOOTAGE.items()}), F.col("phase")) for i in (0, 1))
    rows = rows.withColumn("progress_m", F.bround(low + uniform(plan, "footage") * (high - low), 2).cast("decimal(12,2)"))
    along = W.partitionBy("well").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    depth = F.first(F.bround(1800 + uniform(plan, "start") * 400, 2).cast("decimal(12,2)")).over(along) + F.sum("progress_m").over(along)
    rows = rows.withColumn("md_m", depth.cast("double")).withColumn("progress_m", F.col("progress_m").cast("double"))
    date = F.date_add(F.lit(plan.first_date).cast("date"), F.col("day"))
    return rows.select(
        "well", "day", F.format_string("w%05d-d%03d", "well", "day").alias("report_id"), F.format_string("SYN-%d-%dX", F.col("well") + 1, F.pmod("well", F.lit(9)) + 1).alias("well_name"),
        (F.col("day") + 1).alias("report_no"), date.cast("string").alias("report_date"), "phase", layout_of(F.col("phase")).alias("template_id"),
        F.when(F.pmod("well", F.lit(3)) == 1, "imperial").otherwise("metric").alias("unit_system"), "md_m", "progress_m",
        F.bround(F.col("md_m") * (0.86 + 0.13 * uniform(plan, "tvd")), 2).alias("tvd_m"),
        F.bround(1.08 + 0.24 * uniform(plan, "density"), 2).alias("density_gcc"), F.bround(38 + 20 * uniform(plan, "viscosity")).alias("funnel_viscosity_s"),
        F.bround(3 + 3 * uniform(plan, "loss"), 1).alias("fl_ml"), (F.col("phase") == "trip_out").alias("has_bit"),
    )


def _block(plan: Plan, operation, code, tenths: Column, cause=None, responsibility=None, action=None, shift=None, minutes=None) -> Column:
    given = (operation, code, tenths, cause, responsibility, action, shift, minutes)
    return F.struct(*[x if isinstance(x, Column) else F.lit(x) for x in given]).cast(BLOCK)


def connections(plan: Plan, count: Column) -> Column:
    """GEN3: an array of connections: minutes around those of the shift, 9 to 21, and the tenths that a report has of them."""

    def one(i: Column) -> Column:
        day_shift = F.pmod(i, F.lit(2)) == 1
        normal = F.sqrt(-2 * F.log(1 - uniform(plan, "radius", i))) * F.cos(2 * math.pi * uniform(plan, "angle", i))
        minutes = F.bround(F.greatest(F.lit(9.0), F.least(F.lit(21.0), F.when(day_shift, 10.0).otherwise(12.0) + normal)), 1)
        return _block(plan, CONNECTION, "DRILL", F.greatest(F.lit(1), quantised(minutes / 60)), action="connection", shift=F.when(day_shift, "day").otherwise("night"), minutes=minutes)

    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), one)).otherwise(F.array().cast(f"array<{BLOCK}>"))


def blocks(day_rows: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """GEN1: the blocks of each day, lost time among them; they are made to fill the day.

    Lost time keeps its hours. Where a day is too long the rest shrinks in proportion, where it is too short the longest
    drilling block grows, or the longest block that is no lost time.
    """
    joints = F.when(F.col("progress_m") > 0, F.bround(F.col("progress_m") / JOINT_M).cast("int")).otherwise(0)
    none = F.array().cast(f"array<{BLOCK}>")

    def of_phase(spec) -> Column:
        made = [connections(plan, joints) if b is None else F.array(_block(plan, b[0], b[1], (b[2] + uniform(plan, "block", i) * (b[3] - b[2])).cast("int"))) for i, b in enumerate(spec)]
        return F.concat(*made)

    def of_pool(i: int, share: float, pool) -> Column:
        choice = F.array(*[_block(plan, t, c, F.lit(h), cause, who) for t, c, h, cause, who in pool])
        at = (F.floor(uniform(plan, "lost which", i) * len(pool)) + 1).cast("int")
        return F.when(uniform(plan, "lost", i) < plan.npt_probability * share, F.array(F.element_at(choice, at))).otherwise(none)

    every = F.concat(F.coalesce(*[F.when(F.col("phase") == p, of_phase(spec)) for p, spec in BLOCKS.items()]), *[of_pool(i, s, pool) for i, (s, pool) in enumerate(LOST)])
    rows = day_rows.select("report_id", F.posexplode(every).alias("ord", "b")).select("report_id", "ord", "b.*")
    whole, lost = W.partitionBy("report_id"), F.col("npt_category").isNotNull()
    rows = rows.withColumn("_free", F.sum(F.when(~lost, F.col("tenths"))).over(whole)).withColumn("_over", F.sum("tenths").over(whole) - DAY_TENTHS)
    shrunk = F.greatest(F.lit(1), F.floor(F.col("tenths") * (F.col("_free") - F.col("_over")) / F.col("_free")).cast("int"))
    rows = rows.withColumn("tenths", F.when((F.col("_over") > 0) & (F.col("_free") > F.col("_over")) & ~lost, shrunk).otherwise(F.col("tenths")))
    drilled = F.col("code").isin("DRILL", "REAM") & ~lost
    first = W.partitionBy("report_id").orderBy(drilled.desc(), lost, F.desc("tenths"), "ord")
    left = F.greatest(F.lit(0), F.lit(DAY_TENTHS) - F.sum("tenths").over(whole))
    grown = rows.withColumn("_k", F.row_number().over(first)).withColumn("_left", left)
    return grown.withColumn("tenths", (F.col("tenths") + F.when(F.col("_k") == 1, F.col("_left")).otherwise(0)).cast("int")).drop("_k", "_left", "_free", "_over")


def materialise(rows: DataFrame) -> DataFrame:
    """WIN13: (report_id, ord, tenths, ...) laid end to end over the day, with start, end and hours; every report sums to 24 hours.

    Blocks of no length go, and so do those that would begin after the day. What is missing goes to the last block, what is
    too much comes off the longest ones, of which a tenth stays.
    """
    whole, by_ord = W.partitionBy("report_id"), W.partitionBy("report_id").orderBy("ord")
    before = by_ord.rowsBetween(W.unboundedPreceding, -1)
    kept = rows.where("tenths >= 1").withColumn("_at", F.coalesce(F.sum("tenths").over(before), F.lit(0))).where(F.col("_at") < DAY_TENTHS)
    kept = kept.withColumn("_sum", F.sum("tenths").over(whole)).withColumn("_last", F.lead("ord").over(by_ord).isNull())
    longest = W.partitionBy("report_id").orderBy(F.desc("tenths"), "ord").rowsBetween(W.unboundedPreceding, -1)
    spare = F.coalesce(F.sum(F.col("tenths") - 1).over(longest), F.lit(0))
    off = F.least(F.col("tenths") - 1, F.greatest(F.lit(0), F.col("_sum") - DAY_TENTHS - F.col("_spare")))
    on = F.when(F.col("_last"), F.greatest(F.lit(0), DAY_TENTHS - F.col("_sum"))).otherwise(0)
    sized = kept.withColumn("_spare", spare).withColumn("tenths", (F.col("tenths") - off + on).cast("int"))
    placed = sized.withColumn("_at", F.coalesce(F.sum("tenths").over(before), F.lit(0)))
    out = placed.withColumns({"start": clock_of(F.col("_at")), "end": clock_of(F.col("_at") + F.col("tenths")), "hours": F.col("tenths") / 10, "ord": F.row_number().over(by_ord)})
    return out.drop("_at", "_sum", "_last", "_spare", "tenths")


def time_log(day_rows: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The entries of each day with their category, as a report has them."""
    category = F.when(F.col("npt_category").isNotNull(), "npt").otherwise(category_of(F.col("code")))
    return materialise(blocks(day_rows, plan)).withColumn("category", category)


def connection_details(log: DataFrame) -> DataFrame:
    """JN24: connections with the minutes they took beside the hours and clocks that the report has; both are one row from the start, so nothing is zipped."""
    seq = F.row_number().over(W.partitionBy("report_id").orderBy("ord"))
    return log.where("ilt_action = 'connection'").select("report_id", seq.alias("seq"), "shift", "minutes", "hours", "start", "end")


def bits(day_rows: DataFrame) -> DataFrame:
    """The bit that a trip brings out: it went in where the last one came out."""
    along = W.partitionBy("well").orderBy("day")
    trips = day_rows.where("has_bit")
    out = F.col("md_m") - F.col("progress_m")
    rows = trips.withColumn("depth_out_m", F.bround(out, 2)).withColumn("bit_no", F.row_number().over(along))
    rows = rows.withColumn("depth_in_m", F.coalesce(F.lag("depth_out_m").over(along), F.bround(F.col("depth_out_m") - 400, 2)))
    return rows.select("report_id", "bit_no", "depth_in_m", "depth_out_m", F.bround(F.col("depth_out_m") - F.col("depth_in_m"), 2).alias("footage_m"), F.lit("3-4-WT-S-X-I-NO-TD").alias("dull_grade"))


def truth(day_rows: DataFrame, log: DataFrame, bit_rows: DataFrame) -> DataFrame:
    """The answers, one row a report under the names of the registered assertions; ``file`` is the report."""
    when = lambda cond: F.coalesce(F.bround(F.sum(F.when(cond, F.col("hours"))), 2), F.lit(0.0))
    lost, joint = F.col("npt_category").isNotNull(), F.col("ilt_action") == "connection"
    sums = log.groupBy("report_id").agg(
        when(F.lit(True)).alias("sum_hours"), F.count(F.lit(1)).alias("time_entry_count"), when(lost).alias("npt_hours"), F.count_if(lost).alias("npt_entry_count"),
        F.count_if(joint).alias("connection_count"), when(joint).alias("connection_hours"), when(F.col("code").isin("DRILL", "REAM")).alias("_drilled"),
    )
    bit = bit_rows.select("report_id", F.lit(1).alias("bit_count"), F.col("depth_out_m").alias("bit_depth_out_m"), F.col("footage_m").alias("bit_footage_m"), F.col("dull_grade").alias("bit_dull_grade"))
    rows = day_rows.join(sums, "report_id").join(bit, "report_id", "left")
    drilled = F.nullif("_drilled", F.lit(0.0))
    return rows.select(
        F.col("report_id").alias("file"), "phase", "template_id", "unit_system", "well_name", *[F.lit(v).alias(k) for k, v in PARTIES.items()], "report_no", "report_date", "md_m", "tvd_m", "progress_m",
        drilled.alias("etim_drill_h"), F.when(F.col("progress_m") > 0, F.bround(F.col("progress_m") / drilled, 2)).alias("rop_av_m_per_h"),
        *[c for c in sums.columns if c not in ("report_id", "_drilled")], F.coalesce("bit_count", F.lit(0)).alias("bit_count"), "bit_depth_out_m", "bit_footage_m", "bit_dull_grade",
        F.col("density_gcc").alias("mud_density_gcc"), F.col("fl_ml").alias("mud_fl_ml"), F.col("funnel_viscosity_s").alias("mud_viscosity_s"),
    )
