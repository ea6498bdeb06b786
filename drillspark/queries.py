"""Driver-bound queries: every operator family on a driver table of the same shape, and the same question in DuckDB's SQL.

Events stand for time entries (a user's day is a report, value/100 its hours, event_type its code), orders for a well's reports
(customer, date, total price as depth), lineitems for table rows, conversations for lines and remarks, documents for pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import times as D
from .functions import units as U
from .operators import chain, classify, timelog
from .operators.spread import dealt, tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, by: str | None = None) -> DataFrame:
    """A driver table; with ``by`` its rows are dealt by that key, for queries whose work on a row is much."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(rows, by) if by and tasks(rows) != 1 else rows


def dec(value, digits: int = 4):
    """Decimal before summing: no order of addition shows."""
    return value.cast(f"decimal(18,{digits})")


CODE_OF = {"purchase": "DRILL", "view": "TRIP_IN", "click": "CIRCULATE", "signup": "CASING", "error": "REPAIR"}
_CODE_SQL = "CASE event_type WHEN 'purchase' THEN 'DRILL' WHEN 'view' THEN 'TRIP_IN' WHEN 'click' THEN 'CIRCULATE' WHEN 'signup' THEN 'CASING' WHEN 'error' THEN 'REPAIR' ELSE 'UNKNOWN' END"
_CATEGORY_SQL = "CASE event_type WHEN 'purchase' THEN 'productive' WHEN 'error' THEN 'npt' ELSE 'flat' END"
_LOG_SQL = f"""log AS (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS report_id, event_id AS ord, CAST(round(value / 100, 4) AS DECIMAL(18,4)) AS hours,
         {_CODE_SQL} AS code, {_CATEGORY_SQL} AS category, event_type = 'error' AS is_npt, CASE WHEN event_type = 'purchase' THEN 'connection' END AS ilt_action FROM events)"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a time log."""
    events = table(spark, sf_dir, "events")
    code = F.coalesce(F.try_element_at(classify.literal_map(CODE_OF), F.col("event_type")), F.lit("UNKNOWN"))
    rows = events.select(F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("report_id"), F.col("event_id").alias("ord"), dec(F.round(F.col("value") / 100, 4)).alias("hours"), code.alias("code"))
    rows = rows.withColumn("category", classify.category_of(F.col("code")))
    return rows.withColumn("is_npt", F.col("category") == "npt").withColumn("ilt_action", F.when(F.col("code") == "DRILL", "connection")).withColumn("duration_source", F.lit("reported"))


@query(f"WITH {_LOG_SQL} SELECT report_id, sum(hours)::DOUBLE AS sum_hours, count(*) AS entries, abs(sum(hours)::DOUBLE - 24) <= 0.01 AS valid FROM log GROUP BY report_id")
def q_day_budget(spark, sf_dir):
    return timelog.day_hours(event_log(spark, sf_dir)).withColumn("valid", F.abs(F.col("sum_hours") - 24) <= 0.01)


@query(f"""WITH {_LOG_SQL}, short AS (SELECT report_id, max(ord) + 1 AS ord, round(24 - sum(hours)::DOUBLE, 4) AS hours FROM log GROUP BY report_id HAVING sum(hours)::DOUBLE < 23.99)
SELECT report_id, ord, hours::DOUBLE AS hours, code, category, is_npt FROM log UNION ALL SELECT report_id, ord, hours, 'UNKNOWN', 'flat', false FROM short""")
def q_gap_fill(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumn("hours", F.col("hours").cast("double"))
    return timelog.fill_gap(log).select("report_id", "ord", F.bround("hours", 4).alias("hours"), "code", "category", "is_npt")


_SPANS_SQL = """spans AS (
  SELECT event_id, user_id || '/' || strftime(ts, '%Y-%m-%d') AS report_id, (extract(hour FROM ts) * 60 + extract(minute FROM ts))::DOUBLE AS start_m,
         least(1440, extract(hour FROM ts) * 60 + extract(minute FROM ts) + floor(value))::DOUBLE AS end_m FROM events)"""


def _spans(spark, sf_dir):
    """Events as intervals in whole minutes of a day, value minutes long."""
    at = F.hour("ts") * 60 + F.minute("ts")
    return table(spark, sf_dir, "events").select("event_id", F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("report_id"), at.cast("double").alias("start_m"), F.least(F.lit(1440), at + F.floor("value")).cast("double").alias("end_m"))


@query(f"""WITH {_SPANS_SQL}, swept AS (
  SELECT *, greatest(coalesce(max(end_m) OVER (PARTITION BY report_id ORDER BY start_m, end_m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS cursor FROM spans)
SELECT report_id, count(*) AS n, sum(CASE WHEN start_m > cursor + 0.01 THEN start_m - cursor ELSE 0 END) AS gap_minutes,
       sum(CASE WHEN start_m < cursor - 0.01 THEN least(cursor, end_m) - start_m ELSE 0 END) AS overlap_minutes, 1440 - max(end_m) AS trailing_minutes FROM swept GROUP BY report_id""")
def q_interval_sweep(spark, sf_dir):
    swept = timelog.interval_sweep(_spans(spark, sf_dir), "report_id", "start_m", "end_m")
    return swept.groupBy("report_id").agg(F.count(F.lit(1)).alias("n"), F.sum("gap").alias("gap_minutes"), F.sum("overlap").alias("overlap_minutes"), (1440 - F.max("end_m")).alias("trailing_minutes"))


@query(f"WITH {_LOG_SQL}, s AS (SELECT report_id, category, sum(hours)::DOUBLE AS hours FROM log GROUP BY ALL) SELECT report_id, category, round(hours, 4) AS hours, round(hours / coalesce(nullif(sum(hours) OVER (PARTITION BY report_id), 0), 1), 4) AS share FROM s")
def q_cat_hours(spark, sf_dir):
    return timelog.category_hours(event_log(spark, sf_dir)).select("report_id", "category", F.round("hours", 4).alias("hours"), F.round("share", 4).alias("share"))


@query(f"WITH {_LOG_SQL} SELECT report_id, code, sum(hours)::DOUBLE AS hours FROM log GROUP BY ALL")
def q_code_hours(spark, sf_dir):
    return timelog.code_hours(event_log(spark, sf_dir))


@query(f"""WITH {_LOG_SQL} SELECT report_id, count(*) AS entries, sum(hours)::DOUBLE AS sum_hours, coalesce(sum(hours) FILTER (category = 'productive'), 0)::DOUBLE AS productive_hours,
  coalesce(sum(hours) FILTER (category = 'flat'), 0)::DOUBLE AS flat_hours, coalesce(sum(hours) FILTER (is_npt), 0)::DOUBLE AS npt_hours, count(*) FILTER (is_npt) AS npt_entries,
  count(*) FILTER (ilt_action = 'connection') AS connections, coalesce(sum(hours) FILTER (ilt_action = 'connection'), 0)::DOUBLE AS connection_hours FROM log GROUP BY report_id""")
def q_npt_cond(spark, sf_dir):
    return timelog.report_kpi(event_log(spark, sf_dir)).drop("drill_hours", "ream_hours")


_REPORTS_SQL = "reports AS (SELECT o_custkey AS well, o_orderdate AS day, o_orderkey AS file_ord, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice END AS md FROM orders)"


def _reports(spark, sf_dir):
    """orders as a well's reports: every seventh depth is missing (0)."""
    md = F.when(F.col("o_orderkey") % 7 == 0, 0.0).otherwise(F.col("o_totalprice"))
    none = F.lit(None).cast("double")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("well_name"), F.col("o_orderdate").alias("dtim_start"), F.col("o_orderkey").alias("file_ord"), md.alias("md_m"), none.alias("md_in_start_m"), none.alias("progress_m"), F.lit(8.0).alias("etim_drill_h"), none.alias("rop_av_m_per_h"))


@query(f"""WITH {_REPORTS_SQL}, prev AS (SELECT *, last_value(nullif(md, 0) IGNORE NULLS) OVER (PARTITION BY well ORDER BY day, file_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM reports)
SELECT file_ord, md AS md_m, CASE WHEN nullif(md, 0) >= p THEN p END AS md_in_start_m, round(CASE WHEN nullif(md, 0) >= p THEN md - p END, 2) AS progress_m FROM prev""")
def q_carry_forward(spark, sf_dir):
    return chain.carry_forward(_reports(spark, sf_dir)).select("file_ord", "md_m", "md_in_start_m", "progress_m")


@query("""SELECT o_orderkey AS file_ord, o_totalprice AS md_m, p AS previous_md_m FROM (SELECT *, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) WHERE o_totalprice + 1e-6 < p""")
def q_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("well_name"), F.col("o_orderdate").alias("dtim_start"), F.col("o_orderkey").alias("file_ord"), F.col("o_totalprice").alias("md_m"))
    return chain.depth_regression(rows).select("file_ord", "md_m", "previous_md_m")


_SCORES = ((r"th[a-z]+", 4.0), (r"ou", 2.5), (r"[0-9]+", 1.5))


@query("SELECT doc_id, " + " + ".join(f"{w} * least(len(regexp_extract_all(text, '{p}')), 5)" for p, w in _SCORES) + " AS score FROM documents")
def q_unit_score(spark, sf_dir):
    from .operators.segment import weighted_score

    return table(spark, sf_dir, "documents").select("doc_id", weighted_score(F.col("text"), _SCORES, "").alias("score"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * CASE l_returnflag WHEN 'A' THEN 0.3048 WHEN 'N' THEN 1 ELSE 0.0254 END, 6) AS metres FROM lineitem""")
def q_unit_convert(spark, sf_dir):
    unit = F.when(F.col("l_returnflag") == "A", "ft").when(F.col("l_returnflag") == "N", "m").otherwise("inch")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(U.convert(F.col("l_quantity"), unit, "length"), 6).alias("metres"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 2) AS value, CASE l_returnflag WHEN 'A' THEN 'ft' WHEN 'N' THEN 'm' END AS unit FROM lineitem")
def q_quantity_parse(spark, sf_dir):
    unit = F.when(F.col("l_returnflag") == "A", " ft").when(F.col("l_returnflag") == "N", "m").otherwise("")
    q = U.parse_quantity(F.concat(F.format_number("l_extendedprice", 2), unit))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", q["value"].alias("value"), q["unit"].alias("unit"))


@query("""SELECT event_id, extract(hour FROM ts) + round(extract(minute FROM ts) / 60.0::DOUBLE, 4) AS clock_hours, round((event_id % 90) / 60.0::DOUBLE, 4) AS minute_hours, (event_id % 3) * 24.0 + (event_id % 24) + 0.5 AS mixed_hours FROM events""")
def q_duration_parse(spark, sf_dir):
    k = F.col("event_id")
    clock = F.concat(F.lit("at "), F.date_format("ts", "HH:mm"), F.lit(" drilling"))
    mixed = F.concat(k % 3, F.lit("d "), k % 24, F.lit("h 30min"))
    return table(spark, sf_dir, "events").select("event_id", D.clock_to_hours(clock).alias("clock_hours"), D.duration_to_hours(F.concat(k % 90, F.lit(" min"))).alias("minute_hours"), D.duration_to_hours(mixed).alias("mixed_hours"))


@query("""SELECT event_id, round(CASE event_id % 3 WHEN 0 THEN (event_id % 50) WHEN 1 THEN round((event_id % 50) / 60.0::DOUBLE, 3) ELSE (event_id % 50) * 24.0 END, 3) AS hours FROM events""")
def q_clock(spark, sf_dir):
    k = F.col("event_id")
    unit = F.when(k % 3 == 0, " hrs").when(k % 3 == 1, " min").otherwise(" days")
    d = D.text_duration(F.concat(F.date_format("ts", "HH:mm"), F.lit(" pump repair "), k % 50, unit))
    return table(spark, sf_dir, "events").select("event_id", F.round(d["hours"], 3).alias("hours"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' AS start_iso, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00' AS end_iso FROM orders")
def q_date_cascade(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    shown = F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(d, "yyyy/M/d")).otherwise(F.date_format(d, "yyyy年M月d日"))
    r = D.date_range(shown)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(D.parse_date(shown), "yyyy-MM-dd").alias("day"), r["start"].alias("start_iso"), r["end"].alias("end_iso"))


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('brand#1'), ('brand#2')) k(known) WHERE contains(replace(lower(p_brand), ' ', ''), known) AND length(known) >= 0.8 * length(replace(lower(p_brand), ' ', '')))")
def q_fuzzy_anti(spark, sf_dir):
    from .operators.privacy import covered

    name = T.norm_name(F.col("p_brand"))
    return table(spark, sf_dir, "part").where(~covered(name, ["brand#1", "brand#2"])).select("p_partkey")


@query("""SELECT lang, toxic, count(*) AS total, count(*) FILTER (ok) AS ok, round(count(*) FILTER (ok) / count(*), 4) AS accuracy FROM (
  SELECT d.lang, l.toxic, (l.quality = 1) = (d.n_chars >= 300) AS ok FROM documents d JOIN labels l USING (doc_id)) GROUP BY GROUPING SETS ((lang), (lang, toxic), ())""")
def q_accuracy_sets(spark, sf_dir):
    from .operators.evaluate import accuracy_sets

    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("lang", "toxic", ((F.col("quality") == 1) == (F.col("n_chars") >= 300)).alias("ok"))
    return accuracy_sets(rows, "lang", "toxic")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, abs(l_extendedprice - round(l_extendedprice, 0)) <= 0.011 AS near, CASE WHEN l_extendedprice IS NULL THEN false WHEN abs(l_extendedprice) < 1e-9 THEN false ELSE abs(l_extendedprice * (1 + l_tax) - l_extendedprice) / abs(l_extendedprice) <= 0.03 END AS relative_ok FROM lineitem""")
def q_tolerance(spark, sf_dir):
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", U.approx(price, F.round(price, 0)).alias("near"), U.number_ok(price, price * (1 + F.col("l_tax")), 0.03).alias("relative_ok"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def q_counters(spark, sf_dir):
    from .operators.stats import counters

    return counters(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def q_pairs(spark, sf_dir):
    line = T.pairs(F.concat_ws("|", F.lit("name"), "c_name", F.lit(" segment "), "c_mktsegment", F.lit("name"), F.lit("second")))
    return table(spark, sf_dir, "customer").select("c_custkey", F.try_element_at(line, F.lit("name")).alias("name"), F.try_element_at(line, F.lit("segment")).alias("segment"))


@query("SELECT p_partkey, (p_size % 9)::INT AS inner_wear, (p_partkey % 8)::INT AS outer_wear, CASE p_partkey % 2 WHEN 0 THEN 'WT' ELSE 'BT' END AS dull_char, 'TD' AS reason_pulled FROM part")
def q_grade(spark, sf_dir):
    grade = T.dull_grade(F.concat_ws("-", F.col("p_size") % 9, F.col("p_partkey") % 8, F.when(F.col("p_partkey") % 2 == 0, "wt").otherwise("BT"), F.lit("S"), F.lit("X"), F.lit("I"), F.lit("NO"), F.lit("td")))
    return table(spark, sf_dir, "part").select("p_partkey", grade["inner_wear"].alias("inner_wear"), grade["outer_wear"].alias("outer_wear"), grade["dull_char"].alias("dull_char"), grade["reason_pulled"].alias("reason_pulled"))


@query("""SELECT conv_id, turn, role, CASE WHEN k % 3 = 0 THEN 'equipment_failure' WHEN k % 3 = 1 THEN 'wellbore_problem' ELSE 'info' END AS event_type, CASE WHEN k % 3 < 2 THEN (k % 9 + 1)::DOUBLE END AS hours, k % 3 < 2 AS verified
FROM (SELECT *, turn + conv_id AS k FROM conversations)""")
def q_event_rule(spark, sf_dir):
    from .operators.events import rule_events

    k = F.col("turn") + F.col("conv_id")
    text = F.when(k % 3 == 0, F.concat(F.lit("06:30 pump malfunction 停工 "), k % 9 + 1, F.lit(" 小时"))).when(k % 3 == 1, F.concat(F.lit("lost circulation for "), k % 9 + 1, F.lit(" hrs"))).otherwise("06:30 no event")
    remarks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text.alias("text"))
    return rule_events(remarks).select("conv_id", "turn", "role", "event_type", "hours", "verified")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is each report compliant, and how was the day spent: the 24-hour rule, category hours and NPT rate in one result."""
    return timelog.report_kpi(event_log(spark, sf_dir)).withColumn("valid", F.abs(F.col("sum_hours") - 24) <= 0.01).withColumn("npt_rate", F.try_divide("npt_hours", "sum_hours"))


from . import operator_queries  # noqa: E402, F401  registers its queries here
