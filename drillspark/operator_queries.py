"""Queries that map a driver table to an operator's input and call the operator, each with the same question in DuckDB's SQL.

A user's events stand for the lines or rows of a document, orders for reports, parts for bits and mud samples.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import dims, sinks
from .functions import text as T
from .functions import times as D
from .functions import units as U
from .operators import chain, classify, evaluate, events, header, privacy, reconcile, segment, stats, tables, timelog, validate
from .operators.spread import dealt
from .queries import query, table


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_text(v) if v is None or isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _by(key, values: list):
    """The value of a list that a key's remainder picks."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _by_sql(key: str, values: list[str | None]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {_text(v)}" for i, v in enumerate(values)) + " END"


# time entries


def _clocked(spark, sf_dir):
    at = F.hour("ts") * 60 + F.minute("ts")
    end = F.least(F.lit(1440), at + F.floor("value"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("report_id"), F.col("event_id").alias("ord"), D.hours_to_clock(at / 60.0).alias("start"), D.hours_to_clock(end / 60.0).alias("end"),
        (F.col("event_id") % 1300 / 100.0).alias("hours"), F.floor("value").alias("minutes"),
    )


_MINUTES_SQL = "(extract(hour FROM ts) * 60 + extract(minute FROM ts))"


@query(f"SELECT event_id, round((least(1440, {_MINUTES_SQL} + floor(value)) - {_MINUTES_SQL}) / 60.0, 4) AS span FROM events WHERE abs((least(1440, {_MINUTES_SQL} + floor(value)) - {_MINUTES_SQL}) / 60.0 - floor(value) / 60.0) > 0.01")
def q_span_vs_hours(spark, sf_dir):
    log = _clocked(spark, sf_dir).withColumn("hours", F.col("minutes") / 60.0)
    return timelog.span_mismatch(log).select(F.col("ord").alias("event_id"), F.round("span_hours", 4).alias("span"))


@query("SELECT event_id, round(sum((event_id % 1300 / 100.0)::DECIMAL(18,4)) OVER (PARTITION BY user_id ORDER BY event_id)::DOUBLE, 2) AS cum_hours FROM events")
def q_cumulative(spark, sf_dir):
    return timelog.cumulative(_clocked(spark, sf_dir)).select(F.col("ord").alias("event_id"), "cum_hours")


@query("""SELECT user_id::VARCHAR AS report_id, abs(s - 24) <= 0.01 + 1e-9 AS valid, CASE WHEN s - 24 < -0.01 THEN 24.0 ELSE s END AS sum_hours, round(s - 24, 4) AS delta
FROM (SELECT user_id, sum((event_id % 1300 / 100.0)::DECIMAL(18,4))::DOUBLE AS s FROM events GROUP BY 1)""")
def q_verify(spark, sf_dir):
    return timelog.verify(_clocked(spark, sf_dir)).select("report_id", "valid", "sum_hours", "delta")


# lines and blocks

_TITLES = {"purchase": "Time Breakdown", "error": "Remarks", "signup": "Bit Record"}


def _lines(spark, sf_dir, text=None):
    own = F.coalesce(F.try_element_at(classify.literal_map(_TITLES), F.col("event_type")), F.concat(F.lit("row "), "event_id"))
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.col("event_id").alias("line_no"), (own if text is None else text).alias("text"), "event_type", "ts")


@query("""WITH lines AS (SELECT user_id::VARCHAR AS doc_id, event_id AS n, CASE event_type WHEN 'purchase' THEN 'time_log' WHEN 'error' THEN 'remarks' WHEN 'signup' THEN 'bit_record' END AS t FROM events),
opened AS (SELECT *, t IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, t ORDER BY n) = 1 AS opens FROM lines),
filled AS (SELECT *, coalesce(last_value(CASE WHEN opens THEN t END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING), 'header') AS block FROM opened),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block ORDER BY n) AS k FROM filled WHERE NOT opens)
SELECT doc_id, n AS line_no, block FROM placed WHERE block <> 'header' OR k <= 45""")
def q_segment_ffill(spark, sf_dir):
    return segment.blocks(_lines(spark, sf_dir)).select("doc_id", "line_no", "block")


@query("SELECT user_id::VARCHAR AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq, strftime(ts, '%H:%M') AS time_hint, 'note ' || event_id AS text FROM events WHERE event_type <> 'click'")
def q_seq(spark, sf_dir):
    text = F.concat(F.date_format("ts", "HH:mm"), F.lit(" note "), "event_id")
    blocked = _lines(spark, sf_dir, text).withColumn("block", F.when(F.col("event_type") == "click", "plan").otherwise("remarks"))
    out = segment.remarks(blocked)
    return out.withColumn("seq", F.col("seq").cast("long"))


@query("SELECT user_id::VARCHAR AS doc_id, string_agg('row ' || event_id, ' ' ORDER BY event_id) AS summary FROM events WHERE event_type = 'view' GROUP BY 1")
def q_line_concat(spark, sf_dir):
    blocked = _lines(spark, sf_dir).withColumn("block", F.when(F.col("event_type") == "view", "summary").otherwise("plan"))
    return segment.block_text(blocked, "summary")


@query("SELECT user_id::VARCHAR AS doc_id, string_agg('row ' || event_id, chr(10) ORDER BY event_id) AS text FROM events GROUP BY 1")
def q_document_text(spark, sf_dir):
    return segment.document_text(_lines(spark, sf_dir, F.concat(F.lit("row "), "event_id")))


_ANCHORS = (("the ", "and ", "tion"), ("ing ", "eau", "ich", "tion"))
_HITS_SQL = [" + ".join(f"regexp_matches(text, '(?i){a}')::INT" for a in anchors) for anchors in _ANCHORS]


@query(f"""SELECT doc_id, CASE WHEN best >= 2 THEN CASE WHEN b > a THEN 'second' ELSE 'first' END ELSE 'unknown' END AS template_id, best >= 2 AS known,
  round(CASE WHEN best < 2 THEN 0.0 WHEN b > a THEN b / 4 ELSE a / 3 END, 6) AS confidence FROM (SELECT *, greatest(a, b) AS best FROM (SELECT doc_id, {_HITS_SQL[0]} AS a, {_HITS_SQL[1]} AS b FROM documents WHERE text IS NOT NULL))""")
def q_anchor_hits(spark, sf_dir):
    templates = tuple(dims.Template(name, name, hint, anchors) for name, hint, anchors in zip(("first", "second"), ("metric", "imperial"), _ANCHORS, strict=True))
    found = segment.detect(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), templates)
    return found.select("doc_id", "template_id", "known", F.round("confidence", 6).alias("confidence"))


@query("""SELECT p_partkey, CASE WHEN i = 0 AND m = 0 THEN coalesce(h, 'unknown') WHEN i > 1.2::DOUBLE * m THEN 'imperial' WHEN m > 1.2::DOUBLE * i THEN 'metric' ELSE coalesce(h, 'mixed') END AS unit_system
FROM (SELECT p_partkey, p_size % 7 AS i, p_partkey % 5 AS m, CASE p_partkey % 3 WHEN 0 THEN 'metric' WHEN 1 THEN 'imperial' END AS h FROM part)""")
def q_unit_system(spark, sf_dir):
    system = segment.unit_system(F.col("p_size") % 7, F.col("p_partkey") % 5, _by(F.col("p_partkey"), ["metric", "imperial", None]))
    return table(spark, sf_dir, "part").select("p_partkey", system.alias("unit_system"))


# tables

_GRID_SQL = "SELECT DISTINCT user_id::VARCHAR AS doc_id, (event_id % 40)::INT AS r, ((event_id // 40) % 6)::INT AS c FROM events"


def _grid(spark, sf_dir):
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_id"), (k % 40).cast("int").alias("row_idx"), (F.floor(k / 40) % 6).cast("int").alias("col_idx")).distinct()
    return rows.select("doc_id", F.lit(1).alias("page"), F.lit(0).alias("table_idx"), "row_idx", "col_idx", F.lit("x").alias("text"))


@query(f"""WITH cells AS ({_GRID_SQL}),
r1 AS (SELECT doc_id, r, CASE WHEN r - lag(r, 1, -2) OVER (PARTITION BY doc_id ORDER BY r) > 1 THEN 1 ELSE 0 END AS b FROM (SELECT DISTINCT doc_id, r FROM cells)),
r2 AS (SELECT doc_id, r, sum(b) OVER (PARTITION BY doc_id ORDER BY r) AS g FROM r1),
held AS (SELECT cells.*, g FROM cells JOIN r2 USING (doc_id, r)),
c1 AS (SELECT doc_id, g, c, CASE WHEN c - lag(c, 1, -2) OVER (PARTITION BY doc_id, g ORDER BY c) > 1 THEN 1 ELSE 0 END AS b FROM (SELECT DISTINCT doc_id, g, c FROM held)),
c2 AS (SELECT doc_id, g, c, sum(b) OVER (PARTITION BY doc_id, g ORDER BY c) AS h FROM c1)
SELECT doc_id, (dense_rank() OVER (PARTITION BY doc_id ORDER BY g, h) - 1)::INT AS table_idx, r - min(r) OVER (PARTITION BY doc_id, g, h) AS row_idx, c - min(c) OVER (PARTITION BY doc_id, g, h) AS col_idx FROM held JOIN c2 USING (doc_id, g, c)""")
def q_islands(spark, sf_dir):
    return tables.split_grid(_grid(spark, sf_dir)).select("doc_id", "table_idx", "row_idx", "col_idx")


@query(f"WITH cells AS ({_GRID_SQL}) SELECT doc_id, r AS row_idx, c AS col_idx FROM cells WHERE doc_id IN (SELECT doc_id FROM cells GROUP BY 1 HAVING count(DISTINCT r) >= 2)")
def q_semi(spark, sf_dir):
    return tables.ruled(_grid(spark, sf_dir)).select("doc_id", "row_idx", "col_idx")


_HEADS = [["No", "From", "To", "Hours", "Operation", "Class"], ["序号", "开始", "结束", "历时", "作业内容", "备注"], ["From", "From", "Hrs", "else"]]


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 2 THEN 0 ELSE 1 END AS start_at, CASE p_partkey % 3 WHEN 2 THEN NULL ELSE 2 END AS end_at, CASE p_partkey % 3 WHEN 2 THEN 2 ELSE 3 END AS hours_at, CASE p_partkey % 3 WHEN 2 THEN NULL ELSE 4 END AS operation_at FROM part")
def q_map_columns(spark, sf_dir):
    heads = F.array(*[F.array(*[F.lit(c) for c in h]) for h in _HEADS])
    at = tables.map_columns(F.element_at(heads, (F.col("p_partkey") % 3 + 1).cast("int")), dims.TIME_COLUMNS)
    rows = table(spark, sf_dir, "part", by="p_partkey").select("p_partkey", at.alias("at"))
    return rows.select("p_partkey", *[F.try_element_at("at", F.lit(f)).alias(f"{f}_at") for f in ("start", "end", "hours", "operation")])


_PHRASES = {"purchase": ("rotary drilling", "DRILL", "productive"), "view": ("run in hole", "TRIP_IN", "flat"), "click": ("circulate", "CIRCULATE", "flat"), "signup": ("casing", "CASING", "flat"), "error": ("pump failure", "REPAIR", "npt")}


def _cells(rows, key, columns: dict):
    """A table for each row: its head and one line below."""
    head = [F.struct(F.lit(0).cast("long").alias("row_idx"), F.lit(i).alias("col_idx"), F.lit(h).alias("text")) for i, h in enumerate(columns)]
    body = [F.struct(F.lit(1).cast("long").alias("row_idx"), F.lit(i).alias("col_idx"), v.cast("string").alias("text")) for i, v in enumerate(columns.values())]
    return rows.select(key.cast("string").alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("table_idx"), F.inline(F.array(*head, *body)))


@query(f"""SELECT user_id::VARCHAR AS report_id, strftime(ts, '%H:%M') AS start, (event_id % 5)::DOUBLE AS hours, CASE event_type {' '.join(f"WHEN '{e}' THEN '{c}'" for e, (_, c, _) in _PHRASES.items())} END AS code,
  CASE event_type {' '.join(f"WHEN '{e}' THEN '{c}'" for e, (_, _, c) in _PHRASES.items())} END AS category, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS ord FROM events QUALIFY event_id % 5 > 0""")
def q_time_log(spark, sf_dir):
    own = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_id"), (F.col("event_id") + 1).alias("row_idx"), F.date_format("ts", "HH:mm").alias("c0"), F.lit("").alias("c1"), F.concat(F.col("event_id") % 5, F.lit(" h")).alias("c2"), F.try_element_at(classify.literal_map({e: p for e, (p, _, _) in _PHRASES.items()}), F.col("event_type")).alias("c3"))
    own = dealt(own, "doc_id")
    heads = own.select("doc_id").distinct().select("doc_id", F.lit(0).cast("long").alias("row_idx"), *[F.lit(h).alias(f"c{i}") for i, h in enumerate(("From", "To", "Hours", "Operation"))])
    cells = own.union(heads).select("doc_id", F.lit(1).alias("page"), F.lit(0).alias("table_idx"), "row_idx", F.posexplode(F.array("c0", "c1", "c2", "c3")).alias("col_idx", "text"))
    return tables.time_log(cells).select("report_id", "start", "hours", "code", "category", F.col("ord").cast("long").alias("ord"))


@query("SELECT p_partkey::VARCHAR AS report_id, (p_partkey % 9 + 1)::INT AS bit_no, round(p_size / 4.0, 2) AS size_in, (p_partkey % 50)::DOUBLE AS depth_in_m, round((p_partkey % 70) * 0.3048::DOUBLE, 2) AS depth_out_m, p_size::DOUBLE AS footage_m FROM part")
def q_bits(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    parts = dealt(table(spark, sf_dir, "part").withColumn("doc_id", k.cast("string")), "doc_id")
    cells = _cells(parts, F.col("doc_id"), {"Bit No": k % 9 + 1, "Size (in)": size / 4.0, "Depth In (m)": k % 50, "Depth Out (ft)": k % 70, "Footage": F.concat(size, F.lit(" m")), "Dull": F.lit("1-1-WT-A-X-I-NO-TD")})
    detected = parts.select("doc_id", F.lit("cn_vertical").alias("template_id"))
    return tables.bits(cells, detected).select("report_id", "bit_no", "size_in", "depth_in_m", "depth_out_m", "footage_m")


@query("SELECT p_partkey::VARCHAR AS report_id, CASE p_partkey % 3 WHEN 0 THEN 'flowline' WHEN 1 THEN 'pit' ELSE 'other' END AS sample_point, round((p_size % 20) * 0.1198264::DOUBLE, 3) AS density_gcc, (p_size % 11)::DOUBLE AS fl_ml FROM part")
def q_mud(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    parts = dealt(table(spark, sf_dir, "part").withColumn("doc_id", k.cast("string")), "doc_id")
    cells = _cells(parts, F.col("doc_id"), {"Sample Point": _by(k, ["出口", "pit", "elsewhere"]), "MW (ppg)": size % 20, "API FL": size % 11, "pH": F.lit("9")})
    detected = parts.select("doc_id", F.lit("iadc_classic").alias("template_id"))
    return tables.mud(cells, detected).select("report_id", "sample_point", "density_gcc", "fl_ml")


@query("SELECT (p_partkey % 50)::VARCHAR AS report_id, min(p_partkey) AS ord FROM part WHERE p_size % 3 = 0 GROUP BY 1")
def q_flowline(spark, sf_dir):
    k = F.col("p_partkey")
    samples = table(spark, sf_dir, "part").select((k % 50).cast("string").alias("report_id"), k.alias("ord"), _by(F.col("p_size"), ["flowline", "pit", "suction"]).alias("sample_point"))
    return tables.flowline(samples).select("report_id", "ord")


_LABELS = [("Well Name:", "well_name"), ("井号", "well_name"), ("Measured Depth", "md_m"), ("Report No.", "report_no"), ("当日进尺 (m)", "progress_m"), ("Spud Date", "dtim_spud"), ("nothing here", None), ("Avg. ROP (m/h)", "rop_av_m_per_h")]


@query(f"SELECT p_partkey, {_by_sql('p_partkey', [f for _, f in _LABELS])} AS field FROM part")
def q_field_of(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", header.field_of(_by(F.col("p_partkey"), [n for n, _ in _LABELS])).alias("field"))


@query("""SELECT c_custkey::VARCHAR AS doc_id, unnest(['well_name', 'md_m', 'operator']) AS field, unnest([c_name, c_custkey || ' m', c_mktsegment]) AS value, unnest(['pairs', 'table', 'line']) AS provenance FROM customer""")
def q_header_values(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("doc_id", F.col("c_custkey").cast("string"))
    row = lambda i, n, v: F.struct(F.lit(i).alias("row_idx"), F.lit(n).alias("col_idx"), v.cast("string").alias("text"))
    cells = c.select("doc_id", F.lit(1).alias("page"), F.lit(0).alias("table_idx"), F.inline(F.array(row(0, 0, F.lit("Measured Depth")), row(0, 1, F.concat("c_custkey", F.lit(" m"))))))
    line = lambda n, text: F.struct(F.lit(n).alias("line_no"), text.alias("text"), F.lit("header").alias("block"))
    blocked = c.select("doc_id", F.lit(1).alias("page"), F.inline(F.array(line(1, F.concat(F.lit("Well Name | "), "c_name")), line(2, F.concat(F.lit("Operator: "), "c_mktsegment")), line(3, F.lit("Well Name | second")))))
    return header.header_values(cells, blocked, c.select("doc_id"))


# chains of reports


@query("SELECT p_partkey AS ord, previous AS previous_out_m FROM (SELECT p_partkey, p_size * 10.0 AS depth_in, lag(((p_partkey % 60) * 10)::DOUBLE) OVER (PARTITION BY p_partkey % 100 ORDER BY p_partkey) AS previous FROM part) WHERE depth_in + 0.55 < previous")
def q_bit_continuity(spark, sf_dir):
    k = F.col("p_partkey")
    bits = table(spark, sf_dir, "part").select((k % 100).alias("report_id"), k.alias("ord"), (F.col("p_size") * 10.0).alias("depth_in_m"), ((k % 60) * 10.0).alias("depth_out_m"))
    return chain.bit_continuity(bits).select("ord", "previous_out_m")


# rules

_PART_BITS_SQL = "SELECT p_partkey % 100 AS report_id, p_partkey AS ord, p_size * 10.0 AS din, (p_partkey % 60) * 10.0 AS dout, (p_partkey % 60) * 10.0 - p_size * 10.0 + p_partkey % 3 AS footage FROM part"


@query(f"""WITH r AS (SELECT o_orderkey::VARCHAR AS report_id, nullif((o_orderkey % 50) * 10.0, 0) AS md, (o_orderkey % 40) * 10.0 AS start, (o_orderkey % 50 - o_orderkey % 40) * 10.0 + o_orderkey % 3 AS progress, (o_orderkey % 60) * 10.0 AS tvd FROM orders),
l AS (SELECT event_id, user_id::VARCHAR AS report_id, event_id % 20 - 2 AS hours, {_by_sql('event_id', ['DRILL', 'REPAIR', 'UNKNOWN'])} AS code, {_by_sql('event_id', ['npt', 'flat'])} AS category, event_id % 5 = 0 AS is_npt, {_by_sql('event_id', ['', 'equipment', None, 'wellbore'])} AS cause FROM events),
b AS (SELECT *, lag(dout) OVER (PARTITION BY report_id ORDER BY ord) AS prev FROM ({_PART_BITS_SQL})),
m AS (SELECT s_suppkey::VARCHAR AS report_id, (s_suppkey % 50) / 10.0 AS density, s_suppkey % 7 - 2 AS fl FROM supplier)
SELECT report_id, 'md_m' AS field, 'error' AS severity FROM r WHERE md + 1e-9 < start UNION ALL SELECT report_id, 'progress_m', 'warning' FROM r WHERE abs(md - start - progress) > 0.55 UNION ALL
SELECT report_id, 'tvd_m', 'error' FROM r WHERE tvd > md + 1e-9 UNION ALL SELECT report_id, 'hours', 'error' FROM l WHERE hours < 0 UNION ALL SELECT report_id, 'is_npt', 'error' FROM l WHERE (category = 'npt') <> is_npt UNION ALL
SELECT report_id, 'code', 'warning' FROM l WHERE code = 'UNKNOWN' UNION ALL SELECT report_id, 'npt_category', 'warning' FROM l WHERE code = 'REPAIR' AND coalesce(cause, '') = '' UNION ALL
SELECT report_id::VARCHAR, 'depth_out_m', 'error' FROM b WHERE dout < din UNION ALL SELECT report_id::VARCHAR, 'footage_m', 'warning' FROM b WHERE abs(dout - din - footage) > 0.55 UNION ALL
SELECT report_id::VARCHAR, 'depth_in_m', 'warning' FROM b WHERE din + 0.55 < prev UNION ALL SELECT report_id, 'density_gcc', 'warning' FROM m WHERE NOT density BETWEEN 0.5 AND 3.0 UNION ALL SELECT report_id, 'fl_ml', 'error' FROM m WHERE fl < 0""")
def q_issues(spark, sf_dir):
    k, e, p, s = F.col("o_orderkey"), F.col("event_id"), F.col("p_partkey"), F.col("s_suppkey")
    none = F.lit(None).cast("double")
    reports = table(spark, sf_dir, "orders").select(k.cast("string").alias("report_id"), ((k % 50) * 10.0).alias("md_m"), ((k % 40) * 10.0).alias("md_in_start_m"), ((k % 50 - k % 40) * 10.0 + k % 3).alias("progress_m"), ((k % 60) * 10.0).alias("tvd_m"), none.alias("rop_av_m_per_h"))
    log = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("report_id"), (e % 20 - 2).cast("double").alias("hours"), _by(e, ["DRILL", "REPAIR", "UNKNOWN"]).alias("code"), _by(e, ["npt", "flat"]).alias("category"), (e % 5 == 0).alias("is_npt"), _by(e, ["", "equipment", None, "wellbore"]).alias("npt_category"), F.lit("reported").alias("duration_source"), F.lit("x").alias("operation"))
    out, into = (p % 60) * 10.0, F.col("p_size") * 10.0
    bits = table(spark, sf_dir, "part").select((p % 100).cast("string").alias("report_id"), p.alias("ord"), into.alias("depth_in_m"), out.alias("depth_out_m"), (out - into + p % 3).alias("footage_m"), none.alias("hours"), none.alias("rop_m_per_h"))
    mud = table(spark, sf_dir, "supplier").select(s.cast("string").alias("report_id"), ((s % 50) / 10.0).alias("density_gcc"), (s % 7 - 2).cast("double").alias("fl_ml"))
    return validate.numeric_issues(reports, log, bits, mud).select("report_id", "field", "severity")


@query(f"""WITH r AS (SELECT o_orderkey::VARCHAR AS id, o_orderkey % 4 = 0 AS no_well, o_orderkey % 5 = 0 AS no_start, (o_orderkey % 3) * 15000 AS md, o_orderkey % 90 AS hole FROM orders),
l AS (SELECT user_id::VARCHAR AS id, event_type <> 'purchase' AS bad_code, event_id % 3 = 1 AS bad_category, event_id % 4 = 1 AS bad_clock, event_id % 30 AS hours FROM events)
SELECT id AS report_id, 'well_name' AS field FROM r WHERE no_well UNION ALL SELECT id, 'dtim_start' FROM r WHERE no_start UNION ALL SELECT id, 'md_m' FROM r WHERE md > 20000 UNION ALL SELECT id, 'hole_diameter_in' FROM r WHERE hole > 60 UNION ALL
SELECT id, 'code' FROM l WHERE bad_code UNION ALL SELECT id, 'category' FROM l WHERE bad_category UNION ALL SELECT id, 'start' FROM l WHERE bad_clock UNION ALL SELECT id, 'hours' FROM l WHERE hours > 24""")
def q_schema_check(spark, sf_dir):
    k, e = F.col("o_orderkey"), F.col("event_id")
    reports = table(spark, sf_dir, "orders").select(k.cast("string").alias("report_id"), F.when(k % 4 != 0, "w").alias("well_name"), F.when(k % 5 != 0, "d").alias("dtim_start"), F.lit("d").alias("dtim_end"), ((k % 3) * 15000.0).alias("md_m"), (k % 90).cast("double").alias("hole_diameter_in"))
    log = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("report_id"), F.when(F.col("event_type") == "purchase", "DRILL").otherwise(F.col("event_type")).alias("code"), _by(e, ["flat", "strange", "npt"]).alias("category"), _by(e, ["06:30", "6.30", "24:00", "00:00"]).alias("start"), (e % 30).cast("double").alias("hours"))
    return validate.schema_errors(reports, log).select("report_id", "field")


@query("SELECT o_orderkey::VARCHAR AS report_id, o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0 AS ok, (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS errors, (CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END)::BIGINT AS warnings FROM orders")
def q_verdicts(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.cast("string").alias("report_id"), (k % 3 == 0).alias("valid"), _by(k, ["error", "warning"]).alias("severity"))
    return validate.verdicts(rows, rows).select("report_id", "ok", "errors", "warnings")


_DAYS_SQL = "SELECT o_custkey AS well, o_orderkey AS k FROM orders"


@query(f"""WITH d AS ({_DAYS_SQL})
SELECT k, 'sum_hours' AS field FROM d WHERE k % 11 = 0 UNION ALL SELECT k, 'time_log.hours' FROM d WHERE k % 7 = 0 UNION ALL SELECT k, 'time_log.code' FROM d WHERE k % 13 = 0 UNION ALL
SELECT k, 'connection_count' FROM d WHERE k % 17 = 0 UNION ALL SELECT k, 'md_m' FROM d WHERE k % 19 = 0 UNION ALL SELECT k, 'bit_footage' FROM d WHERE k % 9 = 0 UNION ALL SELECT k, 'bit_dull_grade' FROM d WHERE k % 10 = 0 UNION ALL
SELECT k, 'mud' FROM d WHERE k % 6 = 0 UNION ALL SELECT k, 'mud_density' FROM d WHERE k % 6 <> 0 AND k % 5 = 0 UNION ALL
SELECT k, 'md_regression' FROM (SELECT k, k % 100 AS md, lag(k % 100) OVER (PARTITION BY well ORDER BY k) AS p FROM d) WHERE md + 1e-6 < p""")
def q_reconcile(spark, sf_dir):
    k = F.col("o_orderkey")
    entry = lambda hours, code, operation: F.struct(hours.cast("double").alias("hours"), F.lit(code).alias("code") if isinstance(code, str) else code.alias("code"), F.lit(operation).alias("operation"), F.lit("flat").alias("category"), F.lit(None).cast("string").alias("npt_category"))
    plus = lambda n: F.when(k % n == 0, 1).otherwise(0)
    log = F.array(entry(24 - k % 5, "DRILL", "connection"), entry(k % 5 + plus(11), "REAM", "ream"))
    truth_log = F.array(entry(24 - k % 5 + plus(7), "DRILL", ""), entry(k % 5 + plus(11), F.when(k % 13 == 0, "FISH").otherwise("REAM"), ""))
    md = (k % 100).cast("double")
    bit = lambda footage, grade: F.array(F.struct(footage.cast("double").alias("footage_m"), F.lit(0.0).alias("depth_in_m"), F.lit(5.0).alias("depth_out_m"), grade.alias("dull_grade")))
    mud = F.struct(F.when(k % 6 == 0, "pit").otherwise("flowline").alias("sample_point"), F.lit(1.2).alias("density_gcc"), F.lit(4.0).alias("fl_ml"), F.lit(40.0).alias("funnel_viscosity_s"))
    none = F.lit(None).cast("double")
    payload = F.struct(F.struct(md.alias("md_m"), none.alias("md_in_start_m"), none.alias("progress_m")).alias("report"), log.alias("time_log"), bit(F.lit(5), F.lit("a")).alias("bit_records"), F.array(mud).alias("mud"))
    truth = F.struct(
        truth_log.alias("time_log"), (F.lit(1) + plus(17)).alias("connection_count"), F.array(F.struct((24 - k % 5).cast("double").alias("hours"))).alias("connections"), F.lit(0.0).alias("npt_hours"),
        F.array().cast("array<struct<hours:double>>").alias("npt_events"), (md + plus(19)).alias("md_m"), none.alias("progress_m"), bit(F.lit(5) + plus(9), F.when(k % 10 == 0, "b").otherwise("a")).alias("bit_records"),
        F.struct((F.lit(1.2) + plus(5)).alias("density_gcc"), F.lit(4.0).alias("fl_ml"), F.lit(40.0).alias("funnel_viscosity_s")).alias("mud"),
    )
    days = dealt(table(spark, sf_dir, "orders").withColumn("well_name", F.col("o_custkey").cast("string")), "well_name").select("well_name", k.cast("string").alias("report_date"), k.alias("ord"), payload.alias("payload"), truth.alias("truth"))
    return reconcile.check_dataset(days).select(F.col("report_date").cast("long").alias("k"), "field")


# evaluation and statistics


@query("SELECT c_custkey AS file FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def q_anti(spark, sf_dir):
    present = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("file"))
    return evaluate.missing(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file")), present)


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 5 <> 0 AS there, c_acctbal AS md FROM customer)
SELECT k AS file, 'well_name' AS field, 'header' AS "group", there AND k % 7 <> 0 AS ok FROM c UNION ALL SELECT k, 'md_m', 'header', there AND k % 3 <> 0 FROM c WHERE md IS NOT NULL UNION ALL
SELECT k, 'sum_hours', 'time_log', there AND k % 2 = 0 FROM c UNION ALL SELECT k, 'bit_count', 'bits', there AND k % 6 <> 0 FROM c""")
def q_evaluate(spark, sf_dir):
    k, md = F.col("c_custkey"), F.col("c_acctbal")
    customers = table(spark, sf_dir, "customer")
    truth = customers.select(k.alias("file"), F.col("c_name").alias("well_name"), md.alias("md_m"), F.lit(24.0).alias("sum_hours"), (k % 3).alias("bit_count"))
    name = F.when(k % 7 == 0, "other").otherwise(F.concat(F.lower("c_name"), F.lit(" ")))
    parsed = customers.where(k % 5 != 0).select(k.alias("file"), name.alias("well_name"), (md * F.when(k % 3 == 0, 1.02).otherwise(1.005)).alias("md_m"), F.when(k % 2 == 0, 24.05).otherwise(24.2).alias("sum_hours"), (k % 3 + F.when(k % 6 == 0, 1).otherwise(0)).alias("bit_count"))
    return evaluate.evaluate(truth, parsed).select("file", "field", "group", "ok")


@query("SELECT lang AS expected, count(*) AS total, count(*) FILTER (CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END = lang) AS ok FROM documents GROUP BY 1")
def q_template_accuracy(spark, sf_dir):
    actual = F.when(F.col("doc_id") % 3 == 0, "en").otherwise(F.col("lang"))
    return evaluate.template_accuracy(table(spark, sf_dir, "documents").select(F.col("lang").alias("expected"), actual.alias("actual")))


@query("SELECT doc_id AS file, 'quality' AS field FROM labels WHERE quality = 0 ORDER BY doc_id LIMIT 40")
def q_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file"), F.lit("quality").alias("field"), (F.col("quality") == 1).alias("ok"))
    return evaluate.failures(rows).select("file", "field")


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 5")
def q_most_common(spark, sf_dir):
    return stats.most_common(table(spark, sf_dir, "documents").where("source is not null"), "source", 5)


@query("SELECT 'text' AS field, count(text) AS available FROM documents UNION ALL SELECT 'lang', count(lang) FROM documents UNION ALL SELECT 'source', count(source) FROM documents")
def q_availability(spark, sf_dir):
    return stats.availability(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


def _items(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    items = orders.select(k.cast("string").alias("file"), F.when(k % 10 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("well_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("report_date"), (k % 4 != 0).alias("synthetic"))
    log = F.array(F.struct(F.lit("DRILL").alias("code"), F.lit(10.0).alias("hours"), F.lit(None).cast("string").alias("npt_category")), F.struct(F.lit("REPAIR").alias("code"), (k % 6).cast("double").alias("hours"), F.when(k % 6 > 0, "equipment").otherwise("").alias("npt_category")))
    truth = orders.where(k % 5 != 0).select(k.cast("string").alias("file"), F.when(k % 3 == 0, 24.0).otherwise(24.5).alias("sum_hours"), (k % 6).cast("double").alias("npt_hours"), (k % 4).cast("long").alias("connection_count"), log.alias("time_log"), F.when(k % 2 == 1, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("bit_records"), F.when(k % 3 == 0, F.struct(F.lit(1).alias("x"))).alias("mud"))
    return items, truth


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 <> 0 AS there, * FROM orders)
SELECT count(*) AS sample_count, count(*) FILTER (there) AS with_truth, count(*) FILTER (NOT there) AS missing, count(DISTINCT CASE WHEN k % 10 <> 0 THEN o_custkey END) AS wells, strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date,
  count(*) FILTER (k % 4 <> 0) AS synthetic, count(*) FILTER (there AND k % 3 = 0) AS compliant, count(*) FILTER (there AND k % 3 <> 0) AS violations, sum(CASE WHEN there THEN CASE WHEN k % 3 = 0 THEN 24.0 ELSE 24.5 END END)::DOUBLE AS total_hours,
  sum(CASE WHEN there THEN k % 6 END)::DOUBLE AS npt_hours, sum(CASE WHEN there THEN 10 END)::DOUBLE AS productive_hours, 0.0::DOUBLE AS flat_hours, count(*) FILTER (there AND k % 6 > 0) AS npt_days, sum(CASE WHEN there THEN k % 4 END)::BIGINT AS connections,
  count(*) FILTER (there AND k % 4 > 0) AS connection_days, count(*) FILTER (there AND k % 2 = 1) AS bit_days, count(*) FILTER (there AND k % 3 = 0) AS mud_days FROM o""")
def q_dataset_stats(spark, sf_dir):
    return stats.dataset_stats(*_items(spark, sf_dir)).drop("npt_rate", "compliance")


@query("""SELECT 'missing' AS kind, o_orderkey::VARCHAR AS name FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT 'violation', o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0
UNION ALL SELECT DISTINCT 'well', o_custkey::VARCHAR FROM orders WHERE o_orderkey % 10 <> 0""")
def q_left_warn(spark, sf_dir):
    items, truth = _items(spark, sf_dir)
    named = lambda kind, df: df.toDF("name").select(F.lit(kind).alias("kind"), "name")
    return named("missing", stats.without_truth(items, truth)).union(named("violation", stats.violations(items, truth).select("file"))).union(named("well", stats.wells(items)))


# privacy


@query("""SELECT 'well' AS kind, 'w-' || s_nationkey AS name FROM supplier WHERE s_suppkey % 2 = 0 UNION SELECT 'org', replace(lower(s_name), ' ', '') FROM supplier WHERE s_suppkey % 2 = 0
UNION SELECT 'org', 'rigco' || (s_suppkey % 10) FROM supplier WHERE s_suppkey % 2 = 0""")
def q_setops(spark, sf_dir):
    k = F.col("s_suppkey")
    manifest = table(spark, sf_dir, "supplier").select((k % 2 == 0).alias("synthetic"), F.concat(F.lit("W - "), "s_nationkey").alias("well_name"), F.col("s_name").alias("operator"), F.concat(F.lit("Rig Co "), k % 10).alias("contractor"))
    return privacy.allowlist(manifest)


@query(f"""SELECT c_custkey AS location, CASE WHEN c_custkey % 3 = 1 THEN 'may be a real well' ELSE 'may be a real organisation: ' || regexp_extract(v, {_text(privacy.SUFFIX)}, 1) END AS message, left(v, 60) AS evidence
FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'Alpha' || c_custkey || ' Drilling Ltd' WHEN 1 THEN 'AB-' || c_custkey ELSE 'Made up ' || c_nationkey || ' Limited' END AS v FROM customer) WHERE NOT (c_custkey % 3 = 2 AND c_nationkey < 12)""")
def q_privacy(spark, sf_dir):
    k = F.col("c_custkey")
    value = F.when(k % 3 == 0, F.concat(F.lit("Alpha"), k, F.lit(" Drilling Ltd"))).when(k % 3 == 1, F.concat(F.lit("AB-"), k)).otherwise(F.concat(F.lit("Made up "), "c_nationkey", F.lit(" Limited")))
    values = table(spark, sf_dir, "customer").select(k.alias("location"), F.when(k % 3 == 1, "well").otherwise("org").alias("kind"), value.alias("value"))
    allow = spark.range(12).select(F.lit("org").alias("kind"), F.concat(F.lit("madeup"), "id", F.lit("limited")).alias("name"))
    return privacy.name_findings(values, allow).select("location", "message", "evidence")


@query("""SELECT c_custkey AS location, 'text has the shape of an organisation: Holdings' AS message, '…' || right('seen by Beta' || (c_custkey % 20) || ' ', 12) || 'Holdings' AS evidence FROM customer WHERE c_custkey % 20 >= 10""")
def q_mentions(spark, sf_dir):
    k = F.col("c_custkey")
    texts = table(spark, sf_dir, "customer", by="c_custkey").select(k.alias("location"), F.concat(F.lit("seen by Beta"), k % 20, F.lit(" Holdings today")).alias("text"))
    allow = spark.range(10).select(F.lit("org").alias("kind"), F.concat(F.lit("bybeta"), "id", F.lit("holdings")).alias("name"))
    return privacy.mentions(texts, allow).select("location", "message", "evidence")


# events and texts

@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN 0 ELSE 1 END AS n, CASE event_id % 4 WHEN 3 THEN NULL ELSE event_id % 100 END AS seq FROM events")
def q_json(spark, sf_dir):
    k = F.col("event_id")
    item = F.concat(F.lit('{"seq":'), k % 100, F.lit("}"))
    answer = F.when(k % 4 == 0, F.concat(F.lit("Here:\n```json\n["), item, F.lit("]\n```"))).when(k % 4 == 1, F.concat(F.lit('{"events":['), item, F.lit("]}"))).when(k % 4 == 2, item).otherwise("no events")
    found = F.coalesce(T.json_array(answer, "array<struct<seq:bigint>>"), F.array().cast("array<struct<seq:bigint>>"))
    return table(spark, sf_dir, "events").select("event_id", F.size(found).alias("n"), F.get(found, 0)["seq"].alias("seq"))


@query("""SELECT user_id::VARCHAR AS report_id, count(*) AS events, sum(CASE WHEN event_type <> 'view' THEN event_id % 9 END)::DOUBLE AS hours, count(*) FILTER (event_type = 'view') AS without_hours,
  count(*) FILTER (event_id % 3 = 0 AND event_type <> 'view') AS unverified, count(*) FILTER (event_id % 2 = 0 AND event_type <> 'view' AND event_id % 5 = 0) AS off FROM events GROUP BY 1""")
def q_event_totals(spark, sf_dir):
    k = F.col("event_id")
    hours = F.when(F.col("event_type") != "view", (k % 9).cast("double"))
    found = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("report_id"), k.alias("seq"), hours.alias("hours"), (k % 3 != 0).alias("verified"))
    truth = table(spark, sf_dir, "events").where(k % 2 == 0).select(F.col("user_id").cast("string").alias("report_id"), k.alias("seq"), ((k % 9) + F.when(k % 5 == 0, 1.0).otherwise(0.0)).alias("true_hours"))
    return events.event_totals(found, truth)


@query("SELECT user_id::VARCHAR AS report_id, string_agg('[' || event_id || '] ' || strftime(ts, '%H:%M') || ' ' || event_type, chr(10) ORDER BY event_id) AS prompt FROM events GROUP BY 1")
def q_prompts(spark, sf_dir):
    return events.prompts(table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("report_id"), F.col("event_id").alias("seq"), F.date_format("ts", "HH:mm").alias("time_hint"), F.col("event_type").alias("text")))


_OPS = [("rotary drilling", "DRILL", "productive", None, None), ("make up connection", "DRILL", "productive", None, "connection"), ("circulate", "CIRCULATE", "flat", None, None), ("循环洗井", "CIRCULATE", "flat", None, "circulate_cycle"), ("pump failure", "REPAIR", "npt", "equipment", None), ("stuck pipe", "STUCK", "npt", "wellbore", None)]
_OWN = [(None, None), ("NPT 非生产", "npt"), ("flat time", "flat"), ("productive", "productive")]


@query(f"""SELECT p_partkey, code, category, category = 'npt' AS is_npt, CASE WHEN category = 'npt' THEN cause END AS npt_category, ilt AS ilt_action, ilt IS NOT NULL OR code IN ('DRILL', 'CIRCULATE') AS is_ilt_candidate
FROM (SELECT p_partkey, code, cause, ilt, coalesce({_by_sql('p_partkey', [c for _, c in _OWN])}, cat) AS category FROM part JOIN (VALUES {_values([(i, *o[1:]) for i, o in enumerate(_OPS)])}) o(i, code, cat, cause, ilt) ON i = p_size % 6)""")
def q_classify(spark, sf_dir):
    entries = table(spark, sf_dir, "part", by="p_partkey").select("p_partkey", _by(F.col("p_size"), [o[0] for o in _OPS]).alias("operation"), _by(F.col("p_partkey"), [h for h, _ in _OWN]).alias("category_hint"))
    return classify.classify(entries).select("p_partkey", "code", "category", "is_npt", "npt_category", "ilt_action", "is_ilt_candidate")


_ALIASES = [(i, a.lower(), o) for i, (a, o) in enumerate((a, o.code) for o in dims.OPERATIONS for a in o.aliases)]
_SEVERE_SQL = " ".join(f"WHEN regexp_matches(t, {_text(p)}) THEN '{code}'" for p, code in dims.SEVERE)
_WAIT_SQL = " OR ".join(f"starts_with(t, {_text(p)})" for p in dims.WAIT_PREFIXES)


@query(f"""WITH aliases(ord, alias, code) AS (VALUES {_values(_ALIASES)}), texts AS (
  SELECT p_partkey, a.alias || ' ; ' || b.alias AS t FROM part JOIN aliases a ON a.ord = p_partkey % {len(_ALIASES)} JOIN aliases b ON b.ord = (p_partkey * 7) % {len(_ALIASES)}),
found AS (SELECT p_partkey, first(code ORDER BY length(alias) DESC, ord) AS code FROM texts JOIN aliases ON contains(t, alias) GROUP BY 1)
SELECT p_partkey, CASE WHEN {_WAIT_SQL} THEN 'WAIT' {_SEVERE_SQL} ELSE code END AS code FROM texts JOIN found USING (p_partkey)""")
def q_cascade(spark, sf_dir):
    every = F.array(*[F.lit(a) for _, a, _ in _ALIASES])
    pick = lambda k: F.element_at(every, (k % len(_ALIASES) + 1).cast("int"))
    k = F.col("p_partkey")
    text = table(spark, sf_dir, "part", by="p_partkey").select("p_partkey", F.concat(pick(k), F.lit(" ; "), pick(k * 7)).alias("t"))
    return text.select("p_partkey", classify.normalize_code(F.col("t")).alias("code"))


_WORDS = (("the", "DRILL"), ("then", "REAM"), ("and", "TRIP_IN"), ("stand", "TRIP_OUT"), ("ation", "CASING"), ("ing", "CEMENT"), ("or", "WAIT"))


@query(f"""WITH k(alias, code, ord) AS (VALUES {_values([(a, c, i) for i, (a, c) in enumerate(_WORDS)])}), found AS (SELECT doc_id, first(code ORDER BY length(alias) DESC, ord) AS code FROM documents JOIN k ON contains(lower(text), alias) GROUP BY 1)
SELECT d.doc_id, coalesce(code, 'UNKNOWN') AS code FROM documents d LEFT JOIN found USING (doc_id)""")
def q_argmax_alias(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(classify.longest_keyword(F.lower("text"), list(_WORDS)), F.lit("UNKNOWN")).alias("code"))


# units

_ALL_UNITS = [(k, u, float(f), float(dims.OFFSETS.get((k, u), 0.0))) for k, units in dims.UNITS.items() for u, f in units.items()]


@query(f"""SELECT n_nationkey, kind, unit, round((n_nationkey * 1.5::DOUBLE + 1) * factor::DOUBLE + shift::DOUBLE, 6) AS value FROM nation, (VALUES {_values([(k, u, repr(f), repr(s)) for k, u, f, s in _ALL_UNITS])}) u(kind, unit, factor, shift)""")
def q_units(spark, sf_dir):
    value = F.col("n_nationkey") * 1.5 + 1
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(u).alias("unit"), F.round(U.convert(value, F.lit(u), k), 6).alias("value")) for k, u, _, _ in _ALL_UNITS]
    return table(spark, sf_dir, "nation").select("n_nationkey", F.inline(F.array(*rows)))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(CASE l_orderkey % 4 WHEN 2 THEN l_quantity WHEN 3 THEN NULL ELSE l_quantity * 0.3048::DOUBLE END, 6) AS si, l_quantity::DOUBLE AS raw,
  CASE l_orderkey % 4 WHEN 0 THEN 'value' WHEN 1 THEN 'label' WHEN 2 THEN 'template' ELSE 'unknown' END AS unit_source, l_orderkey % 4 <> 3 AS ok FROM lineitem""")
def q_resolve_unit(spark, sf_dir):
    k, v = F.col("l_orderkey"), F.col("l_quantity").cast("double")
    found = U.resolve_number(F.concat(v, _by(k, [" ft", "", "", ""])), "length", _by(k, [None, "Depth (ft)", "Depth", None]), _by(k, [None, None, "m", None]))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", found.alias("f"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round("f.si", 6).alias("si"), "f.raw", "f.unit_source", "f.ok")


_CELLS = [("  a \t b ", "a b", "a b"), ("Depth  MD：", "Depth MD：", "depth md"), ("合计 24.0", "合计 24.0", "合计 24.0"), ("19-3", "19-3", "19-3"), ("operator: Acme  Oil", "operator: Acme Oil", "operator: acme oil"), ("North / East", "North / East", "north / east")]


@query(f"""SELECT p_partkey, line, label, p_partkey % 6 = 2 AS is_total, p_partkey % 6 = 3 AS is_code, {_by_sql('p_partkey', ['a b', 'Depth MD', '合计 24.0', '19-3', 'Acme Oil', 'North / East'])} AS org, {_by_sql('p_partkey', [None, None, None, None, None, 'East'])} AS state
FROM part JOIN (VALUES {_values([(i, *c[1:]) for i, c in enumerate(_CELLS)])}) v(i, line, label) ON i = p_partkey % 6""")
def q_text_cells(spark, sf_dir):
    x = _by(F.col("p_partkey"), [c[0] for c in _CELLS])
    rows = table(spark, sf_dir, "part").select("p_partkey", x.alias("x"))
    x = F.col("x")
    return rows.select("p_partkey", T.normalize_line(x).alias("line"), T.normalize_label(x).alias("label"), T.is_total_row(x).alias("is_total"), T.is_code_suffix(x).alias("is_code"), T.clean_org(x).alias("org"), T.split_slash(x, 2).alias("state"))


# sinks


@query("""SELECT event_id::VARCHAR AS "序号", '06:00' AS "开始", '' AS "结束", (event_id % 24)::VARCHAR AS "历时(h)", event_type AS "操作码", CASE WHEN event_id % 2 = 0 THEN '是' ELSE '否' END AS "是否NPT" FROM events""")
def q_csv_rows(spark, sf_dir):
    k, none = F.col("event_id"), F.lit(None).cast("string")
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("report_id"), k.alias("ord"), F.lit("06:00").alias("start"), none.alias("end"), (k % 24).alias("hours"), none.alias("operation"), F.col("event_type").alias("code"), none.alias("category"), (k % 2 == 0).alias("is_npt"), none.alias("npt_category"), (k % 3 == 0).alias("is_ilt_candidate"), none.alias("ilt_action"), none.alias("duration_source"))
    return sinks.csv_rows(log).select("序号", "开始", "结束", "历时(h)", "操作码", "是否NPT")
