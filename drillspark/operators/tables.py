"""Tables of a page from cells (doc_id, page, table_idx, row_idx, col_idx, text): SRC4, SRC14, JN8-JN11, FLT8-FLT10, FLT24, SET3, EX3, EX5, EX6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import dims
from ..functions import text as T
from ..functions import times as D
from ..functions import units as U
from .classify import classify, literal_map
from .spread import dealt

KEY = ["doc_id", "page", "table_idx"]


def split_grid(grid: DataFrame) -> DataFrame:
    """SRC4, WIN10: a sheet's cells (doc_id, page, row_idx, col_idx, text) as tables: runs of rows that are not empty, and in each runs of columns."""
    full = grid.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    rows = full.select("doc_id", "page", "row_idx").distinct()
    by_row = W.partitionBy("doc_id", "page").orderBy("row_idx")
    rows = rows.withColumn("_b", (F.col("row_idx") - F.lag("row_idx", 1, -2).over(by_row) > 1).cast("int")).withColumn("_rows", F.sum("_b").over(by_row)).drop("_b")
    held = full.join(rows, ["doc_id", "page", "row_idx"])
    cols = held.select("doc_id", "page", "_rows", "col_idx").distinct()
    by_col = W.partitionBy("doc_id", "page", "_rows").orderBy("col_idx")
    cols = cols.withColumn("_b", (F.col("col_idx") - F.lag("col_idx", 1, -2).over(by_col) > 1).cast("int")).withColumn("_cols", F.sum("_b").over(by_col)).drop("_b")
    placed = held.join(cols, ["doc_id", "page", "_rows", "col_idx"])
    inside = W.partitionBy("doc_id", "page", "_rows", "_cols")
    table_idx = F.dense_rank().over(W.partitionBy("doc_id", "page").orderBy("_rows", "_cols")) - 1
    return placed.select("doc_id", "page", table_idx.alias("table_idx"), (F.col("row_idx") - F.min("row_idx").over(inside)).alias("row_idx"), (F.col("col_idx") - F.min("col_idx").over(inside)).alias("col_idx"), "text")


def ruled(cells: DataFrame) -> DataFrame:
    """FLT24: tables with two rows or more."""
    big = cells.groupBy(*KEY).agg(F.count_distinct("row_idx").alias("_n")).where("_n >= 2").drop("_n")
    return cells.join(big, KEY, "left_semi")


def as_rows(cells: DataFrame) -> DataFrame:
    """SRC14: one row a table row, its cells as an array by column; missing ones are empty, of double ones the first text stays.

    Cells go to tasks by document, so that nothing of a document is shuffled again, and are only gathered there.
    """
    entries = F.sort_array(F.collect_list(F.struct("col_idx", F.trim(F.coalesce("text", F.lit(""))).alias("text"))))
    rows = dealt(cells, "doc_id").groupBy(*KEY, "row_idx").agg(entries.alias("_e"), F.max("col_idx").alias("_w"))
    full = (F.size("_e") == F.col("_w") + 1) & (F.size(F.array_distinct(F.col("_e.col_idx"))) == F.size("_e")) & (F.get(F.col("_e.col_idx"), 0) == 0)
    first = F.filter("_e", lambda e, i: (i == 0) | (F.get(F.col("_e.col_idx"), i - 1) != e["col_idx"]))
    by_column = U.let(F.map_from_entries(first), lambda m: F.transform(F.sequence(F.lit(0), F.col("_w")), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(""))))
    return rows.select(*KEY, "row_idx", F.when(full, F.col("_e.text")).otherwise(by_column).alias("cells"))


def signature_hits(row_text: Column, words) -> Column:
    low = F.lower(row_text)
    parts = [F.contains(low, F.lit(w.lower())).cast("int") for w in words]
    return sum(parts[1:], parts[0])


def with_heads(rows: DataFrame, kind: str, columns, scan: int = 4, least: int = 2) -> DataFrame:
    """JN9, JN11, SC55: rows of tables of a kind with hits, head_row, head and columns of their table.

    The header row is the one with most signature words among the first rows, the earliest of equals. All windows have one
    order, that of a document's rows, so rows are sorted once.
    """
    table = W.partitionBy(*KEY).orderBy("row_idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    score = F.when(F.col("row_idx") < scan, F.struct(signature_hits(F.array_join("cells", " "), dims.TABLE_SIGNATURES[kind]).alias("hits"), (-F.col("row_idx")).alias("neg")))
    best = rows.where(" and ".join(f"{k} is not null" for k in KEY)).withColumn("_s", score).withColumn("_b", F.max("_s").over(table)).where(F.col("_b.hits") >= least)
    here = F.col("row_idx") == -F.col("_b.neg")
    own = best.withColumn("_h", F.when(here, F.struct(F.col("cells").alias("head"), map_columns(F.col("cells"), columns).alias("columns"))))
    told = own.withColumn("_h", F.first("_h", ignorenulls=True).over(table))
    return told.select(*KEY, "row_idx", "cells", F.col("_b.hits").alias("hits"), (-F.col("_b.neg")).alias("head_row"), F.col("_h.head").alias("head"), F.col("_h.columns").alias("columns"))


def best_table(rows: DataFrame) -> DataFrame:
    """JN10: of a document's tables of a kind the one with most hits, the earliest of equals."""
    document = W.partitionBy("doc_id").orderBy("page", "table_idx", "row_idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rank = F.struct((-F.col("hits")).alias("hits"), F.col("page").alias("page"), F.col("table_idx").alias("table_idx"))
    return rows.withColumn("_r", rank).withColumn("_k", F.min("_r").over(document)).where("_r = _k").drop("_r", "_k")


def map_columns(head: Column, columns) -> Column:
    """JN8: map of field to column index. Left to right each cell takes the first field that matches and is not taken yet.

    A cell is normalised and matched once, before the fold, for a lambda works out what it names anew wherever it names it.
    """
    fields = [f for _, f in columns]

    def matching(cell):
        return U.let(T.normalize_label(cell), lambda label: F.array_compact(F.array(*[F.when(T.label_matches(label, names), f) for names, f in columns])))

    def step(taken, x):
        free = F.try_element_at(F.filter(x["fields"], lambda c: ~F.array_contains(F.map_keys(taken), c)), F.lit(1))
        return U.let(free, lambda f: F.when(f.isNull(), taken).otherwise(F.map_concat(taken, F.map_from_arrays(F.array(F.coalesce(f, F.lit(fields[0]))), F.array(x["at"])))))

    cells = F.transform(head, lambda c, i: F.struct(matching(c).alias("fields"), i.alias("at")))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    return F.aggregate(cells, none, step)


def _cell(field: str) -> Column:
    at = F.try_element_at(F.col("columns"), F.lit(field))
    return F.nullif(F.trim(F.get("cells", at)), F.lit(""))


def _label(field: str) -> Column:
    return F.coalesce(F.get("head", F.try_element_at(F.col("columns"), F.lit(field))), F.lit(""))


def data_rows(cells: DataFrame, kind: str, columns, every: bool) -> DataFrame:
    """Rows below the header of all tables of a kind (SET3: continuation tables one after another) or of the best one; without totals, blank rows and repeated headers (FLT8, FLT9)."""
    rows = with_heads(as_rows(cells), kind, columns)
    body = (rows if every else best_table(rows)).where(F.col("row_idx") > F.col("head_row"))
    joined = F.array_join("cells", " ")
    return body.where((F.trim(joined) != "") & ~T.is_total_row(joined) & (F.col("cells") != F.col("head")))


def _ord() -> Column:
    return F.row_number().over(W.partitionBy("doc_id").orderBy("page", "table_idx", "row_idx"))


def time_log(cells: DataFrame, lines: DataFrame | None = None, operations=dims.OPERATIONS) -> DataFrame:
    """EX3: report_id, ord, start, end, hours, operation and classification; from tables, or from text lines of documents without one.

    Hours come from their column, else from the clocks. Rows without hours are dropped (FLT10); see ``rejected_rows``.
    """
    body = data_rows(cells, "time_log", dims.TIME_COLUMNS, every=True)
    entries = body.select("doc_id", _ord().alias("ord"), D.format_clock(_cell("start")).alias("start"), D.format_clock(_cell("end")).alias("end"), _cell("hours").alias("hours_text"), _cell("operation").alias("operation"), _cell("category").alias("category_hint"))
    if lines is not None:
        shape = r"^\s*(?:\d{1,3}[\s　|]+)?([01]?\d:[0-5]\d|2[0-4]:[0-5]\d)[\s　|\-–—~至]+([01]?\d:[0-5]\d|2[0-4]:[0-5]\d)[\s　|]+(.*?)\s*$"
        plain = lines.join(entries.select("doc_id").distinct(), "doc_id", "left_anti").where(F.col("text").rlike(shape))
        part = lambda i: F.regexp_extract("text", shape, i)
        loose = plain.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("page", "line_no")).alias("ord"), D.format_clock(part(1)).alias("start"), D.format_clock(part(2)).alias("end"), F.lit(None).cast("string").alias("hours_text"), F.nullif(part(3), F.lit("")).alias("operation"), F.lit(None).cast("string").alias("category_hint"))
        entries = entries.unionByName(loose)
    own = D.duration_to_hours(F.col("hours_text"))
    clocked = F.bround(D.span(D.clock_exact(F.col("start")), D.clock_exact(F.col("end"))), 4)
    timed = entries.withColumn("hours", F.coalesce(own, clocked)).withColumn("duration_source", F.when(own.isNotNull(), "reported").when(clocked.isNotNull(), "derived_from_clock"))
    return classify(timed.where("hours > 0"), operations).withColumnRenamed("doc_id", "report_id").drop("hours_text")


def rejected_rows(cells: DataFrame) -> DataFrame:
    """Rows that extraction leaves out without a trace in the report: no duration, or a mud row without sample point."""
    body = data_rows(cells, "time_log", dims.TIME_COLUMNS, every=True)
    hours = F.coalesce(D.duration_to_hours(_cell("hours")), D.span(D.clock_to_hours(_cell("start")), D.clock_to_hours(_cell("end"))))
    no_hours = body.where(F.coalesce(hours, F.lit(0.0)) <= 0).select("doc_id", F.lit("time_log").alias("stage"), F.concat(F.lit("no duration: "), F.array_join("cells", " | ")).alias("reason"))
    mud = data_rows(cells, "mud", dims.MUD_COLUMNS, every=False).where(_cell("sample_point").isNull())
    return no_hours.unionByName(mud.select("doc_id", F.lit("mud").alias("stage"), F.concat(F.lit("no sample point: "), F.array_join("cells", " | ")).alias("reason")))


def _units_of(template: Column, key: str, override: bool = False, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> Column:
    pairs = {t.template_id: (t.overrides if override else t.units).get(key) for t in templates}
    pairs = {k: v for k, v in pairs.items() if v}
    return F.try_element_at(literal_map(pairs), template) if pairs else F.lit(None).cast("string")


def _numbers(body: DataFrame, kinds, plain, templates: tuple[dims.Template, ...], override: bool) -> DataFrame:
    """Cells as columns by field, and a struct of U.resolve_number for each (field, kind, key of the template's units).

    Cells are looked up in one projection and numbers resolved in the next, so that neither is worked out again where it is named.
    """
    looked = body.select("doc_id", "ord", "template_id", *[_cell(f).alias(f) for f in (*plain, *(f for f, _, _ in kinds))], *[_label(f).alias(f"_label_{f}") for f, _, _ in kinds])
    t = F.col("template_id")
    unit_of = lambda key, own: _units_of(t, key, own, templates)
    return looked.select("doc_id", "ord", *plain, *[f for f, _, _ in kinds], *[U.resolve_number(F.col(f), kind, F.col(f"_label_{f}"), unit_of(key, False), unit_of(key, True) if override else None).alias(f"_{f}") for f, kind, key in kinds])


def bits(cells: DataFrame, detected: DataFrame, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> DataFrame:
    """EX5, WIN11, SC39: bit records of the best table, in target units."""
    body = data_rows(cells, "bit_record", dims.BIT_COLUMNS, every=False).withColumn("ord", _ord()).join(detected.select("doc_id", "template_id"), "doc_id", "left")
    kinds = (("size_in", "diameter", "bit_size"), ("depth_in_m", "length", "depth"), ("depth_out_m", "length", "depth"), ("footage_m", "length", "footage"), ("rop_m_per_h", "speed", "rop"), ("wob_kgf", "force", "wob"), ("flow_lps", "flow", "flow"))
    texts = ("make", "model", "type", "iadc_code", "nozzles_32nds", "dull_grade")
    rounds = {"wob_kgf": 1, "flow_lps": 1}
    type_of = F.try_element_at(literal_map(dims.BIT_TYPES), F.lower("type"))
    return _numbers(body, kinds, (*texts, "bit_no", "hours", "rpm"), templates, True).select(
        F.col("doc_id").alias("report_id"), "ord", F.coalesce(F.nullif(U.to_int(F.col("bit_no")), F.lit(0)), F.col("ord")).alias("bit_no"),
        "make", "model", F.coalesce(type_of, F.col("type")).alias("type"), "iadc_code", "nozzles_32nds",
        *[U.rounded(F.col(f"_{f}.si"), rounds.get(f, 2)).alias(f) for f, _, _ in kinds], U.to_float(F.col("hours")).alias("hours"), U.to_float(F.col("rpm")).alias("rpm"),
        "dull_grade", T.dull_grade(F.col("dull_grade")).alias("dull_grade_parsed"), F.array_distinct(F.flatten(F.array(*[F.col(f"_{f}.notes") for f, _, _ in kinds]))).alias("warnings"),
    )


def mud(cells: DataFrame, detected: DataFrame, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> DataFrame:
    """EX6, SC20, JN23: mud samples of the best table; a value without any unit keeps its raw number, and raw says so."""
    body = data_rows(cells, "mud", dims.MUD_COLUMNS, every=False).where(_cell("sample_point").isNotNull()).withColumn("ord", _ord()).join(detected.select("doc_id", "template_id"), "doc_id", "left")
    kinds = (("depth_m", "length", "depth"), ("density_gcc", "density", "density"), ("volume_m3", "volume", "volume"), ("pv_mpas", "viscosity", "viscosity"))
    plain = ("funnel_viscosity_s", "yp_pa", "gel_10s_pa", "gel_10min_pa", "fl_ml", "ph", "chlorides_mg_l", "sand_pct", "solids_pct")
    texts = ("oil_water_ratio", "mud_type")
    rounds = {"density_gcc": 3, "depth_m": 1, "volume_m3": 1}
    point = F.when(F.col("sample_point").isNotNull(), F.coalesce(F.try_element_at(literal_map(dims.SAMPLE_POINTS), F.lower("sample_point")), F.lit("other")))
    source = lambda v: F.when(v["si"].isNull() & v["raw"].isNotNull(), "unknown_raw").otherwise(v["unit_source"])
    raw = F.map_from_entries(F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("key"), F.concat_ws(" ", F.col(f), F.concat(F.lit("["), source(F.col(f"_{f}")), F.lit("]"))).alias("value"))) for f, _, _ in kinds])))
    return _numbers(body, kinds, ("sample_point", *plain, *texts), templates, False).select(
        F.col("doc_id").alias("report_id"), "ord", point.alias("sample_point"), *[U.rounded(U.kept(F.col(f"_{f}")), rounds.get(f, 2)).alias(f) for f, _, _ in kinds],
        *[U.to_float(F.col(f)).alias(f) for f in plain], *texts, raw.alias("raw"),
        F.array_distinct(F.flatten(F.array(*[F.col(f"_{f}.notes") for f, _, _ in kinds]))).alias("warnings"),
    )


def flowline(samples: DataFrame) -> DataFrame:
    """FLT26: a report's first flowline sample."""
    w = W.partitionBy("report_id").orderBy("ord")
    return samples.where(F.col("sample_point") == "flowline").withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
