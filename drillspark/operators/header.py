"""Header of a report (EX1, EX2, JN7, SC35-SC38, SC42)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import text as T
from ..functions import times as D
from ..functions import units as U
from .classify import literal_map
from .tables import _units_of


def _labels(templates: tuple[dims.Template, ...]) -> list[tuple[str, str, int]]:
    """(label, field, rank): template labels in their order, then general ones; rank orders them (JN7's tiers)."""
    found = [(n, f) for t in templates for names, f in t.labels for n in names] + [(n, f) for f, names in dims.FIELD_ALIASES.items() for n in names]
    return [(T.norm_label(n), f, i) for i, (n, f) in enumerate(dict.fromkeys(found))]


def field_of(label: Column, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> Column:
    """JN7: the field of a label: equal, then the longest label found in it as a token."""
    norm = T.normalize_label(label)
    exact: dict[str, str] = {}
    for n, f, _ in _labels(templates):
        exact.setdefault(n, f)
    known = literal_map(exact)
    near = [F.when(T.label_matches(norm, [n]), f) for n, f in sorted(exact.items(), key=lambda p: -len(p[0]))]
    return F.coalesce(F.try_element_at(known, norm), *near)


def _prefix_pattern(templates: tuple[dims.Template, ...]) -> str:
    """SC36: the longest label first; blanks may stand between CJK characters; then a separator."""
    names = sorted({n for n, _, _ in _labels(templates)}, key=len, reverse=True)
    loose = [r"[\s　]*".join(re.escape(c) for c in n.replace(" ", "")) if re.search("[一-鿿]", n) else re.escape(n) for n in names]
    return r"(?i)^\s*((?:" + "|".join(loose) + r")(?:\s*[（(][^）)]{0,20}[）)])?)(?:[\s　]*[:：][\s　]*|[\s　]+)(.+?)\s*$"


def header_values(cells: DataFrame, blocked: DataFrame, detected: DataFrame, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> DataFrame:
    """EX1, SC35-SC38: (doc_id, field, value, provenance); the first value of a field stays.

    From pairs of cells of the first table, from ``k|v|k|v`` lines and from lines that begin with a label. A number that is
    the rest of a name is no value of its own.
    """
    pairs = cells.where("table_idx = 0").select("doc_id", "page", "row_idx", "col_idx", F.trim("text").alias("text"))
    right = pairs.select("doc_id", "page", "row_idx", (F.col("col_idx") - 1).alias("col_idx"), F.col("text").alias("value"))
    left = pairs.where(F.col("col_idx") % 2 == 0).withColumn("field", field_of(F.col("text"), templates)).where("field is not null")
    from_cells = left.join(right, ["doc_id", "page", "row_idx", "col_idx"]).select("doc_id", "field", "value", F.lit("table").alias("provenance"), F.struct(F.lit(0).alias("a"), "page", F.col("row_idx").alias("b"), F.col("col_idx").alias("c")).alias("_at"))
    head = blocked.where("block = 'header'")
    barred = head.where(F.contains("text", F.lit("|"))).select("doc_id", "page", "line_no", F.posexplode(F.map_entries(T.pairs(F.col("text")))).alias("_i", "_e"))
    from_pairs = barred.select("doc_id", field_of(F.col("_e.key"), templates).alias("field"), F.col("_e.value").alias("value"), F.lit("pairs").alias("provenance"), F.struct(F.lit(1).alias("a"), "page", F.col("line_no").alias("b"), F.col("_i").alias("c")).alias("_at"))
    pattern = _prefix_pattern(templates)
    plain = head.where(~F.contains("text", F.lit("|")) & F.col("text").rlike(pattern))
    value = F.regexp_extract("text", pattern, 2)
    from_lines = plain.select("doc_id", field_of(F.regexp_extract("text", pattern, 1), templates).alias("field"), value.alias("value"), F.lit("line").alias("provenance"), F.struct(F.lit(2).alias("a"), "page", F.col("line_no").alias("b"), F.lit(0).alias("c")).alias("_at"))
    every = from_cells.unionByName(from_pairs).unionByName(from_lines).where(F.col("field").isNotNull() & (F.trim("value") != ""))
    best = every.groupBy("doc_id", "field").agg(F.min_by(F.struct("value", "provenance"), "_at").alias("_b"))
    return best.select("doc_id", "field", F.col("_b.value").alias("value"), F.col("_b.provenance").alias("provenance"))


FIELDS = tuple(dict.fromkeys([*dims.FIELD_ALIASES, "country_state"]))


def assemble(values: DataFrame, detected: DataFrame, templates: tuple[dims.Template, ...] = dims.TEMPLATES) -> DataFrame:
    """EX2: one row a report with its well and header; every detected document has one. Missing depths are null (the JSON sink writes 0.0)."""
    wide = values.groupBy("doc_id").pivot("field", list(FIELDS)).agg(F.first("value"))
    rows = detected.select("doc_id", "template_id", "unit_system").join(wide, "doc_id", "left")
    t = F.col("template_id")

    def num(field: str, kind: str, key: str, label: str) -> Column:
        found = U.resolve_number(F.col(field), kind, F.lit(label), _units_of(t, key, templates=templates), _units_of(t, key, True, templates))
        return U.rounded(found["si"], 2)

    dates = D.date_range(F.col("report_date"))
    md, progress = num("md_m", "length", "depth", "井深 (m)"), num("progress_m", "length", "footage", "当日进尺 (m)")
    return rows.select(
        F.col("doc_id").alias("report_id"), F.trim("well_name").alias("well_name"), T.clean_org(F.col("operator")).alias("operator"), T.clean_org(F.col("contractor")).alias("contractor"),
        T.clean(F.col("rig")).alias("rig"), T.clean(F.col("field")).alias("field"), T.clean(F.col("api_number")).alias("api_number"), T.split_slash(F.col("country_state"), 1).alias("country"), T.split_slash(F.col("country_state"), 2).alias("state"),
        U.to_int(F.regexp_replace("report_no", "[第号]", "")).alias("report_no"), dates["start"].alias("dtim_start"), dates["end"].alias("dtim_end"), md.alias("md_m"), num("tvd_m", "length", "depth", "垂深 (m)").alias("tvd_m"), progress.alias("progress_m"),
        F.bround(md - progress, 2).alias("md_in_start_m"), num("hole_diameter_in", "diameter", "hole_diameter", "井眼直径 (in)").alias("hole_diameter_in"), num("rop_av_m_per_h", "speed", "rop", "钻速 (m/h)").alias("rop_av_m_per_h"),
        D.duration_to_hours(F.col("etim_drill_h")).alias("etim_drill_h"), U.to_float_safe(F.col("etim_spud_days")).alias("etim_spud_days"), D.iso(D.parse_date(F.col("dtim_spud")), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("dtim_spud"),
        T.clean(F.col("well_status")).alias("well_status"), "unit_system", "template_id",
    )
