"""Invented days as reports: lines and cells of three layouts, and workbooks (SNK13-SNK16, SC21).

The two page layouts come as the text layer that the readers give; workbooks are real files made with the standard library.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..operators.classify import literal_map
from .synthetic import PARTIES

CELL = "struct<table_idx:int,row_idx:int,col_idx:int,text:string>"
#: Lines by layout: what stands above the tables, then the title of the remarks.
TITLES = {
    "cn_vertical": (("钻 井 日 报", "当日进尺", "井 深 (MD)", "二十四小时时间分解 时间类别", "钻头记录", "泥浆性能"), "备注"),
    "iadc_classic": (("Daily Drilling Report", "Hole & Well Data", "Measured Depth", "Time Break Down", "Bit Record", "Dull Grade"), "Remarks"),
    "regional_xls": (("钻井日报", "时间分解", "钻头记录", "泥浆性能", "井深 MD"), "备注"),
}
#: Labels of the header by layout, for the fields in this order.
FIELDS = ("well_name", "operator", "contractor", "rig", "report_no", "report_date", "md_m", "tvd_m", "progress_m", "rop_av_m_per_h")
LABELS = {
    "cn_vertical": ("井号", "作业者", "钻井承包商", "钻机", "日报编号", "作业日期", "井深", "垂深", "当日进尺", "平均钻速"),
    "iadc_classic": ("Well Name", "Operator", "Contractor", "Rig", "Report No.", "Report Date", "Measured Depth", "True Vertical Depth", "Daily Footage", "Avg. ROP"),
    "regional_xls": ("井号", "作业者", "钻井承包商", "钻机", "日报编号", "作业日期", "井深 MD", "垂深 TVD", "当日进尺", "平均钻速"),
}
TIME_HEADS = {True: ("#", "From", "To", "Hours", "Operation", "Class"), False: ("序号", "开始", "结束", "历时(h)", "作业内容", "时间类别")}
BIT_HEADS = {True: ("Bit No", "Depth In", "Depth Out", "Footage", "Dull Grade"), False: ("序号", "入井", "出井", "进尺", "磨损分级")}
MUD_HEADS = {True: ("Sample Point", "Depth", "MW", "Funnel Vis (s)", "API FL (ml)"), False: ("取样点", "井深", "密度", "漏斗粘度(s)", "失水(ml)")}
SHOWN_CLASS = {"productive": "productive", "flat": "flat", "npt": "NPT"}


def shown(value: Column, kind: str, unit: str, digits: int = 2) -> Column:
    """SC21: a value of the target unit of ``kind`` as a report prints it in ``unit``; null stays null."""
    return F.bround(value / dims.UNITS[kind][unit], digits)


def _measure(value: Column, kind: str, metric: str, imperial: str, in_imperial: Column, digits: int = 2) -> Column:
    said = lambda unit: F.concat_ws(" ", F.format_string(f"%.{digits}f", shown(value, kind, unit, digits)), F.lit(unit))
    return F.when(value.isNotNull(), F.when(in_imperial, said(imperial)).otherwise(said(metric)))


def _row(table: int, row: Column, texts) -> Column:
    cells = [F.struct(F.lit(table), row.cast("int"), F.lit(i), F.coalesce(t, F.lit(""))).cast(CELL) for i, t in enumerate(texts)]
    return F.array(*cells)


def _heads(table: int, heads: dict, english: Column) -> Column:
    at = F.lit(0)
    return F.when(english, _row(table, at, [F.lit(h) for h in heads[True]])).otherwise(_row(table, at, [F.lit(h) for h in heads[False]]))


def lines(days: DataFrame) -> DataFrame:
    """SNK13, SNK14: (doc_id, page, line_no, text): titles by layout and a remark."""
    last = F.concat(F.lit("06:30 "), F.format_string("钻进至 %.2f m，抢修 1.5 小时", F.col("md_m")))
    by = [F.when(F.col("template_id") == t, F.array(*[F.lit(x) for x in (*above, end)], last)) for t, (above, end) in TITLES.items()]
    rows = days.select(F.col("report_id").alias("doc_id"), F.lit(1).alias("page"), F.posexplode(F.coalesce(*by)).alias("line_no", "text"))
    return rows


def cells(days: DataFrame, log: DataFrame, bits: DataFrame, answers: DataFrame) -> DataFrame:
    """SNK13-SNK15: (doc_id, page, table_idx, row_idx, col_idx, text): header, time log, bit and mud of each report.

    Reports of an imperial well print feet, pounds a gallon and feet an hour in the English layout, metric units elsewhere.
    """
    english = F.col("template_id") == "iadc_classic"
    imperial = english & (F.col("unit_system") == "imperial")
    place = days.select("report_id", "template_id", "unit_system")
    drilled = answers.select(F.col("file").alias("report_id"), "rop_av_m_per_h")
    length = lambda c: _measure(F.col(c), "length", "m", "ft", imperial)
    values = {
        "well_name": F.col("well_name"), "report_no": F.col("report_no").cast("string"), "report_date": F.col("report_date"), **{k: F.lit(v) for k, v in PARTIES.items()},
        "md_m": length("md_m"), "tvd_m": length("tvd_m"), "progress_m": length("progress_m"), "rop_av_m_per_h": _measure(F.col("rop_av_m_per_h"), "speed", "m/h", "ft/hr", imperial),
    }
    labels = [F.element_at(literal_map({t: names[i] for t, names in LABELS.items()}), F.col("template_id")) for i in range(len(FIELDS))]
    head = F.flatten(F.array(*[_row(0, F.lit(i), [labels[i], values[f]]) for i, f in enumerate(FIELDS)]))
    mud = [F.when(english, "flowline").otherwise("出口"), length("md_m"), _measure(F.col("density_gcc"), "density", "g/cm3", "ppg", imperial, 3), F.col("funnel_viscosity_s").cast("string"), F.col("fl_ml").cast("string")]
    fixed = days.join(drilled, "report_id", "left").select("report_id", F.concat(head, _heads(1, TIME_HEADS, english), _heads(3, MUD_HEADS, english), _row(3, F.lit(1), mud)).alias("c"))
    entry = [F.col("ord").cast("string"), F.col("start"), F.col("end"), F.format_string("%.1f", F.col("hours")), F.col("operation"), F.element_at(literal_map(SHOWN_CLASS), F.col("category"))]
    entries = log.select("report_id", _row(1, F.col("ord"), entry).alias("c"))
    bit = [F.col("bit_no").cast("string"), length("depth_in_m"), length("depth_out_m"), length("footage_m"), F.col("dull_grade")]
    records = bits.join(place, "report_id").select("report_id", F.concat(_heads(2, BIT_HEADS, english), _row(2, F.lit(1), bit)).alias("c"))
    every = fixed.unionByName(entries).unionByName(records)
    return every.select(F.col("report_id").alias("doc_id"), F.lit(1).alias("page"), F.inline("c"))


def _name(col: int) -> str:
    out = ""
    while col >= 0:
        out, col = chr(65 + col % 26) + out, col // 26 - 1
    return out


def workbook(rows: dict[int, dict[int, str]]) -> bytes:
    """SNK15: a workbook of one sheet with these texts by row and column, from 0; the same texts give the same bytes."""
    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package, kinds = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    body = "".join(
        f'<row r="{r + 1}">' + "".join(f'<c r="{_name(c)}{r + 1}" t="inlineStr"><is><t xml:space="preserve">{escape(t)}</t></is></c>' for c, t in sorted(cols.items())) + "</row>" for r, cols in sorted(rows.items())
    )
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(zipfile.ZipInfo(name), '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


def sheet_rows(title_lines: DataFrame, table_cells: DataFrame) -> DataFrame:
    """One sheet a document: (doc_id, row, col, text); lines first, then the tables below each other with an empty row between."""
    above = title_lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    titles = title_lines.select("doc_id", F.col("line_no").cast("long").alias("row"), F.lit(0).alias("col"), "text")
    size = table_cells.groupBy("doc_id", "table_idx").agg((F.max("row_idx") + 2).alias("_h"))
    sizes = size.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("table_idx", "_h"))).alias("_hs"))
    placed = table_cells.join(sizes.join(above, "doc_id", "left"), "doc_id")
    before = F.aggregate(F.map_entries("_hs"), F.coalesce(F.col("_n"), F.lit(0)) + 1, lambda a, e: a + F.when(e["key"] < F.col("table_idx"), e["value"]).otherwise(0).cast("long"))
    return titles.unionByName(placed.select("doc_id", (before + F.col("row_idx")).alias("row"), F.col("col_idx").alias("col"), "text"))


def workbooks(sheets: DataFrame) -> DataFrame:
    """SNK15: (doc_id, content) with a workbook a document, made where its cells are."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            made = []
            for found in part["cells"]:
                rows: dict[int, dict[int, str]] = {}
                for cell in found:
                    rows.setdefault(int(cell["row"]), {})[int(cell["col"])] = cell["text"]
                made.append(workbook(rows))
            yield pd.DataFrame({"doc_id": part["doc_id"], "content": made})

    grouped = sheets.where("text <> ''").groupBy("doc_id").agg(F.collect_list(F.struct("row", "col", "text")).alias("cells"))
    return grouped.mapInPandas(build, "doc_id string, content binary")


def save_workbooks(books: DataFrame, folder: str) -> int:
    """SNK16: every workbook as ``folder``/doc_id.xlsx on the file system of ``folder``, one after another; the number of files."""
    spark = books.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 0
    for row in books.toLocalIterator():
        out = system.create(path(folder, f"{row['doc_id']}.xlsx"), True)
        try:
            out.write(bytes(row["content"]))
        finally:
            out.close()
        n += 1
    return n


def manifest(days: DataFrame) -> DataFrame:
    """SNK16: a manifest item a report; every one says that it is invented."""
    parties = [F.lit(v).alias(k) for k, v in PARTIES.items()]
    return days.select(F.col("report_id").alias("file"), F.concat("report_id", F.lit(".truth.json")).alias("truth"), "template_id", "well_name", *parties, "report_no", "report_date", "phase", "unit_system", F.lit(True).alias("synthetic"))
