"""Readers: text layers, spreadsheets, manifests and truths (SRC1-SRC11, SRC13)."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import normalize_line

SHEETS = (".xlsx", ".xlsm", ".xltx")
CELLS = "doc_id string, page int, row_idx int, col_idx int, text string, error string"
ENTRY = "struct<hours:double,code:string,npt_category:string,operation:string>"
TRUTH = f"""template_id string, source_file string, well_name string, operator string, contractor string, rig string, field string, report_date string,
 truth struct<report_date:string,report_no:int,md_m:double,md_in_start_m:double,tvd_m:double,progress_m:double,etim_drill_h:double,rop_av_m_per_h:double,sum_hours:double,
 time_log:array<{ENTRY}>,npt_hours:double,npt_events:array<{ENTRY}>,connections:array<struct<seq:int,shift:string,minutes:double,hours:double,start:string,end:string>>,connection_count:int,
 mud:struct<density_gcc:double,funnel_viscosity_s:double,fl_ml:double>,hole_diameter_in:double,etim_spud_days:double,well_status:string,dtim_spud:string,
 remarks:array<struct<seq:int,time_hint:string,text:string>>,phase:string,template_id:string,unit_system:string,
 bit_records:array<struct<footage_m:double,depth_in_m:double,depth_out_m:double,dull_grade:string>>>"""
MANIFEST_ITEM = "struct<file:string,truth:string,template_id:string,well_name:string,operator:string,contractor:string,rig:string,field:string,report_no:int,report_date:string,phase:string,unit_system:string,synthetic:boolean>"


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC11: (doc_id, path, suffix, length) of a folder and all below it; the contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "path", F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1)).alias("suffix"), "length")


def rejects(found: DataFrame) -> DataFrame:
    """SRC1: (doc_id, stage, reason) of files that no reader takes; one bad file never stops a batch."""
    reason = F.when(F.col("suffix") == ".xls", "old binary sheets are not read; save as .xlsx").when(F.col("suffix") == ".pdf", "no PDF reader here; extract its text layer first").otherwise(F.concat(F.lit("unknown kind of file: "), F.col("suffix")))
    return found.where(~F.col("suffix").isin(*SHEETS, ".jsonl", ".parquet")).select("doc_id", F.lit("read").alias("stage"), reason.alias("reason"))


def text_layer(spark: SparkSession, path: str, format: str = "json") -> tuple[DataFrame, DataFrame]:
    """SRC2: lines and cells from an extracted text layer with rows (doc_id, page, kind, line_no, table_idx, row_idx, col_idx, text)."""
    schema = "doc_id string, page int, kind string, line_no int, table_idx int, row_idx int, col_idx int, text string"
    rows = spark.read.schema(schema).format(format).load(path)
    lines = rows.where("kind = 'line'").select("doc_id", "page", "line_no", normalize_line(F.col("text")).alias("text")).where("length(text) > 0")
    return lines, rows.where("kind = 'cell'").select("doc_id", "page", "table_idx", "row_idx", "col_idx", "text")


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_cells(content: bytes) -> Iterator[tuple[int, int, int, str]]:
    """(sheet, row, column, text) of a workbook, with nothing but the standard library."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in item.iter(f"{main}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{main}si")]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for number, name in enumerate(sheets, 1):
            for row in ElementTree.fromstring(book.read(name)).iter(f"{main}row"):
                for cell in row.iter(f"{main}c"):
                    value, kind = cell.find(f"{main}v"), cell.get("t")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(f"{main}t"))
                    elif value is None or value.text is None:
                        continue
                    else:
                        text = shared[int(value.text)] if kind == "s" else value.text
                    if text.strip():
                        yield number, int(row.get("r")) - 1, _column(cell.get("r")), text


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batches:
        out = []
        for doc_id, content in zip(part["doc_id"], part["content"], strict=True):
            try:
                found = [(doc_id, s, r, c, t, None) for s, r, c, t in sheet_cells(content)]
                out += found or [(doc_id, None, None, None, None, "no cell with text")]
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError) as e:
                out.append((doc_id, None, None, None, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(out, columns=["doc_id", "page", "row_idx", "col_idx", "text", "error"]).astype({"page": "Int32", "row_idx": "Int32", "col_idx": "Int32"})


def xlsx(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC3, SRC4: (lines, cells, rejects) of the workbooks below ``path``; a sheet is a page, a broken file a reject."""
    from ..operators.tables import split_grid

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xls[xm]").load(path)
    grid = raw.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "content").mapInPandas(_decode, CELLS)
    good = grid.where("error is null").drop("error")
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", F.trim("text").alias("text"))))
    lines = good.groupBy("doc_id", "page", "row_idx").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " | ").alias("text"))
    lines = lines.select("doc_id", "page", F.row_number().over(W.partitionBy("doc_id", "page").orderBy("row_idx")).alias("line_no"), normalize_line(F.col("text")).alias("text"))
    return lines, split_grid(good), grid.where("error is not null").select("doc_id", F.lit("read").alias("stage"), F.col("error").alias("reason"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """SRC6, SRC7: the items of a manifest file; an error says what is wrong with another one."""
    rows = spark.read.schema(f"items array<{MANIFEST_ITEM}>, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    bad = rows.where(F.col("items").isNull()).select(F.coalesce(F.left("_corrupt", F.lit(120)), F.lit("no items")).alias("why")).limit(1).collect()
    if bad:
        raise ValueError(f"{path} is no manifest: {bad[0]['why']}")
    return rows.select(F.inline("items"))


def truths(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: truth files, one row a file; broken ones have null truths. ``file`` is the name without .truth.json."""
    rows = spark.read.schema(TRUTH).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.truth.json").json(path)
    return rows.withColumn("file", F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.truth\.json$", ""))


def dataset(spark: SparkSession, path: str, payload_schema: str) -> DataFrame:
    """SRC9: a generated dataset's days: well_name, report_date, ord, payload, truth."""
    truth = TRUTH[TRUTH.index("truth struct") + 6 :]
    schema = f"samples array<struct<well:struct<well_name:string>,days:array<struct<day_index:int,report_date:string,payload:{payload_schema},truth:{truth}>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    if not rows.where("samples is not null").take(1):
        raise ValueError(f"{path} is no dataset: samples are missing")
    days = rows.select(F.inline("samples")).select(F.col("well.well_name").alias("well_name"), F.posexplode("days").alias("_i", "d"))
    return days.select("well_name", F.col("d.report_date").alias("report_date"), F.coalesce("d.day_index", "_i").alias("ord"), F.col("d.payload").alias("payload"), F.col("d.truth").alias("truth"))
