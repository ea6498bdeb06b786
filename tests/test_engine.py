"""Operators over reports: the golden day, rules at their bounds, segmentation, extraction end to end."""

import zipfile

import pytest
from drillspark import dims, sinks
from drillspark.operators import chain, evaluate, events, privacy, reconcile, segment, stats, tables, timelog, validate
from drillspark.plans.engine import Engine
from pyspark.sql import functions as F

DAY = [("00:00", "04:00", 4.0, "旋转钻进", "productive"), ("04:00", "06:30", 2.5, "扩眼划眼", "productive"), ("06:30", "08:00", 1.5, "起钻", "flat"), ("08:00", "10:30", 2.5, "顶驱 VFD 故障，配件在途", "npt"), ("10:30", "12:00", 1.5, "下套管", "flat"), ("12:00", "16:00", 4.0, "井涌，压井作业", "npt"), ("16:00", "18:00", 2.0, "固井", "flat"), ("18:00", "24:00", 6.0, "旋转钻进", "productive")]
CODES = ["DRILL", "REAM", "TRIP_OUT", "REPAIR", "CASING", "WELL_CONTROL", "CEMENT", "DRILL"]


def log_of(spark, days):
    rows = [(r, i, s, e, float(h), op, None, "reported") for r, day in days.items() for i, (s, e, h, op) in enumerate(day)]
    from drillspark.operators.classify import classify

    return classify(spark.createDataFrame(rows, "report_id string, ord int, start string, end string, hours double, operation string, category_hint string, duration_source string"))


def test_golden_day(spark):
    log = log_of(spark, {"g": [x[:4] for x in DAY]})
    assert [(r["code"], r["category"]) for r in log.orderBy("ord").collect()] == [(c, d[4]) for c, d in zip(CODES, DAY)]
    k, v = timelog.report_kpi(log).first(), timelog.verify(log).first()
    assert (k["productive_hours"], k["flat_hours"], k["npt_hours"], k["drill_hours"]) == (12.5, 5.0, 6.5, 12.5)
    assert v["valid"] and v["sum_hours"] == 24 and v["gap_hours"] == v["overlap_hours"] == 0 and v["messages"] == []


def test_24_hours(spark):
    days = {
        "short": [("00:00", "10:00", 10, "钻进"), ("10:00", "22:30", 12.5, "循环")], "long": [("00:00", "13:00", 13, "钻进"), ("13:00", "24:00", 12, "循环")], "hole": [("00:00", "06:00", 6, "钻进"), ("08:00", "24:00", 18, "循环")],
        "overlap": [("00:00", "08:00", 8, "钻进"), ("06:00", "24:00", 16, "循环")], "bare": [(None, None, 24, "钻进")], "edge": [(None, None, 23.99, "钻进")], "below": [(None, None, 23.95, "钻进")],
    }
    log = log_of(spark, days)
    v = {r["report_id"]: r for r in timelog.verify(log).collect()}
    assert [v[k]["valid"] for k in days] == [False, False, True, True, True, True, False]
    assert v["short"]["sum_hours"] == 24 and v["short"]["delta"] == -1.5 and v["short"]["gap_hours"] == 1.5 and v["long"]["delta"] == 1.0 and v["long"]["sum_hours"] == 25
    assert v["hole"]["gap_hours"] == 2 and v["hole"]["gaps"] == ["6.00-8.00"] and v["overlap"]["overlap_hours"] == 2 and v["bare"]["gap_hours"] is None
    filled = timelog.fill_gap(log).where("code = 'UNKNOWN'").orderBy("report_id").collect()
    assert [(r["report_id"], r["hours"], r["duration_source"]) for r in filled] == [("below", 0.05, "derived_from_total"), ("short", 1.5, "derived_from_total")]


def test_chain(spark):
    rows = [("A", "d1", 1, 100.0, None, None), ("A", "d2", 2, 0.0, None, None), ("A", "d3", 3, 150.0, None, None), ("A", "d4", 4, 120.0, None, None), ("", "d1", 5, 10.0, None, None), ("", "d2", 6, 20.0, None, None), ("A", "d5", 7, 130.0, 125.0, 5.0)]
    reports = spark.createDataFrame([(*r, 10.0, None) for r in rows], "well_name string, dtim_start string, file_ord int, md_m double, md_in_start_m double, progress_m double, etim_drill_h double, rop_av_m_per_h double")
    out = {r["file_ord"]: (r["md_in_start_m"], r["progress_m"], r["rop_av_m_per_h"]) for r in chain.carry_forward(reports).collect()}
    assert out == {1: (None, None, None), 2: (None, None, None), 3: (100.0, 50.0, 5.0), 4: (None, None, None), 5: (None, None, None), 6: (None, None, None), 7: (125.0, 5.0, 0.5)}
    assert [r["file_ord"] for r in chain.depth_regression(reports.where("md_m > 0 and well_name = 'A'")).collect()] == [4]


def test_rules(spark):
    reports = spark.createDataFrame([("r", 2300.0, 2350.0, 150.0, 2400.0, 50.0)], "report_id string, md_m double, md_in_start_m double, progress_m double, tvd_m double, rop_av_m_per_h double")
    log = log_of(spark, {"r": [(None, None, 7.5, "钻进"), (None, None, 1, "什么")]})
    bits = spark.createDataFrame([("r", 1, 100.0, 500.0, 500.0, 10.0, 10.0), ("r", 2, 400.0, 300.0, None, None, None)], "report_id string, ord int, depth_in_m double, depth_out_m double, footage_m double, hours double, rop_m_per_h double")
    mud = spark.createDataFrame([("r", 1, 9.9, -1.0)], "report_id string, ord int, density_gcc double, fl_ml double")
    found = sorted((r["field"], r["severity"]) for r in validate.numeric_issues(reports, log, bits, mud).collect())
    assert found == sorted([("md_m", "error"), ("progress_m", "warning"), ("tvd_m", "error"), ("rop_av_m_per_h", "warning"), ("code", "warning"), ("footage_m", "warning"), ("rop_m_per_h", "warning"), ("depth_out_m", "error"), ("depth_in_m", "warning"), ("density_gcc", "warning"), ("fl_ml", "error")])


LINES = ["钻井日报", "作业者：某作业者", "二、二十四小时时间分解", "五、备注（按时间顺序）", "06:30　06:30 钻进至 2066.06 m", "备注", "08:00 抢修 4 小时", "下步计划", "继续钻进", "到 2200 m"]


def test_segments(spark):
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(LINES)], "doc_id string, page int, line_no int, text string")
    blocked = segment.blocks(lines)
    assert [(r["line_no"], r["block"]) for r in blocked.orderBy("line_no").collect()] == [(0, "header"), (1, "header"), (4, "remarks"), (5, "remarks"), (6, "remarks"), (8, "plan"), (9, "plan")]
    assert [(r["seq"], r["time_hint"], r["text"]) for r in segment.remarks(blocked).orderBy("seq").collect()] == [(1, "06:30", "钻进至 2066.06 m"), (2, None, "备注"), (3, "08:00", "抢修 4 小时")]
    assert segment.block_text(blocked, "plan").first()["plan"] == "继续钻进 到 2200 m"


def test_detection(spark):
    texts = {"cn": "钻 井 日 报\n钻井承包商 X\n时间类别\n井深 2350 m 1.2 g/cm3 3 L/s", "en": "Daily Drilling Report\nTIME BREAK DOWN\nBIT RECORD\nMeasured Depth 7000 ft 9.9 ppg", "one": "bit record only", "none": "", "mixed": "8 ft 8 g/cm3 8 l/s"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    out = {r["doc_id"]: (r["template_id"], r["unit_system"]) for r in segment.detect(docs).collect()}
    assert out["cn"] == ("cn_vertical", "metric") and out["en"] == ("iadc_classic", "imperial") and out["one"][0] == "unknown" and out["none"] == ("unknown", "unknown")
    assert {r["template_id"] for r in segment.detect(docs, hint=F.lit("regional_xls")).collect()} == {"regional_xls"}


def cells_of(grids):
    return [("d", 1, t, r, c, x) for t, grid in enumerate(grids) for r, row in enumerate(grid) for c, x in enumerate(row)]


HEAD = [["井号", "SYN-7-3-A9H"], ["作业者", "虚构作业者"], ["日报编号", "第 7 号"], ["作业日期", "2026-03-05 00:00 至 2026-03-06 00:00"], ["井深 (MD)", "2066.06 m"], ["垂深 (TVD)", "1888.88 m"], ["当日进尺", "88.8 m"], ["平均钻速", "7.1 m/h"]]
TIME = [["序号", "开始", "结束", "历时(h)", "作业内容", "时间类别"]]
BITS = [["序号", "尺寸(in)", "型号", "入井(m)", "出井(m)", "进尺(m)", "时间(h)", "钻速(m/h)", "磨损分级"], ["1", "12.25", "M", "1634.36", "2066.06", "431.7", "41.8", "10.33", "3-4-WT-S-X-I-NO-TD"]]
MUD = [["取样点", "井深(ft)", "MW (ppg)", "漏斗粘度(s)", "失水(ml)", "pH"], ["出口", "1000", "10", "47", "4.6", "9"], ["", "1", "1", "1", "1", "1"], ["别处", "", "", "", "", ""]]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [[str(i + 1), s, e, str(h), op, c] for i, (s, e, h, op, c) in enumerate(DAY)]
    grids = [HEAD, TIME + rows[:4], TIME + rows[4:] + [["合计", "", "", "24.00", "", ""]], BITS, MUD]
    lines = ["钻 井 日 报", "钻井承包商：虚构承包商", "时间类别 二十四小时", "备注", "08:00 顶驱故障 抢修 4 小时"]
    return Engine(spark).parse(spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(lines)], "doc_id string, page int, line_no int, text string"), spark.createDataFrame(cells_of(grids), "doc_id string, page int, table_idx int, row_idx int, col_idx int, text string"))


def test_parse_header_and_log(parsed):
    r = parsed.reports.first()
    assert (r["well_name"], r["operator"], r["contractor"], r["report_no"], r["dtim_start"], r["md_m"], r["tvd_m"], r["progress_m"], r["md_in_start_m"], r["rop_av_m_per_h"], r["etim_drill_h"]) == ("SYN-7-3-A9H", "虚构作业者", "虚构承包商", 7, "2026-03-05T00:00:00", 2066.06, 1888.88, 88.8, 1977.26, 7.1, 12.5)
    assert [(x["code"], x["hours"], x["start"]) for x in parsed.raw_log.orderBy("ord").collect()] == [(c, d[2], d[0]) for c, d in zip(CODES, DAY)]
    assert parsed.verified.first()["valid"]


def test_parse_tables_and_events(parsed):
    b, m, e = parsed.bits.first(), parsed.mud.orderBy("ord").collect(), parsed.events.first()
    assert (b["depth_in_m"], b["depth_out_m"], b["footage_m"], b["rop_m_per_h"], b["size_in"], b["dull_grade_parsed"]["reason_pulled"]) == (1634.36, 2066.06, 431.7, 10.33, 12.25, "TD")
    assert (m[0]["sample_point"], m[0]["depth_m"], m[0]["density_gcc"], m[0]["fl_ml"], m[1]["sample_point"], len(m)) == ("flowline", 304.8, 1.198, 4.6, "other", 2)
    assert (e["event_type"], e["hours"], e["evidence_span"], e["npt_category"], e["verified"]) == ("equipment_failure", 4.0, "4 小时", "equipment", True)
    assert [r["stage"] for r in parsed.rejects.collect()] == ["mud"]


def test_sinks(parsed):
    doc = sinks.documents(parsed.reports, {"time_log": parsed.log, "events": parsed.events}).first()["document"]
    assert '"md_m":2066.06' in doc and doc.count('"operation"') >= 8
    assert list(sinks.csv_rows(parsed.log).columns)[1:] == list(sinks.CSV_COLUMNS.values())
    assert "## log" in sinks.markdown("t", {"log": parsed.log.select("code")}) and "compliant" in sinks.summary_text(parsed.reports, timelog.report_kpi(parsed.raw_log), parsed.verified).first()["text"]


def test_split_grid(spark):
    grid = [(0, 0, "a"), (0, 1, "b"), (1, 0, "c"), (0, 3, "x"), (1, 3, "y"), (4, 1, "q")]
    out = tables.split_grid(spark.createDataFrame([("d", 1, r, c, t) for r, c, t in grid], "doc_id string, page int, row_idx int, col_idx int, text string"))
    assert sorted((r["table_idx"], r["row_idx"], r["col_idx"], r["text"]) for r in out.collect()) == [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "c"), (1, 0, 0, "x"), (1, 1, 0, "y"), (2, 0, 0, "q")]


def test_text_lines_without_table(spark):
    lines = spark.createDataFrame([("d", 1, 0, "06:30 08:00 起钻"), ("d", 1, 1, "x"), ("d", 1, 2, "1 08:00-10:30 | 顶驱故障")], "doc_id string, page int, line_no int, text string")
    none = spark.createDataFrame([], "doc_id string, page int, table_idx int, row_idx int, col_idx int, text string")
    assert [(r["start"], r["hours"], r["code"], r["duration_source"]) for r in tables.time_log(none, lines).orderBy("ord").collect()] == [("06:30", 1.5, "TRIP_OUT", "derived_from_clock"), ("08:00", 2.5, "REPAIR", "derived_from_clock")]


def test_model_events(spark):
    remarks = spark.createDataFrame([("r", 1, None, "停工 2 小时"), ("r", 2, None, "抢修 4 小时 故障")], "report_id string, seq int, time_hint string, text string")
    answer = '```json\n[{"seq":1,"event_type":"safety","hours":2,"evidence_span":"2 小时"},{"seq":2,"event_type":"safety","hours":99,"evidence_span":"99 小时"}]\n```'
    out = events.model_events(remarks, lambda prompt: answer).orderBy("seq").collect()
    assert [(r["event_type"], r["hours"], r["extraction_method"]) for r in out] == [("safety", 2.0, "model"), ("safety", None, "model")]

    def broken(prompt):
        raise RuntimeError

    assert [r["extraction_method"] for r in events.model_events(remarks, broken).collect()] == ["rule", "rule"]


def test_privacy(spark):
    manifest = spark.createDataFrame([("a", "虚构油公司", "虚构钻井公司", "SYN-1", "f", "r", True), ("b", "某石油有限公司", "Acme Drilling Inc", "大庆-12-3", "f", "r", True), ("c", "[已脱敏]", "x", "XX-1", "f", "r", None)], "file string, operator string, contractor string, well_name string, field string, rig string, synthetic boolean")
    allow = privacy.allowlist(manifest.where("file = 'a'"))
    texts = spark.createDataFrame([("t1", "接某石油有限公司通知"), ("t2", "虚构油公司"), ("t3", "nothing here")], "location string, text string")
    out = privacy.scan(manifest, texts, allow)
    assert sorted((r["severity"], r["location"]) for r in out.collect()) == [("error", "b:contractor"), ("error", "b:operator"), ("error", "b:well_name"), ("error", "c"), ("warning", "t1")]
    assert privacy.rendered(out).first()["line"].startswith("✗")


def test_evaluate(spark):
    truth = spark.createDataFrame([("a", "W 1", 100.0, 2), ("b", "W2", 100.0, 0)], "file string, well_name string, md_m double, bit_count int")
    got = spark.createDataFrame([("a", "w1", 100.5, 1)], "file string, well_name string, md_m double, bit_count int")
    rows = evaluate.evaluate(truth, got)
    assert {(r["file"], r["field"]): r["ok"] for r in rows.collect()} == {("a", "well_name"): True, ("a", "md_m"): True, ("a", "bit_count"): False, ("b", "well_name"): False, ("b", "md_m"): False, ("b", "bit_count"): False}
    total = evaluate.accuracy_sets(rows).where("group is null and field is null").first()
    assert (total["total"], total["ok"]) == (6, 2) and len(evaluate.REGISTRY) == 29


def test_reconcile(spark):
    entry = "struct<hours:double,code:string,operation:string,category:string,npt_category:string>"
    bit = "array<struct<footage_m:double,depth_in_m:double,depth_out_m:double,dull_grade:string>>"
    mud = "struct<sample_point:string,density_gcc:double,fl_ml:double,funnel_viscosity_s:double>"
    schema = f"well_name string, report_date string, ord int, payload struct<report:struct<md_m:double,md_in_start_m:double,progress_m:double>,time_log:array<{entry}>,bit_records:{bit},mud:array<{mud}>>, truth struct<md_m:double,progress_m:double,time_log:array<{entry}>,connection_count:int,connections:array<struct<hours:double>>,npt_hours:double,npt_events:array<{entry}>,bit_records:{bit},mud:{mud}>"
    log = [(24.0, "DRILL", "钻进", "productive", None)]
    flow = ("flowline", 1.2, 4.0, 47.0)
    good = (((100.0, 90.0, 10.0), log, None, [flow]), (100.0, 10.0, log, 0, [], 0.0, [], None, flow))
    bad = (((95.0, 90.0, 10.0), [(23.0, "REAM", "接单根", "npt", None)], None, []), (100.0, 10.0, log, 0, [], 0.0, [], None, flow))
    out = reconcile.check_dataset(spark.createDataFrame([("W", "d1", 1, *good), ("W", "d2", 2, *bad)], schema))
    assert {r["report_date"] for r in out.collect()} == {"d2"}
    assert {r["field"] for r in out.collect()} == {"sum_hours", "time_log.hours", "time_log.code", "connection_count", "connections", "npt_hours", "npt_events", "md_m", "md_regression", "progress", "mud"}


def test_stats(spark):
    items = spark.createDataFrame([("a", "W", "2026-01-01", "t", "metric", True), ("b", "", "2026-01-02", "t", "metric", True)], "file string, well_name string, report_date string, template_id string, unit_system string, synthetic boolean")
    truth = spark.createDataFrame([("a", "drilling", 24.0, 4.0, 2, [("DRILL", 20.0, None), ("REPAIR", 4.0, "equipment")], [1], "m")], "file string, phase string, sum_hours double, npt_hours double, connection_count int, time_log array<struct<code:string,hours:double,npt_category:string>>, bit_records array<int>, mud string")
    s = stats.dataset_stats(items, truth).first()
    assert (s["sample_count"], s["missing"], s["wells"], s["productive_hours"], s["npt_hours"], s["npt_days"], s["npt_rate"], s["bit_days"]) == (2, 1, 1, 20.0, 4.0, 1, pytest.approx(1 / 6), 1)


def test_xlsx(spark, tmp_path):
    from drillspark import sources

    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>12.5</v></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>井号</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    (tmp_path / "b.xlsx").write_bytes(b"no zip")
    (tmp_path / "c.xls").write_bytes(b"old")
    lines, cells, bad = sources.xlsx(spark, str(tmp_path))
    assert [r["text"] for r in lines.orderBy("line_no").collect()] == ["井号 | 12.5", "x"] and cells.count() == 3
    assert [r["doc_id"] for r in bad.collect()] == ["b.xlsx"] and [r["doc_id"] for r in sources.rejects(sources.files(spark, str(tmp_path))).collect()] == ["c.xls"]


def test_dims(spark):
    assert dims.dim_code(spark).count() == 26 and dims.dim_alias(spark).first()["len"] > 10 and dims.dim_unit(spark).where("kind = 'length'").count() > 10


def test_stream(spark, tmp_path):
    from drillspark.streaming import chained

    schema = "well_name string, report_id string, dtim_start string, md_m double"
    spark.createDataFrame([("A", "1", "d1", 100.0), ("A", "2", "d2", 150.0), ("B", "3", "d1", 5.0)], schema).coalesce(1).write.json(str(tmp_path / "in"))
    q = chained(spark.readStream.schema(schema).json(str(tmp_path / "in"))).writeStream.format("memory").queryName("chained").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r["report_id"], r["md_in_start_m"], r["progress_m"]) for r in spark.table("chained").collect()) == [("1", None, None), ("2", 100.0, 50.0), ("3", None, None)]
