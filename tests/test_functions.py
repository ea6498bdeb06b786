"""Scalar functions against the cases of the blueprint's fixtures."""

import pytest
from drillspark.functions import text as T
from drillspark.functions import times as D
from drillspark.functions import units as U
from drillspark.operators import classify, events, segment
from pyspark.sql import functions as F


def test_codes(col):
    cases = {
        "短起下": "TRIP_OUT", "安装井口与防喷器": "BOP", "MWD 测斜": "LOGGING", "配浆、建立循环": "CIRCULATE", "备浆": "UNKNOWN", "Wireline logging": "LOGGING", "1": "DRILL", "2": "REAM", "9": "WELL_CONTROL",
        "起钻至套管鞋遇卡，活动解卡": "STUCK", "气测异常，关井观察后循环排气": "WELL_CONTROL", "钻具落井，下入打捞筒打捞": "FISH", "起钻至 2350 m，无遇卡显示": "TRIP_OUT",
        "等第三方固井队到场": "WAIT", "等指令": "WAIT", "waiting on orders": "WAIT", "旋转钻进": "DRILL", "扩眼划眼": "REAM", "起钻": "TRIP_OUT", "顶驱 VFD 故障，配件在途": "REPAIR", "下套管": "CASING", "井涌，压井作业": "WELL_CONTROL", "固井": "CEMENT",
        "": "UNKNOWN", None: "UNKNOWN", "未知（drilling）": "DRILL", "等天气": "WAIT",
    }
    assert dict(zip(cases, col(lambda x: classify.normalize_code(x), list(cases)))) == cases
    assert not any(c == "npt" for c in col(lambda x: classify.category_of(classify.normalize_code(x)), ["循环正常，未见漏失", "正常钻进，没有故障"]))


def test_ilt(col):
    assert col(classify.ilt_action, ["接单根（白班）", "旋转钻进 12.25″ 井段", "起钻（起立柱）", "standby", None]) == ["connection", None, "trip_stand", "trip_stand", None]


def test_events(col):
    assert col(lambda x: D.text_duration(x)["hours"], ["抢修 4 小时", "耗时 12 分钟", "钻进至 2350 m", "配件在途 6 件", "06:30 停工 2.5 小时", "0.5 天", None]) == [4.0, 0.2, None, None, 2.5, 12.0, None]
    assert col(lambda x: events.verified(F.lit("06:30 停工 2 小时"), x), ["2 小时", "06", "3 小时", None]) == [True, False, False, False]
    assert col(classify.event_type, ["pump failure", "drilling ahead", "lost circulation", "nothing"]) == ["equipment_failure", "safety", "wellbore_problem", "info"]


def test_quantity(col):
    q = col(U.parse_quantity, ["2350.0 m", "7,710.5 ft", "1.25 g/cm3", "12.25", "50 klbf", "-", "N/A", "", "-12.5", "about 7 bags", None])
    assert [None if x is None else (x["value"], x["unit"]) for x in q] == [(2350.0, "m"), (7710.5, "ft"), (1.25, "g/cm3"), (12.25, None), (50.0, "klbf"), None, None, None, (-12.5, None), (7.0, None), None]
    assert col(U.to_int, ["2.5", "3.5", "x"]) == [2, 4, None]
    assert col(U.to_float_safe, ["6,5 天", "x"]) == [6.5, None]


@pytest.mark.parametrize("kind, unit, value, expected", [("length", "ft", 10, 3.048), ("diameter", "mm", 254, 10), ("force", "kN", 1, 101.9716), ("density", "ppg", 10, 1.198264), ("pressure", "psi", 1, 6.894757), ("flow", "gpm", 100, 6.30902), ("volume", "bbl", 1, 0.1589873), ("speed", "ft/hr", 10, 3.048), ("temperature", "℉", 212, 100), ("torque", "ft-lbs", 1000, 1.355818), ("viscosity", "cP", 5, 5), ("length", None, 5, 5), ("length", "stone", 5, None)])
def test_convert(col, kind, unit, value, expected):
    out = col(lambda x: U.convert(x, F.lit(unit), kind), [float(value)], "double")[0]
    assert out == (None if expected is None else pytest.approx(expected, rel=1e-5))


def test_cascade(col):
    r = lambda text, **k: col(lambda x: U.resolve_number(x, "length", **k), [text])[0]
    lit = F.lit
    assert (r("10 ft", label=lit("Depth (m)"))["unit_source"], r("10", override=lit("ft"), label=lit("Depth (m)"))["unit_source"]) == ("value", "template-override")
    assert (r("10", label=lit("Depth (ft)"))["si"], r("10", template_unit=lit("ft"))["unit_source"]) == (pytest.approx(3.048), "template")
    plain, wrong, blank = r("10"), r("10 ppg", label=lit("Depth (m)")), r("—")
    assert plain["si"] is None and plain["raw"] == 10 and not plain["ok"] and plain["unit_source"] == "unknown"
    assert wrong["si"] == 10 and wrong["notes"] and blank["ok"] and blank["raw"] is None


def test_times(col):
    assert col(D.duration_to_hours, ["6.5", "6.5 h", "6,5", "45 min", "1h30min", "2 天", "abc", "", None]) == [6.5, 6.5, 6.5, 0.75, 1.5, 48.0, None, None, None]
    assert col(D.clock_to_hours, ["06:30", "at 24:00", "24:10", "x", None]) == [6.5, 24.0, None, None, None]
    assert col(lambda x: F.concat_ws("|", D.remark_clock(x)["hint"], D.remark_clock(x)["text"]), ["06:30 钻进", "06:00　06:30 钻进", "钻进"]) == ["06:30|钻进", "06:00|钻进", "钻进"]
    assert [str(d) for d in col(D.parse_date, ["2026-03-05", "2026/3/5", "05/03/2026", "03/25/2026", "2026年3月5日", "20260305", "on 2026-3-5.", "x"])] == ["2026-03-05", "2026-03-05", "2026-03-05", "2026-03-25", "2026-03-05", "2026-03-05", "2026-03-05", "None"]
    assert col(lambda x: D.date_range(x)["end"], ["2026-03-05 00:00 至 2026-03-06 06:00", "2026-03-05"]) == ["2026-03-06T06:00:00", "2026-03-06T00:00:00"]


def test_text(col):
    assert col(T.is_code_suffix, ["19-3", "48-12-66X", "2130.36", "942", "第 3 号"]) == [True, True, False, False, False]
    g = col(T.dull_grade, ["3-4-WT-S-X-I-NO-TD", "x"])
    assert (g[0]["inner_wear"], g[0]["reason_pulled"], g[1]) == (3, "TD", None)
    assert col(T.is_total_row, ["合计 24.00", "TOTAL | 24", "合计 必须等于 24 h 的约束说明文字", "总计划推进作业", "drilling"]) == [True, True, True, False, False]
    assert col(T.pairs, ["井号 | A | 构造|B|井号|C"])[0] == {"井号": "A", "构造": "B"}
    assert col(lambda x: T.label_matches(T.normalize_label(x), ["date"]), ["Date:", "Spud Date", "Update"]) == [True, True, False]
    assert col(lambda x: T.json_array(x, "array<struct<seq:int>>"), ['```json\n[{"seq":1}]\n```', 'so: [{"seq":2}]', '{"events":[{"seq":3}]}', '{"seq":4}', "no"]) == [[(1,)], [(2,)], [(3,)], [(4,)], None]
    assert col(T.norm_text, ["Ａ b　C", None]) == ["abc", ""]


def test_titles(col):
    lines = ["二、二十四小时时间分解", "2. TIME BREAK DOWN", "3. BIT RECORD", "4. MUD PROPERTIES", "五、备注（按时间顺序）", "本日作业摘要", "下步计划", "合计 24.00", "钻井日报", "", "备注" + "x" * 38, "备注" + "x" * 39]
    assert col(segment.title_block, lines) == ["time_log", "time_log", "bit_record", "mud", "remarks", "summary", "plan", None, None, None, "remarks", None]
    assert col(segment.is_table_header, ["起 | 止 | 历时(h) | 作业内容 | 类别 | 备注", "a\tb", "REMARKS", "五、备注（按时间顺序）", ""]) == [True, True, False, False, True]


def test_tolerance(spark):
    rows = spark.createDataFrame([(1.0, 1.01), (1.0, 1.02), (None, None), (1.0, None), (0.0, 1e-9)], "a double, b double")
    assert [r[0] for r in rows.select(U.approx(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, True]
    assert [r[0] for r in rows.select(U.number_ok(F.col("a"), F.col("b"), 0.015)).collect()] == [True, False, True, False, True]
