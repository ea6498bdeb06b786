"""Invented reports: hours that fill the day, the same data however partitioned, workbooks that read back, answers that parsing finds."""

from drillspark.fixtures import render, synthetic
from drillspark.operators import evaluate
from drillspark.plans.engine import Engine
from pyspark.sql import functions as F


def laid(blocks):
    """The day laid out the plain way: tenths of the blocks that are left."""
    kept, at = [], 0
    for tenths in blocks:
        if tenths >= 1 and at < 240:
            kept.append(tenths)
            at += tenths
    if kept and at < 240:
        kept[-1] += 240 - at
    over = at - 240
    for i in sorted(range(len(kept)), key=lambda i: -kept[i]):
        off = max(0, min(over, kept[i] - 1))
        kept[i] -= off
        over -= off
    return kept


def test_materialise(spark):
    cases = {"short": [100, 0, 20], "long": [100, 100, 100, 5], "exact": [240], "hot": [239, 239, 1], "ties": [90, 90, 90], "none": [0]}
    rows = spark.createDataFrame([(k, i, t) for k, v in cases.items() for i, t in enumerate(v)], "report_id string, ord int, tenths int")
    out = synthetic.materialise(rows).orderBy("report_id", "ord").collect()
    got = {k: [round(r["hours"] * 10) for r in out if r["report_id"] == k] for k in cases}
    assert got == {k: laid(v) for k, v in cases.items()} and got["none"] == []
    assert all(r["end"] == "24:00" for r in out if r["ord"] == len(got[r["report_id"]]))
    assert synthetic.materialise(rows.limit(0)).count() == 0


def test_days_do_not_depend_on_partitions(spark):
    plan = synthetic.Plan(wells=2, days=4)
    days = synthetic.days(spark, plan)
    log = synthetic.time_log(days, plan)
    assert sorted(log.collect()) == sorted(synthetic.time_log(days.repartition(3), plan).collect())
    sums = log.groupBy("report_id").agg(F.sum(F.col("hours").cast("decimal(9,2)")).alias("h")).collect()
    assert len(sums) == 8 and {float(r["h"]) for r in sums} == {24.0}
    depths = [(r["well"], r["md_m"]) for r in days.orderBy("well", "day").collect()]
    assert all(a[0] != b[0] or a[1] <= b[1] for a, b in zip(depths, depths[1:]))
    details = synthetic.connection_details(log)
    assert details.count() == log.where("ilt_action = 'connection'").count() and details.where("minutes not between 9 and 21").isEmpty()


def test_reports_are_parsed_to_their_answers(spark, tmp_path):
    plan = synthetic.Plan(wells=2, days=4)
    days = synthetic.days(spark, plan)
    log, bits = synthetic.time_log(days, plan), synthetic.bits(days)
    truth = synthetic.truth(days, log, bits)
    tables = {"lines": render.lines(days), "cells": render.cells(days, log, bits, truth), "truth": truth}
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}")
    lines, cells, truth = (spark.read.parquet(f"{tmp_path}/{n}") for n in tables)
    parsed = Engine(spark).parse(lines, cells).written(str(tmp_path / "parsed"), ("reports", "raw_log", "bits", "mud"))
    rows = evaluate.evaluate(truth, evaluate.parsed_fields(parsed))
    wrong = [(r["file"], r["field"], r["expected"], r["actual"]) for r in rows.where("not ok").collect()]
    assert wrong == []
    assert {r["template_id"] for r in parsed.reports.collect()} == set(synthetic.LAYOUTS)


def test_workbooks_read_back(spark, tmp_path):
    from drillspark import sources

    lines = spark.createDataFrame([("d", 0, "钻井日报"), ("d", 1, "a < b & c")], "doc_id string, line_no int, text string")
    grid = [("d", t, r, c, f"{t}{r}{c}") for t, h, w in ((0, 2, 2), (1, 3, 28)) for r in range(h) for c in range(w)]
    cells = spark.createDataFrame(grid, "doc_id string, table_idx int, row_idx int, col_idx int, text string")
    assert render.save_workbooks(render.workbooks(render.sheet_rows(lines, cells)), f"file://{tmp_path}/books") == 1
    read_lines, read_cells, bad = sources.xlsx(spark, f"file://{tmp_path}/books")
    assert bad.count() == 0 and [r["text"] for r in read_lines.orderBy("line_no").take(2)] == ["钻井日报", "a < b & c"]
    by_table = {r["text"] for r in read_cells.where("table_idx > 0").collect()}
    assert by_table == {g[4] for g in grid}
