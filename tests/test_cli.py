"""Commands and their exit codes."""

import json

from drillspark.__main__ import run


def layer(tmp_path, hours):
    cells = [("From", "To", "Hours", "Operation"), ("00:00", "10:00", "10", "rotary drilling"), ("10:00", "24:00", str(hours), "circulate")]
    rows = [{"doc_id": "d1", "page": 1, "kind": "line", "line_no": 1, "text": "Daily Drilling Report"}, {"doc_id": "d1", "page": 1, "kind": "line", "line_no": 2, "text": "Well Name: A-1"}]
    rows += [{"doc_id": "d1", "page": 1, "kind": "cell", "table_idx": 0, "row_idx": r, "col_idx": c, "text": t} for r, row in enumerate(cells) for c, t in enumerate(row)]
    path = tmp_path / "layer.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    return f"file://{path}"


def test_batch_writes_and_says_whether_rules_hold(spark, tmp_path):
    assert run(["batch", layer(tmp_path, 9), "--output", f"file://{tmp_path}/out"], spark) == 1
    summary = json.loads(spark.read.text(f"file://{tmp_path}/out/_summary.json/part-*").first()[0])
    assert (summary["report_id"], summary["sum_hours"], summary["valid_24h"]) == ("d1", 19.0, False)
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out/time_log").count() == 3


def test_wrong_use(spark, tmp_path, capsys):
    assert run(["parse", f"file://{tmp_path}/none.jsonl"], spark) == 2 and run(["unheard"], spark) == 2
    assert run(["info"], spark) == 0 and "DRILL" in capsys.readouterr().out
