"""Bounds that are gone: decoration of any depth, reports of any length; blanks and marks around operations."""

from drillspark import sinks
from drillspark.functions import text as T
from drillspark.operators import classify


def test_decoration_goes_to_the_end(col):
    cases = ["小" * 6 + "时" * 6, "小" * 30 + "时" * 30, "(1) 泥浆性能 (m)", "", None, "abc"]
    assert col(T.strip_decor, cases) == ["", "", "泥浆性能", "", None, "abc"]


def test_every_row_is_written(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "cast(null as string) AS note")
    assert sinks.markdown("t", {"all": rows}).count("| — |") == 1000
    sinks.write_markdown(rows, f"{tmp_path}/md")
    assert spark.read.text(f"{tmp_path}/md").count() == 1000


def test_blanks_and_marks(col):
    cases = ["1.", " rotary   drilling ; ", "、起钻具。", "directional drilling，circulate bottom up", "rotary drilling，run in hole", "casing running，safety meeting", "down for repair，bop test", "......"]
    assert col(classify.normalize_code, cases) == ["DRILL", "DRILL", "TRIP_OUT", "DRILL", "DRILL", "CASING", "REPAIR", "UNKNOWN"]
