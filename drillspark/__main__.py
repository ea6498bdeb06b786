"""Commands over a Spark session: python -m drillspark COMMAND ... (CLI1-CLI3, CLI7, CLI9).

Exit codes: 0 done, 1 a report breaks a rule, 2 wrong use or an input that cannot be read.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from . import sinks
from .plans.engine import Engine
from .sources import text_layer, xlsx


def _arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="drillspark", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)
    for name, what in (("parse", "one JSON document a report"), ("batch", "documents, time logs and a summary of a folder"), ("chart", "hours by category and by code")):
        c = commands.add_parser(name, help=what)
        c.add_argument("input", help="a text layer (JSON lines, .parquet) or a folder of workbooks")
        c.add_argument("--output", help="a folder to write to; without one the rows are shown")
        c.add_argument("--template", help="take this template whatever the text looks like")
    commands.add_parser("info", help="the operation codes and templates")
    return top


def _read(spark: SparkSession, path: str):
    if path.endswith((".jsonl", ".json", ".parquet")):
        return text_layer(spark, path, "parquet" if path.endswith(".parquet") else "json")
    return xlsx(spark, path)[:2]


def _shown(df) -> None:
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def run(arguments: list[str], spark: SparkSession | None = None) -> int:
    try:
        asked = _arguments().parse_args(arguments)
    except SystemExit as e:
        return int(e.code or 0)
    spark = spark or SparkSession.builder.appName("drillspark").getOrCreate()
    engine = Engine(spark)
    if asked.command == "info":
        for table in engine.info():
            _shown(table)
        return 0
    try:
        parsed = engine.parse(*_read(spark, asked.input), asked.template)
    except AnalysisException as e:
        print(f"{asked.input} cannot be read: {str(e).splitlines()[0]}", file=sys.stderr)
        return 2
    documents = sinks.documents(parsed.reports, {"time_log": parsed.log, "bit_records": parsed.bits, "remarks": parsed.remarks})
    results = {"parse": {"documents": documents.select("document")}, "chart": dict(zip(("categories", "codes"), sinks.chart_model(*engine.chart(parsed)), strict=True)), "batch": {"documents": documents.select("document"), "summary": engine.batch_summary(parsed)}}[asked.command]
    for name, table in results.items():
        if not asked.output:
            _shown(table)
        elif name == "summary":
            sinks.batch_summary(table, asked.output)
        else:
            table.write.mode("overwrite").json(f"{asked.output}/{name}")
    if asked.command == "batch" and asked.output:
        sinks.write_csv(parsed.log, f"{asked.output}/time_log")
    return 0 if parsed.verdicts.where("not ok").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
