"""The driver's contract: names, SQL for known queries only, and a flagship with rows; without subpackage llm too."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert len(queries) >= 35 and set(sql) <= set(queries)


def test_flagship(spark):
    out = entry.entry(spark)
    assert {"report_id", "valid", "npt_rate"} <= set(out.columns) and out.count() > 0


def test_without_llm(tmp_path):
    import shutil

    shutil.copytree(REPO / "drillspark", tmp_path / "drillspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    (tmp_path / "drillspark" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 35 and not [n for n in q if n.startswith('op') or n == 'pipeline'], q"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0
