"""Accuracy of parsed reports against truth (VAL8, VAL9, VAL12, AGG16-AGG19, JN14-JN16, FLT28, SRT2, UD3). Truth and report meet on file, not on position."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_equal
from ..functions.units import number_ok
from .tables import flowline
from .timelog import report_kpi


@dataclass(frozen=True)
class Assertion:
    name: str
    group: str
    build: Callable[[], tuple[Column, Column, Column]]  # expected, actual, ok


REGISTRY: list[Assertion] = []


def assertion(name: str, group: str):
    """UD3: register a function that gives (expected, actual, ok) over columns t_* (truth) and p_* (parsed)."""

    def add(f):
        REGISTRY.append(Assertion(name, group, f))
        return f

    return add


def _text(name: str, group: str, contains: bool = False, cut: int | None = None) -> None:
    def build():
        e, a = F.col(f"t_{name}").cast("string"), F.col(f"p_{name}").cast("string")
        e, a = (F.left(e, F.lit(cut)), F.left(a, F.lit(cut))) if cut else (e, a)
        return e, a, text_equal(e, a, contains)

    assertion(name, group)(build)


def _number(name: str, group: str, tolerance: float) -> None:
    def build():
        e, a = F.col(f"t_{name}").cast("double"), F.col(f"p_{name}").cast("double")
        return e, a, number_ok(e, a, tolerance)

    assertion(name, group)(build)


# The assertions, their groups and tolerances.
_text("well_name", "header")
for _n in ("operator", "contractor", "rig"):
    _text(_n, "header", contains=True)
_number("report_no", "header", 0.0)
_text("report_date", "header", cut=10)
for _n in ("md_m", "tvd_m", "progress_m"):
    _number(_n, "header", 0.01)
for _n in ("rop_av_m_per_h", "etim_drill_h"):
    _number(_n, "header", 0.03)
_number("sum_hours", "time_log", 0.005)
_number("time_entry_count", "time_log", 0.0)
_number("npt_hours", "npt", 0.02)
_number("npt_entry_count", "npt", 0.0)
_number("mud_density_gcc", "mud", 0.02)
for _n in ("mud_fl_ml", "mud_viscosity_s"):
    _number(_n, "mud", 0.05)
_number("bit_count", "bits", 0.0)
for _n in ("bit_depth_out_m", "bit_footage_m"):
    _number(_n, "bits", 0.01)
_text("bit_dull_grade", "bits")
_number("connection_count", "ilt", 0.0)
_number("connection_hours", "ilt", 0.05)
_number("event_count", "events", 0.0)
_number("event_hours_total", "events", 0.05)
_number("event_hours_none", "events", 0.0)
_number("event_duration_off", "events", 0.0)
_number("event_unverified", "events", 0.0)


def evaluate(truth: DataFrame, parsed: DataFrame, key: str = "file") -> DataFrame:
    """VAL8, VAL9: (key, field, group, expected, actual, ok), one row an assertion and truth row; both null is not scored (FLT28).

    Columns that a side lacks are null there. Truths without a parsed report fail; ``missing`` lists parsed ones without truth (SET5, JN14).
    """
    names = [a.name for a in REGISTRY]
    side = lambda df, p: df.select(key, *[(F.col(n) if n in df.columns else F.lit(None).cast("string")).alias(f"{p}_{n}") for n in names])
    joined = side(truth, "t").join(side(parsed, "p"), key, "left")

    def row(a: Assertion) -> Column:
        e, p, ok = a.build()
        scored = F.when(e.isNotNull() | p.isNotNull(), F.coalesce(ok, F.lit(False)))
        return F.struct(F.lit(a.name).alias("field"), F.lit(a.group).alias("group"), e.cast("string").alias("expected"), p.cast("string").alias("actual"), scored.alias("ok"))

    return joined.select(key, F.inline(F.array(*[row(a) for a in REGISTRY]))).where(F.col("ok").isNotNull())


def parsed_fields(parsed) -> DataFrame:
    """JN15: a parsed batch as one row a report under the names of the assertions; ``file`` is the report.

    Bits are judged by the first record, mud by the first flowline sample.
    """
    kpi = report_kpi(parsed.raw_log).select("report_id", F.col("entries").alias("time_entry_count"), "sum_hours", "npt_hours", F.col("npt_entries").alias("npt_entry_count"), F.col("connections").alias("connection_count"), "connection_hours")
    bit = parsed.bits.groupBy("report_id").agg(F.count(F.lit(1)).alias("bit_count"), F.min_by(F.struct("depth_out_m", "footage_m", "dull_grade"), "ord").alias("_b"))
    bit = bit.select("report_id", "bit_count", *[F.col(f"_b.{c}").alias(f"bit_{c}") for c in ("depth_out_m", "footage_m", "dull_grade")])
    mud = flowline(parsed.mud).select("report_id", F.col("density_gcc").alias("mud_density_gcc"), F.col("fl_ml").alias("mud_fl_ml"), F.col("funnel_viscosity_s").alias("mud_viscosity_s"))
    rows = parsed.reports
    for side in (kpi, bit, mud):
        rows = rows.join(side, "report_id", "left")
    return rows.withColumnsRenamed({"report_id": "file"}).withColumns({"report_date": F.left("dtim_start", F.lit(10)), "bit_count": F.coalesce("bit_count", F.lit(0))})


def worst_first(accuracy: DataFrame) -> DataFrame:
    """SRT2: by accuracy, least first; none counts as 0."""
    return accuracy.orderBy(F.coalesce("accuracy", F.lit(0.0)), *[c for c in ("group", "field") if c in accuracy.columns])


def fingerprint(spark) -> DataFrame:
    """VAL12: (key, value): when, with what and of which commit a result is; without git it says so."""
    import platform
    import subprocess
    from datetime import UTC, datetime
    from pathlib import Path

    def git(*arguments: str) -> str | None:
        try:
            done = subprocess.run(["git", *arguments], cwd=Path(__file__).parent, capture_output=True, encoding="utf-8", errors="replace", timeout=10)
        except (OSError, subprocess.SubprocessError):
            return None
        return done.stdout.strip() if done.returncode == 0 else None

    changed = git("status", "--porcelain", ":/")
    state = "unknown" if changed is None else "changed" if changed else "clean"
    facts = {"made_at": datetime.now(UTC).isoformat(timespec="seconds"), "python": platform.python_version(), "spark": spark.version, "commit": git("rev-parse", "--short", "HEAD") or "unknown", "tree": state}
    return spark.createDataFrame(list(facts.items()), "key string, value string")


def missing(registered: DataFrame, present: DataFrame, key: str = "file") -> DataFrame:
    return registered.select(key).join(present.select(key), key, "left_anti")


def accuracy_sets(rows: DataFrame, group: str = "group", field: str = "field") -> DataFrame:
    """AGG16-AGG18: accuracy by group, by group and field, and overall, in one pass."""
    out = rows.groupingSets([[F.col(group)], [F.col(group), F.col(field)], []], group, field).agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"))
    return out.select(group, field, "total", "ok", F.round(F.col("ok") / F.col("total"), 4).alias("accuracy"))


def failures(rows: DataFrame, n: int = 40) -> DataFrame:
    """SRT6: the first failures by key and field."""
    return rows.where(~F.col("ok")).orderBy("file", "field").limit(n)


def template_accuracy(rows: DataFrame) -> DataFrame:
    """AGG19: rows (expected, actual) of template names."""
    return rows.groupBy("expected").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("expected") == F.col("actual")).alias("ok"))
