"""The commands as one object (CLI1-CLI9, EX8): lazy DataFrames in, lazy DataFrames out; nothing is collected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..operators import chain, evaluate, events, header, privacy, reconcile, segment, stats, tables, timelog, validate


@dataclass(frozen=True)
class Parsed:
    """All tables of a batch of reports; ``log`` has gaps filled, ``raw_log`` is as reported."""

    reports: DataFrame
    raw_log: DataFrame
    log: DataFrame
    bits: DataFrame
    mud: DataFrame
    remarks: DataFrame
    events: DataFrame
    verified: DataFrame
    issues: DataFrame
    verdicts: DataFrame
    rejects: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in self.__dataclass_fields__}

    def register(self, prefix: str = "report_") -> None:
        """Make every table a view for SQL."""
        for k, v in self.tables().items():
            v.createOrReplaceTempView(prefix + k)


    def written(self, path: str, names: tuple[str, ...] = ("reports", "raw_log", "bits", "mud", "remarks", "events", "verified")) -> Parsed:
        """The same batch with these tables written to ``path`` and read back, so what follows plans over files and not over the parsing."""
        spark, tables_of = self.reports.sparkSession, self.tables()
        for name in names:
            tables_of[name].write.mode("overwrite").parquet(f"{path}/{name}")
        return replace(self, **{name: spark.read.schema(tables_of[name].schema).parquet(f"{path}/{name}") for name in names})


class Engine:
    def __init__(self, spark: SparkSession, operations: tuple[dims.Operation, ...] = dims.OPERATIONS, templates: tuple[dims.Template, ...] = dims.TEMPLATES):
        self.spark, self.operations, self.templates = spark, operations, templates

    def parse(self, lines: DataFrame, cells: DataFrame, template_hint: str | None = None, extractor: Callable[[DataFrame], DataFrame] | None = None) -> Parsed:
        """EX8, CLI1, CLI2: from lines and cells of any number of documents. Depths are carried along each well before rules look at them."""
        hint = F.lit(template_hint) if template_hint else None
        detected = segment.detect(segment.document_text(lines), self.templates, hint).drop("text")
        blocked = segment.blocks(lines)
        cells = tables.ruled(cells)
        raw = tables.time_log(cells, lines, self.operations)
        bits, mud = tables.bits(cells, detected, self.templates), tables.mud(cells, detected, self.templates)
        reports = header.assemble(header.header_values(cells, blocked, detected, self.templates), detected, self.templates)
        kpi = timelog.report_kpi(raw).select("report_id", "drill_hours")
        reports = reports.join(kpi, "report_id", "left").withColumn("etim_drill_h", F.coalesce("etim_drill_h", "drill_hours")).drop("drill_hours").withColumn("file_ord", F.col("report_id"))
        for block, name in (("summary", "sum_24hr"), ("plan", "plan_24hr")):
            text = segment.block_text(blocked, block).withColumnsRenamed({"doc_id": "report_id", block: name})
            reports = reports.join(text, "report_id", "left")
        reports = chain.carry_forward(reports)
        remarks = segment.remarks(blocked).withColumnRenamed("doc_id", "report_id")
        found = validate.numeric_issues(reports, raw, bits, mud)
        verified = timelog.verify(raw)
        return Parsed(reports, raw, timelog.fill_gap(raw), validate.backfill_bit_rate(bits), mud, remarks, events.extract_events(remarks, extractor), verified, found, validate.verdicts(verified, found), tables.rejected_rows(cells))

    def batch_summary(self, parsed: Parsed) -> DataFrame:
        """SNK3, CLI2: one row a report."""
        kpi = timelog.report_kpi(parsed.raw_log).select("report_id", "entries", "sum_hours", "npt_hours")
        return parsed.reports.select("report_id", "template_id", "well_name").join(kpi, "report_id", "left").join(parsed.verified.select("report_id", F.col("valid").alias("valid_24h")), "report_id", "left")

    def chart(self, parsed: Parsed) -> tuple[DataFrame, DataFrame]:
        """CLI3."""
        return timelog.category_hours(parsed.log), timelog.code_hours(parsed.log)

    def reconcile(self, days: DataFrame) -> DataFrame:
        """CLI4."""
        return reconcile.check_dataset(days)

    def evaluate(self, truth: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """CLI5: assertions and their accuracy."""
        rows = evaluate.evaluate(truth, parsed)
        return rows, evaluate.accuracy_sets(rows)

    def stats(self, items: DataFrame, truth: DataFrame) -> DataFrame:
        """CLI7."""
        return stats.dataset_stats(items, truth)

    def privacy(self, manifest: DataFrame, texts: DataFrame, baseline: DataFrame) -> DataFrame:
        """CLI8."""
        return privacy.scan(manifest, texts, privacy.allowlist(baseline))

    def info(self) -> tuple[DataFrame, DataFrame]:
        """CLI9: codes and templates."""
        rows = [(t.template_id, t.label, t.unit_hint, len(t.anchors)) for t in self.templates]
        return dims.dim_code(self.spark, self.operations), self.spark.createDataFrame(rows, "template_id string, label string, unit_hint string, anchors int")
