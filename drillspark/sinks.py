"""Writers (SNK1-SNK12). Rows go out distributed; texts for people are made from small results on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The columns of the time-log CSV.
CSV_COLUMNS = {"seq": "序号", "start": "开始", "end": "结束", "hours": "历时(h)", "operation": "作业内容", "code": "操作码", "category": "类别", "is_npt": "是否NPT", "npt_category": "NPT归因", "is_ilt_candidate": "ILT候选", "ilt_action": "ILT动作", "duration_source": "时长来源"}


def documents(reports: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """SNK1, SC48: one JSON text a report with its children as arrays in order; missing depth is 0.0 and missing names are '' here, as in the published schema."""
    out = reports.withColumns({"md_m": F.coalesce("md_m", F.lit(0.0)), "well_name": F.coalesce("well_name", F.lit("")), "dtim_start": F.coalesce("dtim_start", F.lit("")), "dtim_end": F.coalesce("dtim_end", F.lit(""))})
    names = []
    for name, child in children.items():
        order = [c for c in ("ord", "seq") if c in child.columns]
        fields = [c for c in child.columns if c != "report_id"]
        rows = child.groupBy("report_id").agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*[c for c in fields if c not in order]).alias("row")))).alias(name)) if not any(t.startswith("map") for _, t in child.dtypes) else child.groupBy("report_id").agg(F.collect_list(F.struct(*fields)).alias(name))
        out = out.join(rows, "report_id", "left").withColumn(name, F.coalesce(name, F.array()))
        names.append(name)
    head = [c for c in out.columns if c not in names and c != "report_id"]
    return out.select("report_id", "well_name", F.to_json(F.struct(F.struct(*head).alias("report"), *names), {"ignoreNullFields": "false"}).alias("document"))


def write_documents(docs: DataFrame, path: str) -> None:
    """SNK2, SNK3: documents as text, partitioned by well."""
    docs.select("well_name", F.col("document").alias("value")).write.partitionBy("well_name").text(path)


def csv_rows(log: DataFrame) -> DataFrame:
    """SNK4: the twelve columns under their names, yes and no as 是 and 否, nulls empty."""
    shown = log.withColumn("seq", F.col("ord"))
    yes = lambda c: F.when(F.col(c), "是").otherwise("否")
    cells = {c: yes(c) if c in ("is_npt", "is_ilt_candidate") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CSV_COLUMNS}
    return shown.select("report_id", *[v.alias(CSV_COLUMNS[c]) for c, v in cells.items()])


def write_csv(log: DataFrame, path: str) -> None:
    csv_rows(log).write.option("header", True).option("emptyValue", "").option("encoding", "UTF-8").csv(path)


def chart_model(category_hours: DataFrame, code_hours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SNK5, SNK6: the two series of the day's chart: categories in fixed order, codes by hours."""
    order = F.create_map(*[F.lit(x) for i, c in enumerate(("productive", "flat", "npt", "UNKNOWN")) for x in (c, i)])
    return category_hours.withColumn("ord", F.try_element_at(order, F.col("category"))).orderBy("report_id", "ord"), code_hours.orderBy("report_id", F.desc("hours"), "code")


def summary_text(reports: DataFrame, kpi: DataFrame, verified: DataFrame) -> DataFrame:
    """SNK7: (report_id, text)."""
    rows = reports.select("report_id", "well_name", "report_no", "md_m").join(kpi, "report_id").join(verified.select("report_id", "valid", "messages"), "report_id")
    share = lambda c: F.format_string("%s %.2f h (%.1f %%)", F.lit(c.removesuffix("_hours")), F.col(c), F.coalesce(F.try_divide(F.col(c), "sum_hours"), F.lit(0.0)) * 100)
    lines = F.concat_ws("\n", F.format_string("well %s, report %s, depth %s m", F.coalesce("well_name", F.lit("?")), F.coalesce(F.col("report_no").cast("string"), F.lit("?")), F.coalesce(F.format_number("md_m", 2), F.lit("—"))), F.format_string("%.2f h, %s", F.col("sum_hours"), F.when(F.col("valid"), "compliant").otherwise("not compliant")), share("productive_hours"), share("flat_hours"), share("npt_hours"), F.array_join("messages", "\n"))
    return rows.select("report_id", lines.alias("text"))


def markdown_rows(table: DataFrame) -> DataFrame:
    """SNK8-SNK10: every row of a result as a line of a markdown table, made where the row is."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("—")) for c in table.columns]
    return table.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def write_markdown(table: DataFrame, path: str) -> None:
    """SNK8-SNK10: all rows of a result of any size, as text files in ``path`` without their head."""
    markdown_rows(table).write.text(path)


def markdown(title: str, tables: dict[str, DataFrame]) -> str:
    """SNK8-SNK10: whole results as one markdown text, also when they are empty. The text comes to the driver: see ``write_markdown``."""
    parts = [f"# {title}"]
    for name, df in tables.items():
        parts += [f"\n## {name}\n", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        parts += [r["line"] for r in markdown_rows(df).toLocalIterator()] or ["| " + " | ".join("—" for _ in df.columns) + " |"]
    return "\n".join(parts) + "\n"


def batch_summary(summary: DataFrame, path: str) -> None:
    """SNK3: the batch's ``_summary.json`` in ``path``: a JSON line a report, written where the rows are."""
    summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{path}/_summary.json")


def stats_json(stats: DataFrame) -> DataFrame:
    """SNK11."""
    return stats.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
