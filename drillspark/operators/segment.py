"""Templates, unit systems and blocks of a page (JN12, AGG20, AGG21, SC50, FLT3-FLT7, FLT25, FLT27, WIN6-WIN8, AGG25, EX7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import dims
from ..dims import TEMPLATES, Template
from ..functions.text import strip_decor
from ..functions.times import remark_clock

MAX_TITLE, COVERAGE, CAP, MAX_HEADER = 40, 0.7, 5, 45


def weighted_score(text: Column, patterns, flags: str = "(?iU)") -> Column:
    """AGG20: each pattern counts up to five times."""
    parts = [F.lit(float(w)) * F.least(F.regexp_count(text, F.lit(flags + p)), F.lit(CAP)) for p, w in patterns]
    return sum(parts[1:], parts[0])


def hit_count(text: Column, patterns) -> Column:
    """AGG21."""
    parts = [text.rlike("(?iU)" + p).cast("int") for p in patterns]
    return sum(parts[1:], parts[0])


def document_text(lines: DataFrame) -> DataFrame:
    """SRC13: doc_id and its lines joined in order."""
    return lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line_no", "text"))), lambda x: x["text"]), "\n").alias("text"))


def unit_system(imperial: Column, metric: Column, hint: Column) -> Column:
    """SC50: by evidence with a margin of a fifth; without any the template's hint, else unknown. Never metric by default."""
    known = F.when(hint.isin("metric", "imperial"), hint)
    return F.when((imperial == 0) & (metric == 0), F.coalesce(known, F.lit("unknown"))).when(imperial > 1.2 * metric, "imperial").when(metric > 1.2 * imperial, "metric").otherwise(F.coalesce(known, F.lit("mixed")))


def detect(documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES, hint: Column | None = None) -> DataFrame:
    """JN12, FLT27, UD6: documents (doc_id, text) with template_id, label, confidence, unit_system, known.

    The template with most anchors, at least two; the first of equal ones. A ``hint`` that names a template overrides.
    """
    text = F.col("text")
    found = [F.struct(hit_count(text, t.anchors).alias("hits"), F.lit(-i).alias("_o"), F.lit(t.template_id).alias("id"), F.lit(t.label).alias("label"), F.lit(t.unit_hint).alias("unit_hint"), F.lit(len(t.anchors)).alias("of")) for i, t in enumerate(templates)]
    out = documents.withColumn("_best", F.array_max(F.array(*found))).withColumn("_known", F.col("_best.hits") >= 2)
    out = out.withColumn("_imp", weighted_score(text, dims.IMPERIAL)).withColumn("_met", weighted_score(text, dims.METRIC))
    detected = F.when(F.col("_known"), F.col("_best.id")).otherwise("unknown")
    forced = F.when(hint.isin([t.template_id for t in templates]), hint) if hint is not None else F.lit(None).cast("string")
    labels = F.create_map(*[F.lit(x) for t in templates for x in (t.template_id, t.label)])
    system = unit_system(F.col("_imp"), F.col("_met"), F.when(F.col("_known"), F.col("_best.unit_hint")))
    chosen = F.coalesce(forced, detected)
    return out.select(*documents.columns, chosen.alias("template_id"), F.try_element_at(labels, chosen).alias("label"), F.when(F.col("_known"), F.col("_best.hits") / F.col("_best.of")).otherwise(0.0).alias("confidence"), system.alias("unit_system"), (chosen != "unknown").alias("known"))


def title_block(line: Column) -> Column:
    """FLT3: the block whose title the line may be."""
    bare = F.trim(line)
    parts = [F.when(bare.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns)), block) for block, patterns in dims.BLOCK_ANCHORS.items()]
    return F.when((bare == "") | (F.length(bare) > MAX_TITLE), None).otherwise(F.coalesce(*parts))


def anchor_coverage(line: Column) -> Column:
    """FLT5: how much of the line is the best anchor and decoration."""
    bare = F.trim(line)
    best = [F.when(bare.rlike("(?iU)" + p), 1.0 - F.length(strip_decor(F.regexp_replace(bare, "(?iU)" + p + r"[a-z]{0,3}", " "))) / F.length(bare)) for patterns in dims.BLOCK_ANCHORS.values() for p in patterns]
    return F.when(bare == "", 0.0).otherwise(F.coalesce(F.greatest(*best), F.lit(0.0)))


def is_table_header(line: Column) -> Column:
    """FLT4, FLT7: two bars, a tab, or too little of the line is a title."""
    bare = F.trim(line)
    return (bare == "") | (F.length(bare) - F.length(F.replace(bare, F.lit("|"))) >= 2) | F.contains(bare, F.lit("\t")) | (anchor_coverage(line) < COVERAGE)


def blocks(lines: DataFrame) -> DataFrame:
    """WIN6, WIN7, FLT25: lines (doc_id, page, line_no, text) with their block, null before the first title; titles themselves are left out.

    Only the first title of a block opens it; later ones are content.
    """
    order = ["page", "line_no"]
    candidate = title_block(F.col("text"))
    # the coverage is worked out for lines that have an anchor only
    titled = lines.withColumn("_c", candidate).withColumn("_t", F.when(F.col("_c").isNotNull() & ~is_table_header(F.col("text")), F.col("_c")))
    first = F.row_number().over(W.partitionBy("doc_id", "_t").orderBy(*order)) == 1
    titled = titled.withColumn("_open", F.when(F.col("_t").isNotNull() & first, F.col("_t")))
    block = F.last("_open", ignorenulls=True).over(W.partitionBy("doc_id").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    out = titled.withColumn("block", F.coalesce(block, F.lit("header"))).where(F.col("_open").isNull())
    at = F.row_number().over(W.partitionBy("doc_id", "block").orderBy(*order))
    return out.withColumn("block_line", at).where((F.col("block") != "header") | (F.col("block_line") <= MAX_HEADER)).drop("_c", "_t", "_open")


def remarks(blocked: DataFrame) -> DataFrame:
    """WIN8, EX7, SC31: doc_id, seq, time_hint, text of the remark block."""
    lines = blocked.where((F.col("block") == "remarks") & (F.trim("text") != "")).withColumn("_r", remark_clock(F.col("text"))).where(F.col("_r.text") != "")
    seq = F.row_number().over(W.partitionBy("doc_id").orderBy("page", "line_no"))
    return lines.select("doc_id", seq.alias("seq"), F.col("_r.hint").alias("time_hint"), F.col("_r.text").alias("text"))


def block_text(blocked: DataFrame, block: str) -> DataFrame:
    """AGG25: doc_id and a block's lines joined by blanks; nothing becomes null."""
    rows = blocked.where(F.col("block") == block).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "line_no", "text"))).alias("_l"))
    return rows.select("doc_id", F.nullif(F.trim(F.array_join(F.transform("_l", lambda x: x["text"]), " ")), F.lit("")).alias(block))
