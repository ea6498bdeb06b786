"""Events from remarks (EV1-EV4, JN18, JN19, SC32, SC47, SC56, UD1, UD2)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import json_array
from ..functions.times import strip_clocks, text_duration
from .classify import event_type, literal_map

ANSWER = "array<struct<seq:int,event_type:string,description:string,hours:double,evidence_span:string,npt_category:string,confidence:double>>"


def verified(text: Column, span: Column) -> Column:
    """EV2: the evidence ends with a unit of time and stands in the text outside its clocks."""
    unit = r"(?i)(小时|分钟|天|hrs|hr|min|minutes|days|day|h)$"
    bare = F.trim(span)
    return F.coalesce(bare.rlike(unit) & F.contains(strip_clocks(text), bare), F.lit(False))


def rule_events(remarks: DataFrame, word_boundary: bool = False) -> DataFrame:
    """EV1: remarks (report_id, seq, text) with event_type, hours, evidence_span, npt_category, verified, extraction_method."""
    found = remarks.withColumn("event_type", event_type(F.col("text"), word_boundary)).withColumn("_d", text_duration(F.col("text")))
    hours, span = F.col("_d.hours"), F.col("_d.span")
    ok = verified(F.col("text"), span)
    cause = F.when(hours.isNotNull() & (F.col("event_type") != "info"), F.try_element_at(literal_map(dims.CAUSE_OF_EVENT), F.col("event_type")))
    return found.select(*remarks.columns, "event_type", F.when(ok, hours).alias("hours"), F.when(ok, span).alias("evidence_span"), cause.alias("npt_category"), ok.alias("verified"), F.lit("rule").alias("extraction_method"), F.lit(None).cast("double").alias("confidence"))


def prompts(remarks: DataFrame) -> DataFrame:
    """SC56: one text a report, a line for each remark."""
    hint = F.col("time_hint") if "time_hint" in remarks.columns else F.lit(None).cast("string")
    line = F.concat_ws(" ", F.concat(F.lit("["), F.col("seq"), F.lit("]")), hint, F.col("text"))
    return remarks.groupBy("report_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("prompt"))


def model_events(remarks: DataFrame, call: Callable[[str], str], word_boundary: bool = False) -> DataFrame:
    """EV3, JN19, UD1: a model answers for all remarks of a report; numbers without evidence are dropped, and what is missing or
    not understood falls back to the rules, remark by remark. ``call`` runs on the executors, in batches."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            answers = []
            for prompt in part["prompt"]:
                try:
                    answers.append(call(prompt))
                except Exception:  # a model that fails costs its answer, not the job
                    answers.append(None)
            yield pd.DataFrame({"report_id": part["report_id"], "answer": answers})

    answers = prompts(remarks).mapInPandas(ask, "report_id string, answer string")
    items = answers.select("report_id", F.inline(F.coalesce(json_array(F.col("answer"), ANSWER), F.array().cast(ANSWER))))
    once = items.groupBy("report_id", "seq").agg(F.first(F.struct("event_type", "hours", "evidence_span", "npt_category", "confidence")).alias("_m"))
    base = rule_events(remarks, word_boundary)
    joined = base.join(once, ["report_id", "seq"], "left")
    told = F.col("_m.event_type").isNotNull()
    ok = verified(F.col("text"), F.col("_m.evidence_span"))
    pick = lambda model, rule: F.when(told, model).otherwise(rule)
    return joined.select(
        *remarks.columns, pick(F.col("_m.event_type"), F.col("event_type")).alias("event_type"),
        pick(F.when(ok, F.col("_m.hours")), F.col("hours")).alias("hours"), pick(F.when(ok, F.col("_m.evidence_span")), F.col("evidence_span")).alias("evidence_span"),
        pick(F.col("_m.npt_category"), F.col("npt_category")).alias("npt_category"), pick(ok, F.col("verified")).alias("verified"),
        F.when(told, "model").otherwise(F.col("extraction_method")).alias("extraction_method"), F.when(told, F.col("_m.confidence")).alias("confidence"),
    )


def extract_events(remarks: DataFrame, extractor: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """EV4, UD2: by the rules, unless another strategy is given."""
    return (extractor or rule_events)(remarks)


def event_totals(events: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """AGG27: per report events, hours, events without hours, events with hours but no evidence, and against ``truth``
    (report_id, seq, true_hours) those off by more than 0.02 h."""
    rows = events if truth is None else events.join(truth, ["report_id", "seq"], "left")
    off = F.abs(F.col("hours") - F.col("true_hours")) > 0.02 if truth is not None else F.lit(False)
    return rows.groupBy("report_id").agg(F.count(F.lit(1)).alias("events"), F.sum("hours").alias("hours"), F.count_if(F.col("hours").isNull()).alias("without_hours"), F.count_if(~F.col("verified") & F.col("hours").isNotNull()).alias("unverified"), F.count_if(off).alias("off"))
