"""Classification of time entries (JN1-JN6, JN25, EX4, FLT15-FLT17, SC45)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..dims import OPERATIONS, Operation
from ..functions.text import fold_wide
from ..functions.units import let, quoted


def literal_map(values: dict) -> Column:
    """A map literal; one expression, for a call a key makes large plans slow to build."""
    said = lambda x: "null" if x is None else quoted(x) if isinstance(x, str) else f"{x!r}D" if isinstance(x, float) else repr(x)
    return F.expr("map(" + ", ".join(said(x) for pair in values.items() for x in pair) + ")")


def _keywords(pairs: list[tuple[str, str]]) -> Column:
    """(keyword, value) pairs as an array literal, longest first and else in their order (SRT5)."""
    ordered = sorted(((k.lower(), v) for k, v in pairs), key=lambda p: -len(p[0]))
    return F.expr("array(" + ", ".join(f"named_struct('key', {quoted(k)}, 'code', {quoted(v)})" for k, v in ordered) + ")")


def longest_keyword(text: Column, pairs: list[tuple[str, str]], negation: str | None = None, word_boundary: bool = False) -> Column:
    """JN2, JN5, JN6: the value of the longest keyword in ``text``; the first of equally long ones. Row-local, no join.

    With ``negation`` hits behind that pattern do not count; with ``word_boundary`` Latin keywords have to be whole words. The text
    is bound, for a lambda works out what it names anew for each keyword.
    """

    def first(text: Column) -> Column:
        def hit(p: Column) -> Column:
            found = F.contains(text, p["key"])
            if negation:
                found = found & ~F.substring(text, F.lit(1), F.position(p["key"], text) - 1).rlike(negation)
            if word_boundary:
                latin = p["key"].rlike("^[a-z ]+$")
                found = found & (~latin | F.rlike(text, F.concat(F.lit("(?<![a-z])"), p["key"], F.lit("(?![a-z])"))))
            return found

        return F.try_element_at(F.filter(_keywords(pairs), hit), F.lit(1))["code"]

    return let(text, first)


def exact_code(text: Column, operations: tuple[Operation, ...] = OPERATIONS) -> Column:
    """JN1: code, label or alias equal to ``text``; of double keys the last counts."""
    known = {}
    for o in operations:
        known |= {k.lower(): o.code for k in (o.code, o.label_zh, o.label_en, *o.aliases) if k}
    return F.try_element_at(literal_map(known), text)


def normalize_code(text: Column, operations: tuple[Operation, ...] = OPERATIONS, word_boundary: bool = False) -> Column:
    """JN3: the operation code of a text, by seven tiers: empty, waiting, severe events, activity numbers, exact, longest alias, bracketed.

    Runs of blanks are one, and marks around the text do not count. Texts that hold no alias at all skip the search for one.
    """
    aliases = [(a, o.code) for o in operations for a in o.aliases]
    held = "|".join(sorted({re.escape(a.lower()) for a, _ in aliases}))

    def tiers(norm: Column) -> Column:
        severe = [F.when(norm.rlike("(?U)" + p) & ~F.regexp_extract(norm, f"(?sU)^(.*?)(?:{p})", 1).rlike(dims.NEGATED), code) for p, code in dims.SEVERE]
        number = F.when(norm.rlike(r"^\d{1,2}$"), F.try_element_at(literal_map(dims.ACTIVITY_CODES), norm.try_cast("int")))
        inner = F.transform(F.regexp_extract_all(norm, F.lit(r"[（(]([^）)]+)[）)]"), F.lit(1)), lambda c: exact_code(F.trim(c), operations))
        return F.coalesce(
            F.when(F.coalesce(norm, F.lit("")) == "", "UNKNOWN"),
            F.when(F.greatest(*[norm.startswith(p) for p in dims.WAIT_PREFIXES]), "WAIT"),
            *severe,
            number,
            exact_code(norm, operations),
            F.when(norm.rlike(held), longest_keyword(norm, aliases, dims.NEGATED, word_boundary)),
            F.try_element_at(F.array_compact(inner), F.lit(1)),
            F.lit("UNKNOWN"),
        )

    return let(F.btrim(F.trim(F.regexp_replace(F.lower(fold_wide(text)), r"(?U)\s+", " ")), F.lit(" .;:、，。")), tiers)


def category_of(code: Column, operations: tuple[Operation, ...] = OPERATIONS) -> Column:
    """JN25: an unknown code is flat."""
    return F.coalesce(F.try_element_at(literal_map({o.code: o.category for o in operations}), code), F.lit("flat"))


def ilt_action(text: Column) -> Column:
    """JN5, FLT15: a connection by its wording, else the longest keyword, without word boundaries."""
    norm = F.lower(fold_wide(text))
    return F.when(text.rlike("(?U)" + dims.CONNECTION_TEXT), "connection").otherwise(longest_keyword(norm, [(k, a) for a, words in dims.ILT_KEYWORDS.items() for k in words]))


def event_type(text: Column, word_boundary: bool = False) -> Column:
    """JN6."""
    pairs = [(k, e) for e, words in dims.EVENT_KEYWORDS.items() for k in words]
    return F.coalesce(longest_keyword(F.lower(text), pairs, word_boundary=word_boundary), F.lit("info"))


def is_connection(operation: Column) -> Column:
    """FLT16: as data checks see it, by plain words."""
    return F.greatest(*[F.contains(operation, F.lit(w)) for w in ("接单根", "接立柱", "接钻杆", "connection")])


def is_npt(category: Column, npt_category: Column) -> Column:
    """FLT17."""
    return F.coalesce((npt_category.isNotNull() & (npt_category != "")) | (category == "npt"), F.lit(False))


def classify(entries: DataFrame, operations: tuple[Operation, ...] = OPERATIONS, word_boundary: bool = False) -> DataFrame:
    """EX4: entries (operation, category_hint, optionally code_hint) with code, category, is_npt, npt_category, npt_responsibility, is_ilt_candidate, ilt_action.

    The report's own category column comes first, then the code's. The cause comes from the code alone, and only for npt.
    """
    known = F.array(*[F.lit(o.code) for o in operations])
    hinted = F.when(F.array_contains(known, F.col("code_hint")), F.col("code_hint")) if "code_hint" in entries.columns else F.lit(None)
    hint = F.col("category_hint") if "category_hint" in entries.columns else F.lit(None).cast("string")
    own = F.coalesce(*[F.when(hint.rlike(p), c) for p, c in dims.CATEGORY_TEXT])
    causes = {o.code: o.npt_category for o in operations if o.npt_category}
    candidates = [o.code for o in operations if o.ilt_action]
    out = entries.withColumn("code", F.coalesce(hinted, normalize_code(F.col("operation"), operations, word_boundary)))
    out = out.withColumn("category", F.coalesce(own, category_of(F.col("code"), operations)))
    return (
        out.withColumn("is_npt", F.col("category") == "npt")
        .withColumn("npt_category", F.when(F.col("category") == "npt", F.try_element_at(literal_map(causes), F.col("code"))))
        .withColumn("npt_responsibility", F.lit(None).cast("string"))
        .withColumn("ilt_action", ilt_action(F.col("operation")))
        .withColumn("is_ilt_candidate", F.col("ilt_action").isNotNull() | F.col("code").isin(candidates))
    )
