"""Scalar functions over text (FLT1, FLT6, FLT8, FLT11-14, SC35-SC47, SC51, SC55, SC56). ``(?U)`` makes \\s and \\b know CJK text."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Spark has no built-in one: a vectorised function, called where text is not plain."""
    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFKC", x) if x is not None else None)

    return F.when(text.rlike(r"^[\x00-\x7E]*$"), text).otherwise(fold(text))


def fold_wide(text: Column) -> Column:
    """Full-width ASCII and ideographic spaces made narrow, JVM-side: what NFKC does to the texts of reports."""
    return F.translate(text, _WIDE + "　 ", _NARROW + "  ")


def normalize_line(text: Column) -> Column:
    """FLT1."""
    return F.trim(F.regexp_replace(F.translate(text, " ", " "), "[ \t　]+", " "))


def normalize_label(text: Column) -> Column:
    """FLT14."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.translate(text, "　", " "), r"(?U)\s+", " "))), "[:：.]+$", "")


def norm_label(text: str) -> str:
    return re.sub("[:：.]+$", "", re.sub(r"\s+", " ", text.replace("　", " ")).strip().lower())


def token_pattern(token: str) -> str:
    """FLT12: a regular expression that finds ``token`` with word boundaries on its Latin sides only."""
    latin = "[0-9A-Za-z]"
    left = f"(?<!{latin})" if re.match(latin, token[0]) else ""
    right = f"(?!{latin})" if re.match(latin, token[-1]) else ""
    return f"{left}{re.escape(token)}{right}"


def label_matches(label: Column, candidates: list[str] | tuple[str, ...]) -> Column:
    """FLT11: equal, followed by a character that is no Latin one, or found as a token; ``label`` is normalised.

    A label that equals a name or starts with it holds it as a token, so tokens are all that is looked for.
    """
    return label.rlike("|".join(token_pattern(norm_label(c)) for c in candidates))


def is_code_suffix(value: Column) -> Column:
    """FLT13: a short code such as 19-3 that belongs to a name."""
    bare = F.trim(value)
    return (F.length(bare) <= 16) & bare.rlike(r"^[A-Za-z]*\d{1,4}(\s*[-–—/]\s*[A-Za-z]*\d{1,3})+[A-Za-z]*$")


def is_total_row(line: Column) -> Column:
    """FLT8."""
    bare = F.trim(line)
    rest = F.regexp_replace(bare, "(?i)(合计|总计|小计|total|sum)", "")
    rest = F.regexp_replace(rest, r"(?<![\w.])\d+(?:\.\d+)?(?![\w.])", "")
    rest = F.regexp_replace(rest, r"[\s　|:：,，.。;；\-—]*", "")
    return bare.rlike(r"(?iU)(合计|总计|小计|total|sum)\b") & (bare.rlike("(?i)(必须|must|constraint|等于)") | (F.length(rest) <= 6))


# What decorates a title.
_PAREN = r"[（(\[][^）)\]]{0,40}[）)\]]"
_DECOR = r"(?iU)(?:\d+|[一二三四五六七八九十]+|\b(?:hours?|hrs?|min|s|m|ft|in|mm|cm|psi|ppg|ml|ph|l/s|gpm|md|tvd|npt)\b|小时|次日|按时间顺序|续)"
_EDGE = r"[\s　|、,，：:()（）\[\]【】·.\-—/]+"


def _bare_once(text: Column) -> Column:
    for pattern, by in ((_PAREN, " "), (_DECOR, ""), (_EDGE, "")):
        text = F.regexp_replace(text, pattern, by)
    return text


def strip_decor(text: Column) -> Column:
    """FLT6: ordinals, brackets, units and separators taken off until nothing changes.

    A pass that changes anything shortens the text, so as many passes as the text has characters are enough; a text that is done
    is passed on as it is.
    """
    state = F.struct(text.alias("now"), F.lit(False).alias("done"))

    def step(acc: Column, _: Column) -> Column:
        new = _bare_once(acc["now"])
        return F.when(acc["done"], acc).otherwise(F.struct(new.alias("now"), (new == acc["now"]).alias("done")))

    return F.aggregate(F.sequence(F.lit(0), F.length(text)), state, step, lambda acc: acc["now"])


def clean(text: Column) -> Column:
    """SC40."""
    return F.nullif(F.btrim(F.regexp_replace(text, r"(?U)\s+", " "), F.lit(" 　:：")), F.lit(""))


def clean_org(text: Column) -> Column:
    """SC41."""
    return F.nullif(F.regexp_replace(clean(text), r"^(作业者|钻井承包商|承包商|operator|contractor)\s*[:：]?\s*", ""), F.lit(""))


def norm_text(value: Column) -> Column:
    """SC43."""
    return F.lower(F.regexp_replace(nfkc(F.coalesce(value.cast("string"), F.lit(""))), r"(?U)\s+", ""))


def norm_name(value: Column) -> Column:
    """SC44."""
    return F.lower(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"(?U)\s+", ""))


def text_equal(expected: Column, actual: Column, contains: bool = False) -> Column:
    """FLT20."""
    e, a = norm_text(expected), norm_text(actual)
    same = (e == a) | (F.contains(e, a) | F.contains(a, e) if contains else F.lit(False))
    return F.when((e == "") & (a == ""), True).when((e == "") | (a == ""), False).otherwise(same)


def split_slash(text: Column, part: int) -> Column:
    """SC42."""
    return F.nullif(F.trim(F.try_element_at(F.split(text, "/"), F.lit(part))), F.lit(""))


def dull_grade(text: Column) -> Column:
    """SC39: the eight parts of a wear grade, null for anything else."""
    dash = r"\s*[-–]\s*"
    pattern = r"^\s*" + dash.join([r"(\d)", r"(\d)", "([A-Za-z]{2})", "([A-Za-z]{1,2})", "([A-Za-z]{1,2})", "([A-Za-z]{1,2})", "([A-Za-z]{2,3})", "([A-Za-z]{2,4})"]) + r"\s*$"
    names = ("inner_wear", "outer_wear", "dull_char", "location", "bearing", "gauge", "other_char", "reason_pulled")
    parts = [F.regexp_extract(text, pattern, i + 1) for i in range(8)]
    return F.when(text.rlike(pattern), F.struct(*[(p.cast("int") if i < 2 else F.upper(p)).alias(n) for i, (p, n) in enumerate(zip(parts, names, strict=True))]))


def pairs(line: Column) -> Column:
    """SC37: ``k|v|k|v`` as a map; of equal keys the first value stays."""
    cells = F.transform(F.split(line, r"\|", -1), lambda c: F.trim(c))
    entries = F.transform(F.sequence(F.lit(0), F.greatest(F.size(cells) - 2, F.lit(0)), F.lit(2)), lambda i: F.struct(F.get(cells, i).alias("key"), F.get(cells, i + 1).alias("value")))
    full = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull() & (e["key"] != ""))
    first = F.filter(full, lambda e, i: ~F.array_contains(F.transform(F.slice(full, 1, i), lambda x: x["key"]), e["key"]))
    return F.map_from_entries(first)


def json_array(text: Column, schema: str) -> Column:
    """SC47: the array of objects in a model's answer: in a code fence, alone, under a known key, or a single object."""
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    body = F.trim(F.coalesce(fenced, text))
    outer = F.nullif(F.regexp_extract(body, r"(?s)(\[.*\])", 1), F.lit(""))
    keyed = F.coalesce(*[F.get_json_object(body, f"$.{k}") for k in ("events", "items", "data", "result")])
    whole = F.when(body.startswith("["), body).when(body.startswith("{"), F.coalesce(keyed, F.concat(F.lit("["), body, F.lit("]"))))
    return F.from_json(F.coalesce(whole, outer), schema, {"mode": "PERMISSIVE"})


def fixed(value: Column, digits: int = 2, dash: str = "—") -> Column:
    """SC51."""
    return F.when(value.isNull(), F.lit(dash)).otherwise(F.format_string(f"%.{digits}f", value.cast("double")))
