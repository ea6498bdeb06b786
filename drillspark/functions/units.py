"""Numbers and units (SC1-SC20, SC52). Factors are map literals, so conversion stays inside generated code."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import OFFSETS, UNITS

_PLACEHOLDER = r"^\s*(|-|—|/|N/A|n/a|NA|none)\s*$"
_NUMBER = r"[+-]?\d+(?:\.\d+)?"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which stands in the plan once however often ``use`` names it; else trees double with every step."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def norm_unit(unit: Column) -> Column:
    """SC1."""
    return F.translate(F.regexp_replace(F.lower(F.trim(unit)), "[· ]", ""), "³℃℉°", "3cf")


def quoted(text: str) -> str:
    """A text as a literal of Spark's SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(values: dict[str, float]) -> Column:
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {float(v)!r}D" for k, v in values.items()) + ")")


def _one_of(unit: Column, units) -> Column:
    """Whether a unit is among these; one pattern, for a plan with a literal a unit is slow to build."""
    return F.coalesce(unit.rlike("^(?:" + "|".join(map(re.escape, units)) + r")\z"), F.lit(False))


def convert(value: Column, unit: Column, kind: str) -> Column:
    """SC2-SC12, SC16: to the kind's target unit; no unit counts as that unit, an unknown one gives null."""
    unit = norm_unit(unit)
    out = value * F.try_element_at(_map(UNITS[kind]), unit)
    shifts = {u: s for (k, u), s in OFFSETS.items() if k == kind}
    if shifts:
        out = out + F.coalesce(F.try_element_at(_map(shifts), unit), F.lit(0.0))
    return F.when(unit.isNull() | (unit == ""), value).otherwise(out)


def parse_quantity(text: Column) -> Column:
    """SC13: struct(value, unit). Commas are thousands separators here; placeholders are null."""
    bare = F.regexp_replace(F.trim(text), "[,，]", "")
    full = f"^({_NUMBER})\\s*([A-Za-z\"%°℃℉\\u4e00-\\u9fff][^\\s]*)?$"
    matched = bare.rlike(full)
    value = F.expr("try_cast(null as double)")
    value = F.when(matched, F.regexp_extract(bare, full, 1)).otherwise(F.regexp_extract(bare, f"({_NUMBER})", 1)).try_cast("double")
    unit = F.when(matched, F.nullif(F.regexp_extract(bare, full, 2), F.lit("")))
    return F.when(~text.rlike(_PLACEHOLDER) & value.isNotNull(), F.struct(value.alias("value"), unit.alias("unit")))


def to_float(text: Column) -> Column:
    """SC14, SC52."""
    return parse_quantity(text)["value"]


def to_int(text: Column) -> Column:
    """SC14, SC52: rounded half to even."""
    return F.bround(to_float(text), 0).cast("int")


def to_float_safe(text: Column) -> Column:
    """SC18: the first number; here a comma is a decimal point."""
    return F.replace(F.nullif(F.regexp_extract(text, r"([+-]?\d+(?:[.,]\d+)?)", 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


_LABEL_UNITS = "m|米|ft|英尺|in|英寸|mm|毫米|km|kn|kN|千牛|kgf|lbf|klbf|kips|psi|kpa|mpa|bar|pa|g/cm3|g/cc|gcc|ppg|kg/m3|mpas|cp|pas|l/s|lps|gpm|l/min|m3/min|m3|m³|bbl|gal|l|升|方|c|℃|f|℉|s|min|h|hr|hrs|小时|分钟|天|%|m/h|ft/hr|m/hr|ft/h|ml|mg/l|度"


def label_unit(label: Column) -> Column:
    """SC15: the first unit in brackets, as in ``Depth (ft)``."""
    return F.nullif(F.regexp_extract(label, r"(?i)[（(\[]\s*(" + "|".join(re.escape(u) for u in _LABEL_UNITS.split("|")) + r")\s*[)）\]]", 1), F.lit(""))


def resolve_number(text: Column, kind: str, label: Column | None = None, template_unit: Column | None = None, override: Column | None = None) -> Column:
    """SC17: struct(si, raw, unit, unit_source, notes, ok).

    The unit of the value itself comes first, then the block's override, the label's unit and the template's default. Without
    any the raw number is kept, si is null and a note says so: units are never guessed.
    """
    nothing = F.lit(None).cast("string")
    given = [nothing if x is None else x for x in (label, template_unit, override)]
    known, every = list(UNITS[kind]), sorted({u for units in UNITS.values() for u in units})

    def choose(x: Column) -> Column:
        tried = ((x["q"]["unit"], "value"), (x["override"], "template-override"), (label_unit(x["label"]), "label"), (x["template_unit"], "template"))
        usable = F.filter(F.array(*[F.struct(u.alias("unit"), F.lit(s).alias("source")) for u, s in tried]), lambda t: _one_of(norm_unit(t["unit"]), known))
        blank = F.coalesce(x["text"].rlike(_PLACEHOLDER), F.lit(True))
        return F.struct(x["text"].alias("text"), x["template_unit"].alias("template_unit"), x["q"]["value"].alias("value"), x["q"]["unit"].alias("own"), F.try_element_at(usable, F.lit(1)).alias("use"), blank.alias("blank"))

    def resolve(x: Column) -> Column:
        own, value, use = x["own"], x["value"], x["use"]
        source, found = F.coalesce(use["source"], F.lit("unknown")), value.isNotNull()
        strange = ~_one_of(norm_unit(own), known) & _one_of(norm_unit(own), every)
        notes = F.array_compact(F.array(
            F.when(strange, F.concat(F.lit("the value's unit "), own, F.lit(f" is no unit of {kind}"))),
            F.when(source == "template", F.concat(F.lit("unit from the template: "), x["template_unit"])),
            F.when(~x["blank"] & value.isNull(), F.concat(F.lit("no number in "), x["text"])),
            F.when(found & (source == "unknown"), F.lit(f"no unit for {kind}: raw value kept")),
        ))
        return F.struct(
            F.when(found & use.isNotNull(), convert(value, use["unit"], kind)).alias("si"), value.alias("raw"), F.when(found, use["unit"]).alias("unit"), F.when(found, source).otherwise(F.lit("unknown")).alias("unit_source"),
            notes.alias("notes"), (x["blank"] | (found & (source != "unknown"))).alias("ok"),
        )

    read = F.struct(text.alias("text"), *[x.alias(n) for x, n in zip(given, ("label", "template_unit", "override"), strict=True)], parse_quantity(text).alias("q"))
    return let(let(read, choose), resolve)


def kept(result: Column) -> Column:
    """SC20: the converted value, or the raw one where no unit is known."""
    return F.coalesce(result["si"], result["raw"])


def rounded(value: Column, digits: int) -> Column:
    """SC19: half to even, as the figures of reports are rounded."""
    return F.bround(value, digits)


def approx(a: Column, b: Column, tolerance: float = 0.011) -> Column:
    """FLT18: both null, or both there and close."""
    return F.coalesce(a.eqNullSafe(b) | (F.abs(a - b) <= tolerance), F.lit(False))


def number_ok(expected: Column, actual: Column, tolerance: float = 0.01) -> Column:
    """FLT19: relative tolerance, null-safe."""
    near_zero = F.abs(expected) < 1e-9
    return F.when(expected.isNull() & actual.isNull(), True).when(expected.isNull() | actual.isNull(), False).when(near_zero, F.abs(actual) < 1e-6).otherwise(F.try_divide(F.abs(actual - expected), F.abs(expected)) <= tolerance)
