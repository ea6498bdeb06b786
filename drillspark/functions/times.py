"""Clocks, durations and dates (SC22-SC33, SC53). Clocks stay hours as doubles, for 24:00 is no time of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .units import let

_CLOCK = r"([01]?\d|2[0-4]):([0-5]\d)"
#: Date formats in order of trial, day before month.
DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "M/d/yyyy", "yyyy.M.d", "yyyy年M月d日", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "yyyyMMdd")
_UNIT = r"小时|分钟|天|hrs|hr|minutes|min|days|day|h(?![a-z/])"
_CONTEXT = "耗时|用时|历时|停钻|停工|停产|停顿|处理|堵漏|抢修|等待"


def _hours(text: Column, pattern: str) -> Column:
    h, m = F.regexp_extract(text, pattern, 1).try_cast("double"), F.regexp_extract(text, pattern, 2).try_cast("double")
    return F.when((h < 24) | (m == 0), h + m / 60)


def clock_to_hours(text: Column) -> Column:
    """SC22: the first clock in a text, to 4 digits."""
    return F.bround(_hours(text, rf"(?U)\b{_CLOCK}\b"), 4)


def clock_exact(text: Column) -> Column:
    """SC23: a text that is one clock."""
    return _hours(text, rf"^\s*{_CLOCK}\s*$")


def format_clock(text: Column) -> Column:
    """SC25: HH:MM, null without a clock."""
    return hours_to_clock(clock_to_hours(text))


def hours_to_clock(hours: Column) -> Column:
    """SC26."""
    minutes = F.bround(F.least(F.greatest(hours, F.lit(0.0)), F.lit(24.0)) * 60, 0).cast("int")
    return F.when(hours.isNotNull(), F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), minutes % 60))


def duration_to_hours(text: Column) -> Column:
    """SC24: ``45 min``, ``6.5 h``, ``1d2h30m``; here a comma is a decimal point."""
    bare = F.replace(F.trim(text), F.lit(","), F.lit("."))
    number = r"(\d+(?:\.\d+)?)"
    minutes = F.regexp_extract(bare, rf"(?i)^{number}\s*(?:min|分钟|minutes?)$", 1).try_cast("double") / 60
    plain = F.regexp_extract(bare, rf"(?i)^{number}\s*(?:h|hrs?|小时|hours?)?$", 1).try_cast("double")
    mixed = r"(?i)^(?:(\d+)\s*(?:d|天))?\s*(?:(\d+)\s*(?:h|小时|hr))?\s*(?:(\d+)\s*(?:min|分钟|m))?$"
    part = lambda i: F.coalesce(F.regexp_extract(bare, mixed, i).try_cast("double"), F.lit(0.0))
    whole = F.when((bare != "") & bare.rlike(mixed), part(1) * 24 + part(2) + part(3) / 60)
    return F.bround(F.coalesce(minutes, plain, whole), 4)


def time_cell(text: Column) -> Column:
    """SC53: struct(hours, source)."""
    hours = duration_to_hours(text)
    return F.struct(hours.alias("hours"), F.when(hours.isNotNull(), "reported").otherwise("unknown").alias("source"))


def span(start: Column, end: Column) -> Column:
    """SC27: from clock to clock; an end before the start is midnight."""
    return F.when(end >= start, end - start).otherwise(24 - start)


#: The shape that a text must have for a format to be tried; a miss of a parser is dear, a miss of an expression is not.
_SHAPES = {
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyy.M.d": r"^\d{4}\.\d{1,2}\.\d{1,2}$",
    "yyyy年M月d日": r"^\d{4}年\d{1,2}月\d{1,2}日$",
    "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3,4}-\d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3,4} \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3,4} \d{1,2}, \d{4}$",
    "yyyyMMdd": r"^\d{8}$",
}


def parse_date(text: Column) -> Column:
    """SC28."""
    bare = F.trim(text)
    shape = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
    found = F.try_to_date(F.concat_ws("-", *[F.regexp_extract(bare, shape, i) for i in (1, 2, 3)]), "yyyy-M-d")
    return F.coalesce(*[F.when(bare.rlike(_SHAPES[f]), F.try_to_date(bare, f)) for f in DATE_FORMATS], F.when(bare.rlike(shape), found))


def iso(day: Column, clock: Column, zone: Column) -> Column:
    """SC30."""
    return F.when(day.isNotNull(), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.coalesce(clock, F.lit("00:00")), F.lit(":00"), F.coalesce(zone, F.lit(""))))


def date_range(text: Column) -> Column:
    """SC29: struct(start, end) as ISO text; a single date is one day."""
    day = r"(\d{4}[-/.]\d{1,2}[-/.]\d{1,2})(?:\s+(\d{1,2}:\d{2}))?"
    both = rf"{day}\s*(?:[-–~至到]|to)\s*{day}"
    part = lambda i: F.nullif(F.regexp_extract(text, both, i), F.lit(""))
    zone = F.nullif(F.regexp_extract(text, r"([+-]\d{2}:?\d{2})\s*$", 1), F.lit(""))
    none, two = F.lit(None).cast("string"), text.rlike(both)
    # dates are parsed once each: from the first date of a pair, or the whole text, and from the second
    first, last = parse_date(F.when(two, part(1)).otherwise(text)), parse_date(F.when(two, part(3)))
    read = F.struct(two.alias("two"), first.alias("first"), last.alias("last"), *[F.when(two, c).otherwise(none).alias(n) for c, n in ((part(2), "begun"), (part(4), "ended"), (zone, "zone"))])
    final = lambda x: F.when(x["two"], x["last"]).otherwise(F.date_add(x["first"], 1))
    return let(read, lambda x: F.struct(iso(x["first"], x["begun"], x["zone"]).alias("start"), iso(final(x), x["ended"], x["zone"]).alias("end")))


def remark_clock(text: Column) -> Column:
    """SC31: struct(hint, text): a leading clock, and the text without it and without a second one."""
    lead = rf"^[\s　]*{_CLOCK}(?:[\s　]+(?:[01]?\d|2[0-4]):[0-5]\d)?[\s　]+"
    hint = F.when(text.rlike(lead), F.format_string("%02d:%02d", F.regexp_extract(text, lead, 1).try_cast("int"), F.regexp_extract(text, lead, 2).try_cast("int")))
    return F.struct(hint.alias("hint"), F.trim(F.regexp_replace(text, lead, "")).alias("text"))


def strip_clocks(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\b(?:[01]?\d|2[0-4]):[0-5]\d\b", " ")


def unit_hours(number: Column, unit: Column) -> Column:
    """SC33."""
    u = F.lower(unit)
    return F.when(u.isin("小时", "h", "hr", "hrs"), F.bround(number, 2)).when(u.isin("分钟", "min", "minutes"), F.bround(number / 60, 3)).when(u.isin("天", "day", "days"), F.bround(number * 24, 2))


def text_duration(text: Column) -> Column:
    """SC32: struct(hours, span) of the first duration in a text; clocks are no durations."""
    bare = strip_clocks(text)
    pattern = rf"(?i)((?:(?:{_CONTEXT})\s*)?(\d+(?:\.\d+)?)\s*({_UNIT}))"
    shown = F.regexp_extract(bare, rf"(?i)((\d+(?:\.\d+)?)\s*({_UNIT}))", 1)
    number, unit = F.regexp_extract(bare, pattern, 2).try_cast("double"), F.regexp_extract(bare, pattern, 3)
    return F.struct(unit_hours(number, unit).alias("hours"), F.nullif(shown, F.lit("")).alias("span"))
