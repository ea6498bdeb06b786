"""Operator 1, line dedup by site-relative frequency.

Pages of a host that contain a line are divided by the host's pages; lines above a ratio are boilerplate and are dropped.
Counts are built-in aggregations with map-side partial sums; a host's boilerplate is one short array, whose length is bounded
by the lines of an average page divided by the ratio, however many pages the host has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, store, total_of


@dataclass(frozen=True)
class Boilerplate:
    ratio: float = 0.2  # of the host's pages
    pages: int = 5  # a line on fewer pages is never boilerplate


_BLANK = " \t\n\x0b\f\r"
#: Below this many bytes, counted before, the hosts' arrays are broadcast; above, hosts are joined with salted keys.
BROADCAST_BYTES, SALTS = 16_000_000, 64


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """A hash of a line without the blanks around it: of a type that Spark's array functions look up by hash."""
    return F.md5(F.btrim(line, F.lit(_BLANK)).cast("binary"))


def boilerplate_lines(docs: DataFrame, cfg: Boilerplate = Boilerplate()) -> DataFrame:
    """(host, lines, pages): hosts with boilerplate, the keys of its lines, and the host's pages; from ``docs`` (host, text)."""
    keys = F.transform(F.filter(_lines(F.coalesce("text", F.lit(""))), lambda x: F.btrim(x, F.lit(_BLANK)) != ""), _key)
    pages = docs.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = docs.select("host", F.explode(F.array_distinct(keys)).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cfg.pages)
    often = seen.join(pages, "host").where(F.col("n") > F.col("pages") * cfg.ratio)
    return often.groupBy("host").agg(F.collect_list("key").alias("lines"), F.first("pages").alias("pages"))


def url_host(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def line_dedup(docs: DataFrame, cfg: Boilerplate = Boilerplate(), host: str | Column = "source", counts: tuple[str, str] = ("_n_lines", "_n_dropped")) -> DataFrame:
    """``docs`` with boilerplate lines left out of ``text``, and two more columns named by ``counts``: lines, and lines dropped.

    ``host`` is a column or an expression such as ``url_host(F.col("url"))``. A column of ``docs`` that is named like one of
    ``counts`` gives way to it. Lines are cut at \\n and compared without white space around them; blank lines are never dropped. Rows without a host form
    one host. A null text stays null and counts as a page. Each row is a page, repeated rows too. Text without boilerplate is
    unchanged. If nothing is left, the text is empty. No documents give no rows.
    """
    others = [c for c in docs.columns if c != "text"]
    # the document's own columns travel in a struct, so none can clash with a name used here
    host = F.col(host) if isinstance(host, str) else host
    rows = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("doc"), F.col("text").alias("body"), F.coalesce(host, F.lit("")).alias("site"))
    found = store(boilerplate_lines(rows.select(F.col("site").alias("host"), F.col("body").alias("text")), cfg), "boilerplate")
    size = found.agg(F.coalesce(F.sum(F.size("lines") * 48 + 64), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(found.select("host", "lines")), F.col("site") == F.col("host"), "left")
    else:
        hot = F.col("pages") * HOT_SHARE >= F.lit(total_of(found, "pages"))
        salts = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
        rows = rows.join(F.broadcast(found.where(hot).select(F.col("host").alias("hot"))), F.col("site") == F.col("hot"), "left")
        rows = rows.withColumn("deal", F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("body"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
        joined = rows.join(found.select("host", "lines", salts), (F.col("site") == F.col("host")) & (F.col("deal") == F.col("salt")), "left")
    text = F.col("body")
    # only texts that hold a boilerplate line are taken apart
    here = F.array_intersect(F.transform(_lines(text), _key), F.col("lines"))
    marked = joined.withColumn("here", F.when(F.col("lines").isNull() | text.isNull(), F.lit(None)).otherwise(here))
    hit = F.coalesce(F.size("here") > 0, F.lit(False))
    out = marked.withColumn("kept", F.when(hit, F.filter(_lines(text), lambda line: ~F.array_contains(F.col("here"), _key(line)))))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(_lines(text)))
    clean = F.when(hit, F.array_join("kept", "\n")).otherwise(text)
    return out.select(*[clean.alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns if c not in counts], n_lines.cast("long").alias(counts[0]), F.when(hit, n_lines - F.size("kept")).otherwise(0).cast("long").alias(counts[1]))
