"""Operator 2, quality rules: a threshold table compiled into one Spark projection. No user functions, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Frequent function words of the corpus's languages.
STOP_WORDS = (
    "the of and to in is that for it as with was on be at by this are or from have an they which not "
    "le la les de des du et en un une que qui dans pour sur au aux est par avec pas "
    "der die das und in den von zu mit sich auf für ist im nicht ein eine dem des es "
    "el los las y en que del se por con para al lo una su es no"
).split()
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Threshold:
    """A row of the table: the metric has to lie in [least, most]."""

    metric: str
    least: float
    most: float


#: Fixed values. Ratios are of words, except line ratios, which are of lines with a word.
THRESHOLDS = (
    Threshold("n_words", 50, 1_000_000),
    Threshold("mean_word_length", 2.0, 12.0),
    Threshold("symbol_ratio", 0.0, 0.20),
    Threshold("stop_word_ratio", 0.02, 1.0),
    Threshold("dup_line_ratio", 0.0, 0.30),
    Threshold("shouting_ratio", 0.0, 0.50),
    Threshold("repeat_word_ratio", 0.0, 0.50),
)


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it any number of times inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Windows are compared by a 64-bit hash within one text."""
    nothing = F.array().cast("array<int>")

    def hashed(w: Column) -> Column:
        k = F.size(w) - 2
        two = F.zip_with(F.slice(w, 1, k), F.slice(w, 2, k), lambda a, b: F.xxhash64(a, b))
        return _let(F.zip_with(two, F.slice(w, 3, k), lambda h, c: F.xxhash64(h, c)), counted)

    def counted(h: Column) -> Column:
        # only texts with a repeated window are sorted
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(placed, covered))

    def covered(s: Column) -> Column:
        # windows sorted by hash: equal neighbours give their places
        both = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], x["i"] + 1, x["i"] + 2, y["i"], y["i"] + 1, y["i"] + 2)).otherwise(nothing))
        return F.size(F.array_distinct(F.flatten(both)))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, hashed))


def metrics(text: Column) -> dict[str, Column]:
    """The base metrics of a text without nulls."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    return {"_words": words, "_lines": F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")}


def quality(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """Metrics and verdict for every document of ``docs`` (doc_id, text).

    A null or empty text has no words and fails. Words are runs of other characters than ASCII white space. Repeated rows give
    repeated results; an empty table gives none. ``failed`` names the rules that the document breaks.
    """
    clean = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", clean.alias("_text"), *[v.alias(k) for k, v in metrics(clean).items()])
    words, n_words, lines = F.col("_words"), F.col("n_words"), F.size("_lines")
    stops = list(dict.fromkeys([*stop_words, *(w.capitalize() for w in stop_words)]))
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(words).cast("long").alias("n_repeat_words"),
        lines.cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
        F.regexp_count("_text", F.lit("!!")).cast("long").alias("n_shouts"),
    )
    base_failed = (n_words < 50) | (100 * F.col("n_repeat_words") > 50 * n_words)
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    values = {
        "n_words": n_words.cast("double"),
        "mean_word_length": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "shouting_ratio": ratio("n_shouts", "n_words"),
        "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
    }
    broken = F.filter(F.array(*[F.when(~values[t.metric].between(t.least, t.most), F.lit(t.metric)) for t in thresholds]), lambda x: x.isNotNull())
    judged = counted.withColumn("base_failed", base_failed).withColumn("failed", broken)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
