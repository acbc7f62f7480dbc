"""Quality rules: a threshold table compiled into one projection.

``measures`` turns a text into counts, ``RULES`` bounds ratios of these counts, and ``judged``
compiles measures, table and verdict into a chain of projections over one scan: no shuffle, no
user function.

Defined results: a null or empty text has no words, so it fails the base rule and every ratio
over its words is null, which no rule fails; repeated rows are judged one by one; an empty table
gives no rows; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.llm.native import let, spaced_words, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Frequent function words of the four languages of the corpus; fixed values.
STOP_WORDS = (
    "the and of to in is that for it with as on by this be was are an or "
    "der die das und ist von mit ein eine für auf den des sich nicht "
    "le la les de des et un une en que pour dans sur est du "
    "el los las y una por con del se no como lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``over`` / ``under`` lies outside [least, most]."""

    name: str
    over: str
    under: str
    least: float | None = None
    most: float | None = None

    def failed(self) -> Column:
        ratio = F.col(self.over) / F.nullif(F.col(self.under), F.lit(0))
        bounds = [ratio < self.least] if self.least is not None else []
        bounds += [ratio > self.most] if self.most is not None else []
        test = bounds[0]
        for bound in bounds[1:]:
            test = test | bound
        return F.when(test, F.lit(self.name))


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2, most=15),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules are about."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"\S"))
    stops = [form(word) for form in (str, str.capitalize) for word in STOP_WORDS]
    return (
        docs.select(F.col("doc_id"), whole_text().alias("text"))
        .select("doc_id", "text", spaced_words(text).alias("words"))
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, _line_counts).alias("lines"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            F.size(F.filter("words", lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
        )
        .select("*", "lines.*")
        .drop("lines")
    )


def _line_counts(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…")))
        .cast("long")
        .alias("n_ellipsis_lines"),
    )


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of eight words that occurs twice or more in the text.

    Windows are told apart by hashes. A repeated window repeats each of its half windows, which
    ends the work for texts without enough of those. Windows with a shared hash are at last
    compared word by word, so that a clash never counts.
    """
    window, half = WINDOW, WINDOW // 2

    def shortcut(halves: Column) -> Column:
        doubles = F.size(halves) - F.size(F.array_distinct(halves))
        return F.when((F.size(words) <= window) | (doubles <= half), F.lit(0)).otherwise(let(wider(halves), covered))

    def wider(halves: Column) -> Column:
        pairs = F.transform(halves, lambda h, i: F.xxhash64(h, F.get(halves, i + (window - half))))
        return F.slice(pairs, 1, F.greatest(F.size(words) - (window - 1), F.lit(0)))

    def covered(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(_doubled(F.transform(windows, lambda h, i: F.struct(h.alias("key"), i.alias("at")))), confirmed)
        )

    def confirmed(starts: Column) -> Column:
        spelled = F.transform(starts, lambda i: F.struct(F.array(*[F.get(words, i + k) for k in range(window)]).alias("key"), i.alias("at")))
        return let(F.sort_array(_doubled(spelled)), span)

    def span(starts: Column) -> Column:
        steps = F.transform(starts, lambda at, i: F.least(F.coalesce(F.get(starts, i + 1) - at, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    singles = F.transform(words, lambda w: F.xxhash64(w))
    pairs = let(singles, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))))
    halves = let(pairs, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 2))))
    return let(halves, shortcut).cast("long")


def _doubled(pairs: Column) -> Column:
    """Positions of the (key, at) pairs whose key another pair has too."""

    def of(ordered: Column) -> Column:
        shared = F.filter(
            ordered, lambda x, i: (x["key"] == F.get(ordered, i - 1)["key"]) | (x["key"] == F.get(ordered, i + 1)["key"])
        )
        return F.transform(shared, lambda x: x["at"])

    return let(F.sort_array(pairs), of)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures of each document, the rules it fails, and whether it is kept."""
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        measures(docs)
        .withColumn("base_failed", base_failed)
        .withColumn("failed_rules", F.array_compact(F.array(*[rule.failed() for rule in rules])))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
