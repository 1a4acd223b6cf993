"""Quality rules: a threshold table compiled into Spark projections, no user functions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was with as be by on are this at from or have an they which "
    "der die das und ist nicht ein eine den von mit zu auf für dem des sich auch "
    "le la les de du et un une est que qui dans en pour des pas sur au par "
    "el los las y que del se una por con no su para es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where 100 * numerator lies outside low .. high times denominator.

    It counts from least words up. The names are those of the measures below.
    """

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    least: int = 0


#: Length, symbol, stop-word and line ratios, in hundredths.
RULES = (
    Rule("words", "n_words", "one", low=2_000),
    Rule("repeated_words", "n_repeat_words", "n_words", high=30),
    Rule("word_length", "word_chars", "n_words", low=200, high=1_500),
    Rule("symbols", "n_symbols", "n_words", high=20),
    Rule("stop_words", "n_stop_words", "n_words", low=4, least=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=40),
)
#: The rules that make base_failed.
BASE = ("words", "repeated_words")


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _repeats(words: Column, width: int) -> Column:
    """Words within windows of width words that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes, and repeated
    ones are found by a sort; texts without repeats end after a distinct count.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))

    def starts(order: Column) -> Column:
        """Sorted start positions of the windows that have an equal neighbour in the order."""
        n = F.size(order)
        near = lambda x, i, j: F.when((j >= 0) & (j < n), F.get(order, j)["h"] == x["h"]).otherwise(False)
        return F.array_sort(F.transform(F.filter(order, lambda x, i: near(x, i, i - 1) | near(x, i, i + 1)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        n = F.size(at)
        return F.aggregate(F.transform(at, lambda p, i: F.when(i + 1 < n, F.least(F.lit(width), F.get(at, i + 1) - p)).otherwise(width)), F.lit(0), lambda a, x: a + x)

    def count(found: Column) -> Column:
        order = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(_let(order, lambda o: _let(starts(o), covered)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(_let(hashed, lambda h: _let(windows(h), count)))


def measures(text: Column) -> dict[str, Column]:
    """Columns of the ratios: all whole numbers, 0 for an empty or null text."""
    text = F.coalesce(text, F.lit(""))
    bare = F.translate(text, WHITE, "")
    words = F.filter(F.split(F.translate(text, WHITE, " " * len(WHITE)), " ", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, WHITE, "") != "")
    stop = list(dict.fromkeys(x for w in STOP_WORDS for x in (w, w.capitalize())))  # over ten literals: a hash set
    return {
        "__words": words,
        "__lines": lines,
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_words": F.size("__words").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(*stop))).cast("long"),
        "n_repeat_words": _repeats(F.col("__words"), 8).cast("long"),
        "one": F.lit(1).cast("long"),
    }


def fails(rule: Rule) -> Column:
    part, whole = 100 * F.col(rule.numerator), F.col(rule.denominator)
    out = F.lit(False)
    if rule.low is not None:
        out = out | (part < rule.low * whole)
    if rule.high is not None:
        out = out | (part > rule.high * whole)
    return out & (F.col("n_words") >= rule.least)


def judge_quality(df: DataFrame, rules: Iterable[Rule] = RULES, base: Iterable[str] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: the id, the measures, base_failed, failed (names of the rules), kept.

    A null text is empty and fails by its length. Repeated rows are judged each
    for itself; other columns of df are not read, whatever their names.
    """
    rules, base = tuple(rules), set(base)
    cols = measures(F.col("__text"))
    first = [k for k in ("__words", "__lines", "word_chars", "n_symbols", "one")]
    out = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = out.select(id_col, *(cols[k].alias(k) for k in first))
    out = out.select(id_col, "word_chars", "n_symbols", "one", *(cols[k].alias(k) for k in cols if k not in first))
    failed = F.array_compact(F.array(*(F.when(fails(r), F.lit(r.name)) for r in rules)))
    out = out.withColumn("failed", failed).withColumn("kept", F.size("failed") == 0)
    hit = [fails(r) for r in rules if r.name in base]
    return out.withColumn("base_failed", F.array_contains(F.array(*hit), True) if hit else F.lit(False)).drop("one")
