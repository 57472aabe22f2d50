"""Quality rules: a threshold table compiled into one Spark projection.

The counts come from array functions over the words and lines of each text, the rules from a table
of (name, measure, least, most). A rule is a comparison of two columns, so the verdict is one
projection after the counts, without user functions and without any shuffle.

Repeated words: every window of eight words gets a hash of its word hashes (64 bits). Windows are
only sorted where a text has equal hashes; equal neighbours in the sorted list mark repeated places.

Rows and edge cases: null, empty and blank text has no words and fails the base rules. Ratios with
an empty denominator are 0. Repeated rows are judged alike, ids don't matter. All columns of the
input are kept; the added ones are prefixed where ``prefix`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANKS = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8

#: Common function words of the languages in the corpus.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "by", "for", "from", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    "aux", "avec", "dans", "de", "des", "du", "est", "et", "la", "le", "les", "par", "pour", "que",
    "qui", "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "im", "ist", "mit", "nicht", "sich",
    "und", "von", "zu",
    "con", "del", "el", "en", "es", "las", "los", "no", "para", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """``least <= measure <= most``; an open end is None. ``from_words`` spares shorter texts."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0

    def passed(self) -> Column:
        value = F.col(self.measure)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (value >= self.least)
        if self.most is not None:
            ok = ok & (value <= self.most)
        return ok | (F.col("n_words") < self.from_words) if self.from_words else ok


RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.02, from_words=50),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("repeated_words", "repeat_ratio", most=0.3),
    Rule("bullet_lines", "bullet_ratio", most=0.9),
    Rule("ellipsis_lines", "ellipsis_ratio", most=0.3),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars",
    "symbol_ratio", "stop_ratio", "dup_line_ratio", "repeat_ratio", "bullet_ratio", "ellipsis_ratio",
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(column: str, test) -> Column:
    return F.size(F.filter(column, test)).cast("long")


def _repeat_words() -> Column:
    """Words inside windows whose hash occurs more than once in the text."""
    order = F.col("_order")
    hash_at = lambda i: F.get(order, i)["h"]
    repeated = F.filter(
        order,
        lambda x, i: (x["h"] == hash_at(i - 1)) | (x["h"] == hash_at(i + 1)),
    )
    starts = F.array_sort(F.transform(repeated, lambda x: x["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    ).cast("long")


def measure(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """The input with the columns of ``MEASURES``."""
    names = [n for n in documents.columns if n not in MEASURES]
    kept = [F.col(f"`{n}`") for n in names]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    words = documents.select(
        *kept,
        F.filter(F.split(text, _BLANKS), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    hashed = words.select(
        *kept,
        "_lines",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        _count("_words", lambda w: F.lower(w).isin(*STOP_WORDS)).alias("_stops"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    windows = hashed.withColumn(
        "_windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_hashes") - WINDOW + 1),
                lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("_hashes")
    ordered = windows.withColumn(
        "_order",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.array_sort(
                F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    ).drop("_windows")
    n, lines = F.col("n_words"), F.size("_lines")
    dup_lines = (lines - F.size(F.array_distinct("_lines"))).cast("long")
    counted = ordered.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        dup_lines.alias("n_dup_lines"),
        F.when(F.col("_order").isNull(), F.lit(0).cast("long")).otherwise(_repeat_words()).alias("n_repeat_words"),
        _ratio(F.col("_stops"), n).alias("stop_ratio"),
        _ratio(_count("_lines", lambda x: F.ltrim(x).rlike("^[-*•]")), lines).alias("bullet_ratio"),
        _ratio(_count("_lines", lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)$")), lines).alias("ellipsis_ratio"),
        _ratio(dup_lines, lines).alias("dup_line_ratio"),
    )
    return counted.select(
        "*",
        _ratio(F.col("word_chars"), n).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("word_chars")).alias("symbol_ratio"),
        _ratio(F.col("n_repeat_words"), n).alias("repeat_ratio"),
    )


def judge(
    documents: DataFrame,
    text_column: str = "text",
    rules: Sequence[Rule] = RULES,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """The input with measures, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    measured = measure(documents, text_column)
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    failed = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]))
    judged = measured.withColumn("base_failed", base).withColumn("failed_rules", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
