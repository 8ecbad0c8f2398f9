"""Quality rules: ratios of length, symbols, stop words and lines against a table of thresholds, in column expressions.

Words are runs of characters other than space and the control characters 9 to 13. A null text counts as empty: it has no
words and is rejected, and so is any text of fewer than 50 words. Null ids pass through, repeated rows are judged each for
itself, other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.functions.once import with_columns_once

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "was", "for", "with", "this", "are",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "dans", "est",
    "der", "die", "das", "und", "ist", "von", "mit", "den", "ein", "eine", "zu", "auf",
    "el", "los", "las", "del", "en", "y", "por", "con", "para", "es", "se", "no",
)


@dataclass(frozen=True)
class Rule:
    """``low * per <= scale * value <= high * per``, in whole numbers; a bound of None is open."""

    name: str
    value: str
    per: str
    low: int | None = None
    high: int | None = None
    scale: int = 100


#: The table: percentages of one count against another.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """One condition that holds when every rule holds."""
    holds = F.lit(True)
    for rule in rules:
        scaled, per = F.col(rule.value) * rule.scale, F.col(rule.per)
        if rule.low is not None:
            holds &= scaled >= per * rule.low
        if rule.high is not None:
            holds &= scaled <= per * rule.high
    return holds


def measure(docs: DataFrame, text: str = "text", *, prefix: str = "") -> DataFrame:
    """Adds the counts the rules compare. ``prefix`` avoids clashes with columns of ``docs``.

    Three-word windows are sorted as one number each, a hash whose low bits give way to the position, and neighbours of
    equal hash are compared word by word.
    """
    body_, w_, lines_, bits_, marks_, again_ = (f"{prefix}__{n}" for n in ("body", "w", "lines", "bits", "marks", "again"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = with_columns_once(
        docs,
        {
            body_: body,
            w_: F.array_remove(F.split(body, SPACES), ""),
            lines_: F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
        },
    )
    w, lines, bits, marks, again = F.col(w_), F.col(lines_), F.col(bits_), F.col(marks_), F.col(again_)
    df = with_columns_once(df, {bits_: F.length(F.bin(F.size(w)))})
    windows = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    mark = lambda i: F.call_function(
        "shiftleft", F.call_function("shiftright", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits), bits
    ).bitwiseOR(i.cast("long"))
    df = with_columns_once(df, {marks_: F.sort_array(F.transform(windows, mark))})

    def position(x: Column) -> Column:
        return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

    def same(x: Column, y: Column) -> Column:
        alike = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
        for step in range(3):
            alike &= F.get(w, position(x) + step) == F.get(w, position(y) + step)
        return F.coalesce(alike, F.lit(False))

    twice = lambda x, i: same(x, F.get(marks, i - 1)) | same(x, F.get(marks, i + 1))
    df = with_columns_once(df, {again_: F.sort_array(F.transform(F.filter(marks, twice), position))})
    reach = F.transform(again, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(again, i + 1) - x, F.lit(3))))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(body_) - F.length(F.regexp_replace(body_, f"[{SYMBOLS}]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.aggregate(reach, F.lit(0), lambda total, x: total + x),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS, *(word.capitalize() for word in STOP_WORDS)))),
    }
    df = with_columns_once(df, {prefix + name: value.cast("long") for name, value in counts.items()})
    return df.drop(body_, w_, lines_, bits_, marks_, again_)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``."""
    keyed = docs.select(F.col("doc_id"), F.col("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return measure(keyed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"), "n_lines", "n_stop_words",
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with all their columns and no others."""
    columns = [F.col(f"`{name}`") for name in docs.columns]
    packed = docs.select(F.struct(*columns).alias("row"), F.col("text"))
    measured = measure(packed)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return measured.filter(~failed & compile_rules(rules)).select("row.*")
