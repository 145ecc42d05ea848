"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Defined cases: a null text has no words and every count 0; a text without words has ratio 0 everywhere and fails
the base rule; repeated rows are judged alike; other columns pass through, but one named as the new
column is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let


@dataclass(frozen=True)
class Rule:
    """A metric of ``METRICS`` must lie in [low, high]."""

    metric: str
    low: float | None = None
    high: float | None = None


#: Frequent function words of the languages served; a running text of some length has a few.
STOP_WORDS = (
    "the", "of", "and", "in", "to", "that", "is", "a", "was", "for", "it", "on", "as", "with", "by",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ein", "ist", "im", "des", "nicht",
    "le", "la", "les", "des", "et", "un", "une", "du", "que", "qui", "pour", "dans", "est",
    "el", "los", "las", "y", "en", "de", "se", "por", "con", "una", "para",
)

#: Metrics over the counts of ``with_counts``; every ratio of an empty text is 0.
METRICS = {
    "mean_word_length": lambda c: _ratio(c["word_chars"], c["n_words"]),
    "symbol_ratio": lambda c: _ratio(c["n_symbols"], c["n_words"]),
    "stop_word_ratio": lambda c: _ratio(c["n_stop_words"], c["n_words"]),
    "dup_line_ratio": lambda c: _ratio(c["n_dup_lines"], c["n_lines"]),
    "n_words": lambda c: c["n_words"],
}
RULES = (Rule("mean_word_length", 2.0, 14.0), Rule("symbol_ratio", None, 0.25), Rule("stop_word_ratio", 0.01, None), Rule("dup_line_ratio", None, 0.5))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(words: Column, size: int = 5) -> Column:
    """Words in windows of ``size`` words that the text has twice or more.

    Windows are hashed; only where two hashes agree are windows sorted, and neighbours compared word by word.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(starts, k + 1) - p, F.lit(size))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def same(w: Column, a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice(w, a["i"] + 1, size) == F.slice(w, b["i"] + 1, size))

    def repeated(w: Column, hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        marks = let(
            order,
            lambda o: F.transform(
                o, lambda x, k: F.when(F.coalesce((k > 0) & same(w, F.get(o, k - 1), x), F.lit(False)) | F.coalesce(same(w, x, F.get(o, k + 1)), F.lit(False)), x["i"])
            ),
        )
        return let(F.array_sort(F.array_compact(marks)), covered)

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(repeated(w, h)))
        return F.when(F.size(w) < size + 1, F.lit(0).cast("bigint")).otherwise(found)

    return count(words)


def _counts(text: Column) -> Column:
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def over(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.array_contains(stop, F.lower(w)))).cast("bigint").alias("n_stop_words"),
        )

    return let(_words(text), over)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def passes(c: Column, rules=RULES) -> Column:
    """The threshold table as one predicate."""
    out = F.lit(True)
    for r in rules:
        value = METRICS[r.metric](c)
        if r.low is not None:
            out = out & (value >= r.low)
        if r.high is not None:
            out = out & (value <= r.high)
    return out


def apply_rules(docs: DataFrame, text: str = "text", rules=RULES, into: str = "quality") -> DataFrame:
    """Add the struct ``into``: the counts, base_failed and kept."""
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row")
    judged = docs.select(row, _counts(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("counts"))
    c = F.col("counts")
    verdict = F.struct("counts.*", base_failed(c).alias("base_failed"), (~base_failed(c) & passes(c, rules)).alias("kept"))
    kept = [n for n in docs.columns if n.lower() != into.lower()]
    return judged.select(*[F.col("row")[n].alias(n) for n in kept], verdict.alias(into))
