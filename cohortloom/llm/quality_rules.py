"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

A document's counts come from built-in array and string functions over its own row; the projection shuffles nothing, so
neither hot sources nor groups of copies matter. Repeated five-word windows are found by hashing each window to 64 bits
and sorting the hashes with their positions, and only in documents whose hashes are not all distinct.

Defined cases: a null text has no words, no lines with words and is not kept, like an empty one; null ids, languages and
sources are passed through; equal rows get equal results; an empty table gives an empty table; other columns, whatever
their names, are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.fence import fence
from cohortloom.llm.frames import WHITE, packed, unpacked

#: Frequent function words of English, French, German and Spanish prose.
STOP_WORDS = (
    ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "on", "was", "with", "as", "be", "this", "by"]
    + ["are", "at", "from", "not", "or", "have", "but"]
    + ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au", "par"]
    + ["pas", "sur", "avec", "ne", "ce", "il"]
    + ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "ist", "nicht", "im", "dem", "ein"]
    + ["als", "eine", "auch", "wie"]
    + ["el", "y", "los", "se", "del", "las", "con", "no", "una", "su", "para", "es", "al", "lo", "como", "más", "o"]
)
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Threshold:
    """``low <= numerator / denominator <= high`` for documents of at least ``words`` words."""

    name: str
    numerator: str
    denominator: str
    low: float = 0.0
    high: float = float("inf")
    words: int = 0


#: The verdict over documents that pass the base rules. Clean prose stays far inside; lists, shouting and noise do not.
THRESHOLDS = (
    Threshold("mean word length", "word_chars", "n_words", low=1.5, high=20.0),
    Threshold("symbols per word", "n_symbols", "n_words", high=0.2),
    Threshold("stop words per word", "n_stop_words", "n_words", low=0.02, words=50),
    Threshold("repeated lines", "n_dup_lines", "n_lines", high=0.5),
)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def verdict(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """The whole threshold table as one boolean expression over the counts."""

    def one(rule: Threshold) -> Column:
        ratio = F.col(rule.numerator) / F.greatest(F.col(rule.denominator), F.lit(1))
        held = ratio >= rule.low
        if rule.high != float("inf"):
            held &= ratio <= rule.high
        return held if not rule.words else (F.col("n_words") < rule.words) | held

    return reduce(lambda a, b: a & b, map(one, thresholds), F.lit(True))


def judged(
    docs: DataFrame, text: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS
) -> DataFrame:
    """``__row`` (the given row as a struct), the counts, ``base_failed`` and ``kept``."""
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(full, F.lit(WHITE)).alias("trimmed")
    split = packed(docs, text).select("__row", full.alias("full"), trimmed).select(
        "__row",
        "full",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("trimmed", r"[\x20\x09-\x0D]+"))
        .alias("words"),
        F.filter(F.split("full", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("lines"),
    )
    counted = split.select(
        "__row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("full", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda word: word.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("words")).alias("windows"),
    ).withColumn("n_repeat_words", _covered(F.col("windows")).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.drop("windows").withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(thresholds))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, their columns as given.

    The fence keeps the optimizer from rewriting the filter in terms of the text, with a copy of every count's expression
    for each mention of it.
    """
    return fence(judged(docs, text).select("__row", "kept")).where("kept").select(*unpacked(docs.columns))


def _windows(words: Column) -> Column:
    """A 64-bit hash of each window of five words."""

    def at(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get(words, i + k) for k in range(1, WINDOW)])

    return F.slice(F.transform(words, at), F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _covered(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(rows: Column) -> Column:
        def is_repeated(x: Column, k: Column) -> Column:
            same = [F.get(rows, k + step).getField("h").eqNullSafe(x.getField("h")) for step in (-1, 1)]
            return same[0] | same[1]

        return F.array_sort(F.transform(F.filter(rows, is_repeated), lambda x: x.getField("i")))

    def total(at: Column) -> Column:
        step = F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    # transform(array(x), f)[0] evaluates x once, however often f uses it.
    found = F.get(F.transform(F.array(placed), positions), F.lit(0))
    covered = F.get(F.transform(F.array(found), total), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)
