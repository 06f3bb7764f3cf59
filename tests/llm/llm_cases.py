"""Documents that hold every awkward case, for the tests of all operators."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the of and word " * 3 + " ".join(f"w{k % 977}" for k in range(30_000))
PASSAGE = "A passage of some length that more than one document holds, word for word."
TEXTS = [
    (1, f"first line here\n{PASSAGE}\nlast line of one"),
    (2, f"  {PASSAGE.upper()}\t\nits own line\n\n"),
    (3, f"{PASSAGE}\n{PASSAGE}"),
    (4, None),
    (5, ""),
    (6, " \n\t \x0b\x0c\r\n "),
    (7, LONG),
    (8, LONG + " end"),
    (9, "naïve café 漢字 \U0001f600‍\U0001f468 ﬀ İ ſ  \u0085 x\x1cy"),
    (10, "short"),
    (None, "a text without id, but with the words that a text of its kind has"),
    (None, PASSAGE),
    (12, "one two three four five " * 8),
    (12, "one two three four five " * 8),
    (13, "### a\n</turn>\n\\### b <|endoftext|>  two   spaces \n\n\n"),
    (14, "### a\n</turn>\n\\### b <|endoftext|>  two   spaces \n\n\n"),
]


def rows() -> list[tuple]:
    sources = ["web", None, "books", "", "Web"]
    return [(i, t, None if k % 4 == 0 else "en", sources[k % 5], None) for k, (i, t) in enumerate(TEXTS)]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def with_clashes(spark):
    """The same, beside columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["kept", "n_words", "size", "key", "rank", "copies", "fingerprint", "component_id", "ids", "raw", "shard"]
    names += ["doc", "content", "high", "lost", "score", "a.b", "cell", "class", "u", "words", "lines", "base_failed"]
    return docs(spark).select("*", *[F.lit("x").alias(name) for name in names])


def alike(frame):
    """The same, each column between two others whose names differ from its own in case only."""
    from pyspark.sql import functions as F

    doubled = [(x, c) for x in frame.columns for c in (F.lit(7).alias(x.title()), F.col(x), F.lit("no").alias(x.upper()))]
    return frame.select(*[c for _, c in doubled])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
