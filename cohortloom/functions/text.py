"""Whitespace, blank and digit handling shared by the normalizers.

Java's ``\\s``, ``\\d`` and ``trim`` know fewer characters than the cells may hold (no-break spaces, separators,
full-width digits), so the character sets are spelled out once here, from the Unicode database.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# As a regex: Java's Unicode white space and the four separators that Python counts as well.
ANY_SPACE = r"(?U:[\s\x1c-\x1f])"
# A lone plain space is already what a run collapses to; leaving it unmatched makes long texts cheap.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f](?:[\s\x1c-\x1f]+|(?<! ))"

# Spellings of "no value", compared after strip and lower.
BLANK_TOKENS = (
    "",
    "-",
    "--",
    ".",
    "n/a",
    "na",
    "nan",
    "none",
    "null",
    "missing",
    "unknown",
    "unk",
    "not reported",
    "not available",
    "not applicable",
    "no data",
)
_LONGEST_BLANK = max(map(len, BLANK_TOKENS))


@cache
def _foreign_digits() -> tuple[str, str]:
    digits = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(text: Column, words: Iterable[str]) -> Column:
    """Whether the text is one of a few words. Spelled as one SQL array: a Python literal per word is slow to build."""
    return F.array_contains(F.expr(f"array({', '.join(map(_literal, words))})"), text)


def lookup(text: Column, codes: Mapping[str, str | int]) -> Column:
    """The code of a word, NULL for other text."""
    pairs = (f"{_literal(word)}, {_literal(code) if isinstance(code, str) else code}" for word, code in codes.items())
    return F.expr(f"map({', '.join(pairs)})")[text]


def cell(value: Column) -> Column:
    """Any column as the text of its cells."""
    return value.cast("string")


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(SPACES))


def single_spaced(value: Column) -> Column:
    """Every whitespace run becomes one plain space; linear in the text, also on very long runs."""
    return F.regexp_replace(value, _SPACE_RUN, " ")


def ascii_digits(value: Column) -> Column:
    """Decimal digits of any script as 0-9. ASCII cells, the usual case, pass through untouched."""
    foreign, plain = _foreign_digits()
    return F.when(F.octet_length(value) == F.char_length(value), value).otherwise(F.translate(value, foreign, plain))


def is_blank(value: Column) -> Column:
    """True for NULL and for the spellings of "no value"; never NULL."""
    text = strip(cell(value))
    # The length test keeps long texts from being lower-cased only to miss a 14-character list.
    hit = (F.char_length(text) <= _LONGEST_BLANK) & one_of(F.lower(text), BLANK_TOKENS)
    return F.coalesce(hit, F.lit(True))


def is_blank_spaced(value: Column, spaced: Column) -> Column:
    """:func:`is_blank` where the trimmed, single-spaced text is at hand; NULL for NULL.

    Spacing may only have turned into a blank spelling what was none (``not  reported``); then the cell does not hold
    that spelling.
    """
    token = F.lower(spaced)
    return (F.char_length(spaced) <= _LONGEST_BLANK) & one_of(token, BLANK_TOKENS) & F.contains(F.lower(value), token)


def normalize_text(value: Column) -> Column:
    """Free text, trimmed and single-spaced; NULL when blank."""
    spaced = F.trim(single_spaced(cell(value)))
    return F.when(~is_blank_spaced(cell(value), spaced), spaced)
