"""Fill-in-middle: documents cut into prefix, middle and suffix, rearranged around sentinels, and put back together.

A text is a row of units, words of ASCII letters or single other characters. Each batch is one pipeline of pyarrow
kernels: units as lists, flattened with the row each came from, numbered within it, filtered by the part they belong to,
gathered to lists again and joined to strings. Where a document is cut, and whether it is rearranged at all, follows from a
digest of its id, so reruns and lost tasks agree. Nothing is shuffled; a row goes its way alone, so hot sources and groups
of copies make no difference.

Defined cases: a null text is an empty one and stays plain; so does a text that holds a sentinel, as it could not be told
apart when read back. A null id counts as an empty one. Rows with the same id are cut by the same numbers, equal rows get
equal results. Very long texts are worked on one by one, at about 60 times their bytes in memory. An empty table gives an
empty table. Other columns pass through, also where names differ only in case; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.frames import mapped, pieces

#: The sentinels and the pattern of a unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred documents, so many are rearranged; of a hundred of those, so many put the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Bytes of text in one run of the pipeline.
SLICE = 1 << 20

_MADE = {
    "n": T.LongType(),
    "form": T.StringType(),
    "prefix_chars": T.LongType(),
    "middle_chars": T.LongType(),
    "output": T.StringType(),
}


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: str = "1",
    rearranged: int = REARRANGED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """All columns but the text, which gives way to ``output``, its ``form``, and where it was cut.

    ``n`` counts the text's units. ``prefix_chars`` and ``middle_chars`` are code points, null in a plain text.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SLICE):
            draws = [part.column(f"h{k}").to_numpy() for k in range(1, 5)]
            made = rearrange(part.column("text"), draws, rearranged, suffix_first)
            yield pa.RecordBatch.from_arrays([part.column("__row"), *made], names=["__row", *_MADE])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    full = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return mapped(docs, {"key": key, "text": text}, [full, *draws], step, _MADE, used_up=(text,))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A sentinel has no border, so its first place is where it was put."""
    second = F.when(form == PSM, SUFFIX).otherwise(PREFIX)
    head = F.split_part(F.substring(output, 1 + len(PREFIX), F.length(output)), second, F.lit(1))
    rest = F.substring(output, 1 + len(PREFIX) + F.length(head) + len(PREFIX), F.length(output))
    tail = F.split_part(rest, F.lit(MIDDLE), F.lit(1))
    middle = F.substring(rest, 1 + F.length(tail) + len(MIDDLE), F.length(rest))
    moved = F.when(form == PSM, F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
    return F.when(form == PLAIN, output).otherwise(moved)


def units(texts: pa.Array) -> pa.Array:
    """A list of units for each text, and an empty string at its end."""
    mark = _absent(texts)
    marked = pc.replace_substring_regex(texts, pattern=f"({UNIT})", replacement=rf"\1{mark}")
    return pc.split_pattern(marked, mark)


def rearrange(texts: pa.Array, draws: list[np.ndarray], rearranged: int, suffix_first: int) -> list[pa.Array]:
    """The columns of ``_MADE`` for texts without nulls and four random numbers for each."""
    texts = texts.cast(pa.large_string())
    lists = units(texts)
    n = pc.subtract(pc.list_value_length(lists), 1).cast(pa.int64()).to_numpy()
    ends = [draw % (n + 1) for draw in draws[:2]]
    first, second = pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))

    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = pa.array(np.cumsum(n + 1) - (n + 1))
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), starts.take(parents))
    past = [pc.greater_equal(ordinals, edge.take(parents)).cast(pa.int8()) for edge in (first, second)]
    role = pc.add(*past)
    prefix, middle, suffix = (_part(flat, parents, pc.equal(role, k), len(texts)) for k in range(3))

    mark = {name: pa.scalar(name, pa.large_string()) for name in (PREFIX, SUFFIX, MIDDLE, "")}
    psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, mark[""])
    spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, mark[""])
    holds = pc.match_substring_regex(texts, "|".join((PREFIX, SUFFIX, MIDDLE))).to_numpy(zero_copy_only=False)
    plain = pa.array((n == 0) | holds | (draws[2] % 100 >= rearranged))
    is_spm = pa.array(draws[3] % 100 < suffix_first)
    form = pc.if_else(plain, PLAIN, pc.if_else(is_spm, SPM, PSM))
    lengths = (pc.utf8_length(part).cast(pa.int64()) for part in (prefix, middle))
    shown = [pc.if_else(plain, pa.scalar(None, pa.int64()), length) for length in lengths]
    output = pc.if_else(plain, texts, pc.if_else(is_spm, spm, psm))
    return [pa.array(n), form, *shown, output.cast(pa.string())]


def _part(flat: pa.Array, parents: pa.Array, mask: pa.Array, rows: int) -> pa.Array:
    """The units that the mask picks, joined for each row."""
    counts = np.bincount(parents.filter(mask).to_numpy(), minlength=rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(mask)), pa.scalar("", pa.large_string()))


def _absent(texts: pa.Array) -> str:
    """A character that none of the texts holds: control characters first, then any other."""
    candidates = (chr(k) for r in (range(1, 9), range(0xE000, 0xF900), range(0x10000, 0x110000)) for k in r)
    return next(mark for mark in candidates if not pc.any(pc.match_substring(texts, mark)).as_py())
