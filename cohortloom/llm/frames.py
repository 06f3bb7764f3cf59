"""Column helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.scratch import scratch_path, staged

__all__ = [
    "WHITE",
    "WORD",
    "apart",
    "cut",
    "fields",
    "inputs",
    "mapped",
    "packed",
    "partitions",
    "pieces",
    "scratch_path",
    "staged",
    "unpacked",
]

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: The white space of all contracts: space, and tab to carriage return.
WHITE = " \t\n\x0b\f\r"
#: A word is a run of other characters.
WORD = r"[^\x20\x09-\x0D]+"


def fields(names: list[str]) -> list[str]:
    """Names for the fields of a packed row: as given, but of columns alike in all but case only one keeps its name.

    That is the one in lower case, or else the first; the others get their position as well.
    """
    keeps: dict[str, int] = {}
    for k, name in enumerate(names):
        if name.lower() not in keeps or name == name.lower() != names[keeps[name.lower()]]:
            keeps[name.lower()] = k
    return [name if keeps[name.lower()] == k else f"{name}#{k}" for k, name in enumerate(names)]


def packed(frame: DataFrame, *inputs: str, but: tuple[str, ...] = ()) -> DataFrame:
    """``__row``, a struct of all columns not named in ``but``, see :func:`fields`, and beside it the ``inputs``.

    Columns are taken by position, so names that differ only in case, or hold dots, do no harm, and columns that an
    operator adds can't clash with given ones.
    """
    names = frame.columns
    gone = {position(names, name) for name in but}
    at = frame.toDF(*[f"c{k}" for k in range(len(names))])
    row = [F.col(f"c{k}").alias(name) for k, name in enumerate(fields(names)) if k not in gone]
    packed_row = F.struct(*row) if row else F.struct(F.lit(True).alias("any"))
    return at.select(packed_row.alias("__row"), *[F.col(f"c{position(names, name)}").alias(name) for name in inputs])


def unpacked(names: list[str], alias: str = "__row") -> list[Column]:
    return [F.col(alias).getField(field).alias(name) for name, field in zip(names, fields(names), strict=True)]


def inputs(frame: DataFrame, *names: str) -> DataFrame:
    """The columns of these names alone, taken by position."""
    at = frame.toDF(*[f"c{k}" for k in range(len(frame.columns))])
    return at.select(*[F.col(f"c{position(frame.columns, name)}").alias(name) for name in names])


def position(names: list[str], name: str) -> int:
    """Where the column stands: the first of exactly this name, else the only one that differs in case."""
    if name in names:
        return names.index(name)
    alike = [k for k, given in enumerate(names) if given.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"{len(alike)} columns are named like {name}")
    return alike[0]


def apart(
    frame: DataFrame, inputs: dict[str, str], made: list[str], used_up: tuple[str, ...] = ()
) -> tuple[DataFrame, list[Column]]:
    """The columns an operator works on, under the names that ``inputs`` gives them, apart from those that pass through.

    Columns are taken by position, so names that differ only in case, or hold dots, do no harm. The second result selects
    what passes through, under its old names: all columns but those ``used_up`` and those that ``made`` replaces.
    """
    names = frame.columns
    taken = {new: position(names, old) for new, old in inputs.items()}
    replaced = {name.lower() for name in made}
    gone = {position(names, old) for old in used_up} | {k for k, name in enumerate(names) if name.lower() in replaced}
    through = [k for k in range(len(names)) if k not in gone]
    at = frame.toDF(*[f"c{k}" for k in range(len(names))])
    row = F.struct(F.lit(True).alias("any"), *[f"c{k}" for k in through]).alias("__row")
    return (
        at.select(row, *[F.col(f"c{k}").alias(new) for new, k in taken.items()]),
        [F.col("__row").getField(f"c{k}").alias(names[k]) for k in through],
    )


def mapped(
    frame: DataFrame,
    inputs: dict[str, str],
    columns: list[Column],
    step: Step,
    made: dict[str, T.DataType],
    used_up: tuple[str, ...] = (),
) -> DataFrame:
    """What passes through of a frame, beside the columns that ``step`` makes; see :func:`apart`.

    ``step`` takes batches of ``__row`` and of ``columns``, expressions over the names of ``inputs``, and yields ``__row``
    and what it makes, as many rows in the same order.
    """
    packed, through = apart(frame, inputs, list(made), used_up)
    packed = packed.select("__row", *columns)
    fields = [packed.schema["__row"], *(T.StructField(name, kind) for name, kind in made.items())]
    return packed.mapInArrow(step, T.StructType(fields)).select(*through, *made)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into stretches of about ``most`` bytes of a text column; a longer text is a stretch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        offset = texts.offset
        width = "int64" if pa.types.is_large_string(texts.type) else "int32"
        ends = np.frombuffer(texts.buffers()[1], width)[offset : offset + len(texts) + 1].astype("int64")
        begin = 0
        while begin < len(texts):
            end = max(int(np.searchsorted(ends, ends[begin] + most, "right")) - 1, begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(frame: DataFrame) -> DataFrame:
    """The frame without its lineage: a table in the shared folder, which goes with the scope that it was made in."""
    return staged(frame, "cut")
