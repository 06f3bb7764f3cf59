"""The headers of a whole catalogue of deliveries, found by one Spark job.

Every file is scanned as text, but no further than its header: a block that its file goes on after fills a task of its own,
and that task stops behind the header, or at once if the block is not its file's first. Blocks that end a file may share a
task and are read to their end, so a task reads no more than a block's bytes, however large the deliveries are.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Mapping
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.delimited import distinct_names

SCHEMA = "study_id string, column_name string"

_CLOSED_CELL = re.compile(r'(^|,)"[^"]*"')
_OPEN_CELL = re.compile(r'(^|,)"')


def delivered_headers(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(study_id, column_name)`` of the file or folder of each study, no pair twice.

    Columns are named as :func:`~cohortloom.sources.delimited.read_delimited` names them. A header counts without rows below
    it and may hold line breaks in quoted cells; empty lines before it are skipped. An empty file delivers no column, and a
    header whose quote never closes stops the job.
    """
    scans = [_lines(spark, study, paths[study]) for study in sorted(paths)]
    if not scans:
        return spark.createDataFrame([], SCHEMA)
    # With a number of partitions asked for, Spark may put any blocks together, so every task reads all of its own.
    alone = spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    return reduce(DataFrame.union, scans).mapInArrow(partial(_columns, alone), SCHEMA).distinct()


def _lines(spark: SparkSession, study: str, path: str) -> DataFrame:
    start, length = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.lit(study).alias("study_id"),
        F.xxhash64("_metadata.file_path").alias("file"),
        (start == 0).alias("is_first"),
        (start + length < F.col("_metadata.file_size")).alias("goes_on"),
        "value",
    )


def _columns(alone: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    headers: dict[int, _Header] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        files, is_first = batch.column("file").to_numpy(), batch.column("is_first").to_numpy(zero_copy_only=False)
        for file in np.unique(files[is_first]).tolist():
            header = headers.setdefault(file, _Header())
            if header.is_whole:
                continue
            rows = np.flatnonzero(files == file)
            study = batch.column("study_id")[int(rows[0])].as_py()
            if any(header.add(batch.column("value")[k].as_py()) for k in rows.tolist()):
                names = header.names()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([study] * len(names)), pa.array(names)], names=["study_id", "column_name"]
                )
        if alone and batch.column("goes_on")[0].as_py() and all(header.is_whole for header in headers.values()):
            return  # the only block of its task
    if any(header.is_open for header in headers.values()):
        raise ValueError("A quoted cell of a header never closes")


class _Header:
    """The first record of a file, line by line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.is_open = False
        self.is_whole = False

    def add(self, line: str) -> bool:
        """Take the next line; whether the record is whole now."""
        if not self.lines:
            line = line.removeprefix("\ufeff")
            if not line.removesuffix("\r"):  # Spark's reader skips such lines as well
                return False
        self.lines.append(line)
        rest = line.replace('""', "")  # pairs never change on which side of a quote the text goes on
        if self.is_open:
            _, quote, rest = rest.partition('"')
            if not quote:
                return False
        self.is_open = bool(_OPEN_CELL.search(_CLOSED_CELL.sub(r"\1", rest)))
        self.is_whole = not self.is_open
        return self.is_whole

    def names(self) -> list[str]:
        record = "\n".join(self.lines).removesuffix("\r")
        return distinct_names(next(csv.reader(io.StringIO(record, newline=""))))
