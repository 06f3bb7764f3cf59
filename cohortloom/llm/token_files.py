"""Token ids as Arrow files of equal-length sequences and masks, read in place.

Documents are dealt out by ranges of their id and sorted within tasks; each task encodes its range as it streams by and
writes two files of the Arrow file format: ``tokens-N.arrow``, record batches of ``rows`` sequences, each a fixed-size list
of ``length`` ids with a fixed-size list of mask bits (false: padding behind the range's last id), and ``docs-N.arrow``,
where each document begins and how many ids it has. Every batch but a file's last holds as many sequences, so sequence
``s`` is found by division, and a mapped file gives it as a view of the file's own pages, without a copy. Ids take 16 bits
where the vocabulary fits, else 32. A file is written under a name of the attempt and renamed, so a repeated task leaves
the same files. The manifest has one row a file; what lies before a file is a sum over its rows.

Folders can be in any store that Arrow opens: ``file``, ``s3``, ``s3a``, ``gs``, ``hdfs``.

Defined cases: a null text is an empty one and has just the end id; documents are in ascending order of id, null first,
those of one id in order of their text's hash and text; repeated rows are repeated documents; an empty table gives no
files and no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.bpe import SLICE, Vocabulary, codec
from cohortloom.llm.frames import inputs, partitions, scratch_path, staged

MANIFEST = "number int, tokens string, docs string, n_docs long, n_ids long"


@dataclass(frozen=True)
class Layout:
    """``length`` ids a sequence, ``rows`` sequences a record batch, ``end_id`` after each document."""

    length: int = 2048
    rows: int = 64
    end_id: int = 2


def write_token_files(docs: DataFrame, vocabulary: Vocabulary, layout: Layout = Layout(), folder: str = "") -> DataFrame:
    """Write the files, by default to a new folder in the shared scratch space, and return the manifest."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    rows = inputs(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64("text").alias("mixed"),
    )
    ranged = rows.repartitionByRange(partitions(spark), "doc_id", "mixed").sortWithinPartitions("doc_id", "mixed", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = None
        own = codec(vocabulary)
        end = np.array([layout.end_id], "<u4").tobytes()
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                if writer is None:
                    wide = max(len(own.bytes_of) - 1, layout.end_id) >= 1 << 16
                    writer = TokenWriter(folder, task.partitionId(), task.taskAttemptId(), layout, wide)
                texts = part.column("text").to_pylist()
                writer.add(part.column("doc_id"), [ids + end for ids in own.encode_all(texts)])
        if writer is not None:
            yield writer.close()

    return staged(ranged.select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


class TokenWriter:
    """The two files of one range of documents."""

    def __init__(self, folder: str, number: int, attempt: int, layout: Layout, wide: bool) -> None:
        self.store, root = opened(folder)
        self.store.create_dir(root, recursive=True)
        self.number, self.layout = number, layout
        self.names = [f"{root}/{kind}-{number:06d}.arrow" for kind in ("tokens", "docs")]
        self.drafts = [f"{name}.{attempt}.part" for name in self.names]
        self.paths = [f"{folder}/{name.rpartition('/')[2]}" for name in self.names]
        kind = pa.uint32() if wide else pa.uint16()
        self.type = np.dtype("<u4" if wide else "<u2")
        sequence = [("ids", pa.list_(kind, layout.length)), ("mask", pa.list_(pa.bool_(), layout.length))]
        self.schemas = [
            pa.schema(sequence, {"length": str(layout.length), "rows": str(layout.rows)}),
            pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64())]),
        ]
        self.streams = [self.store.open_output_stream(name) for name in self.drafts]
        self.files = [pa.ipc.new_file(s, schema) for s, schema in zip(self.streams, self.schemas, strict=True)]
        self.waiting: list[bytes] = []
        self.n_waiting = self.n_docs = self.n_ids = 0

    def add(self, doc_ids: pa.Array, documents: list[bytes]) -> None:
        counts = np.array([len(ids) // 4 for ids in documents], "int64")
        starts = self.n_ids + np.cumsum(counts) - counts
        columns = [doc_ids, pa.array(starts), pa.array(counts)]
        self.files[1].write(pa.RecordBatch.from_arrays(columns, schema=self.schemas[1]))
        self.n_docs += len(documents)
        self.n_ids += int(counts.sum())
        self.waiting += documents
        self.n_waiting += int(counts.sum())
        if self.n_waiting >= self.layout.length * self.layout.rows:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        length, rows = self.layout.length, self.layout.rows
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        end = len(ids) if last else len(ids) // (length * rows) * length * rows
        for begin in range(0, end, length * rows):
            part = ids[begin : min(begin + length * rows, end)]
            size = -(-len(part) // length) * length
            values = np.zeros(size, self.type)
            values[: len(part)] = part
            lists = [values, np.arange(size) < len(part)]
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in lists]
            self.files[0].write(pa.RecordBatch.from_arrays(columns, names=["ids", "mask"]))
        self.waiting = [ids[end:].tobytes()]
        self.n_waiting = len(ids) - end

    def close(self) -> pa.RecordBatch:
        self._flush(last=True)
        for file, stream, draft, name in zip(self.files, self.streams, self.drafts, self.names, strict=True):
            file.close()
            stream.close()
            self.store.move(draft, name)
        row = [[self.number], self.paths[:1], self.paths[1:], [self.n_docs], [self.n_ids]]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = ["number", "tokens", "docs", "n_docs", "n_ids"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)


class TokenFile:
    """Random access to the sequences of a token file."""

    def __init__(self, path: str) -> None:
        store, name = opened(path)
        is_local = isinstance(store, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(name) if is_local else store.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = int(self.file.schema.metadata[b"length"])
        self.rows = int(self.file.schema.metadata[b"rows"])
        self.batches: dict[int, pa.RecordBatch] = {}

    def _batch(self, k: int) -> pa.RecordBatch:
        if k not in self.batches:
            self.batches = {k: self.file.get_batch(k)}
        return self.batches[k]

    def __getitem__(self, sequence: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, a view of the file, and mask of one sequence."""
        batch, row = self._batch(sequence // self.rows), sequence % self.rows
        ids, mask = batch.column(0)[row].values, batch.column(1)[row].values
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def span(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, across sequences."""
        parts, size = [], self.length * self.rows
        while count:
            k, at = divmod(start, size)
            parts.append(self._batch(k).column(0).values.to_numpy()[at : at + count])
            start, count = start + len(parts[-1]), count - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, "uint32")

    def close(self) -> None:
        self.batches = {}
        self.source.close()


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, all from the files.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over 32-bit little-endian ids.
    """
    before = F.sum("n_ids").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("number", "tokens", "docs", F.coalesce(before, F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(row["tokens"])
                store, name = opened(row["docs"])
                with store.open_input_file(name) as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        docs = index.get_batch(k)
                        starts, counts = (docs.column(c).to_numpy() for c in ("start", "n_ids"))
                        sums = [
                            zlib.crc32(tokens.span(a, n).astype("<u4").tobytes())
                            for a, n in zip(starts.tolist(), counts.tolist(), strict=True)
                        ]
                        columns = [docs.column("doc_id"), pa.array(starts + row["before"]), pa.array(counts)]
                        columns.append(pa.array(sums, pa.int64()))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
                tokens.close()

    spread = placed.repartition(partitions(manifest.sparkSession), "number")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pa.fs.LocalFileSystem(), path
    if scheme == "file":
        return pa.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pa.fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")
