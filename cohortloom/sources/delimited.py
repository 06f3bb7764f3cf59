"""Delimited files as all-string tables, read in splits also when cells hold line breaks.

Only an empty field is null; ``NA``, ``0012`` and the like stay text. Rows that are too short get nulls, rows that are
too long stop the job: a field without a column means the row was not understood.

Spark reads a file with quoted line breaks in one task (``multiLine``). :func:`read_delimited` reads such files split by
split, in two scans of their text. The first one is speculative: which state a block starts in, inside a quoted cell or
outside, is only known when all blocks before it are, so each task follows its block from both states at once. It leaves a
row for each block: the state the block ends in, and the pieces of a record that its edges cut, for either start. Chaining
these rows over each file tells how every block starts, whether headers agree and whether any cell holds a line break at
all; if none does, Spark's own reader takes the second scan. Otherwise that scan joins every block's whole records in
place, while cut records are put together from the first scan's pieces. No line is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from cohortloom.functions.fence import fence
from cohortloom.sources.scratch import staged

_CSV = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


#: Longer pieces of a record at a block's edge are not kept by the first scan but read again.
EDGE_BYTES = 1 << 16
#: Up to so many blocks that start inside a cell, at about 64 bytes each, are broadcast.
BROADCAST_BLOCKS = 1 << 20


def read_delimited(
    spark: SparkSession, path: str, multiline: bool | None = None, edge_bytes: int = EDGE_BYTES
) -> DataFrame:
    """Read a CSV file, or a folder of them that all have the same header; other folders are an error.

    ``multiline`` says whether quoted cells hold line breaks. Leave it open to have the files checked, which reads them
    once more; False, set per source where it is known, saves that.
    """
    names = _header(spark, path)
    if multiline is False:
        _check_headers(spark, path)
        return _line_rows(spark, path, len(names)).toDF(*names)
    blocks = _Blocks(spark, path, edge_bytes)
    if not (multiline or blocks.has_open_lines):
        return _line_rows(spark, path, len(names)).toDF(*names)
    return _joined_rows(blocks.records(), len(names)).toDF(*names)


def _header(spark: SparkSession, path: str) -> list[str]:
    # multiLine only so that the header itself may hold a line break; just the first record is read.
    first = spark.read.options(**_CSV, header=False, multiLine=True).csv(path).first()
    if first is None:
        raise ValueError(f"No header in {path}")
    cells = ["" if name is None else name for name in first]
    # With a line break inside the header, its "\n" is taken for the line end of a file that uses "\r\n".
    return distinct_names([*cells[:-1], cells[-1].removesuffix("\r")])


def _has_text(line: Column) -> Column:
    """False for lines that Spark's own reader skips: nothing but control characters and spaces."""
    return line.rlike(r"[^\x00-\x20]")


def _check_headers(spark: SparkSession, path: str) -> None:
    """Fields are read by position, so files with other headers would lose their meaning. A single file is not read."""
    lines = spark.read.text(path)
    if len(lines.inputFiles()) < 2:
        return
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),  # rising within a block
        F.regexp_replace("value", r"^\ufeff|\r$", "").alias("line"),
    )
    first = placed.where((F.col("block") == 0) & _has_text(F.col("line"))).groupBy("file").agg(
        F.min_by("line", "position").alias("header")
    )
    headers = first.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").take(2)
    if len(headers) > 1:
        _raise_headers([(row.header, row.file) for row in headers])


def _raise_headers(headers: list[tuple[str, str]]) -> None:
    told = " and ".join(f"{header!r} in {file}" for header, file in headers)
    raise ValueError(f"Files of one delivery have different headers: {told}")


def distinct_names(header: list[str]) -> list[str]:
    """Header cells as column names: empty ones by position, repeated ones numbered (``a``, ``a.1``)."""
    names: list[str] = []
    taken = set(header)
    for position, cell in enumerate(header):
        name, copy = cell or f"Unnamed: {position}", 0
        while name in names or (copy and name in taken):
            copy += 1
            name = f"{cell}.{copy}"
        names.append(name)
    return names


def _fields(width: int) -> list[str]:
    return [f"_c{i}" for i in range(width)]


def _schema(width: int) -> str:
    return ", ".join(f"{name} string" for name in _fields(width))


def _unless(problem: Column, message: Column) -> Column:
    """A filter that passes every row and stops the job at a problem."""
    return F.when(~problem, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def _line_rows(spark: SparkSession, path: str, width: int) -> DataFrame:
    rows = (
        spark.read.schema(f"{_schema(width)}, __bad string")
        # Pruned columns would not be counted, so a row that is too long could pass.
        .options(**_CSV, header=True, columnNameOfCorruptRecord="__bad", columnPruning=False)
        .csv(path)
    )
    # __bad holds rows that are too long or too short; only the former have a field beyond the last column.
    surplus = F.from_csv("__bad", _schema(width + 1), _CSV)[f"_c{width}"]
    too_long = F.col("__bad").isNotNull() & surplus.isNotNull()
    start = F.coalesce("_c0", F.lit(""))
    message = F.concat(F.lit("Too many fields in the row of '"), start, F.lit("': "), "__bad")
    return rows.where(_unless(too_long, message)).select(*_fields(width))


def _unquoted(text: Column) -> Column:
    """Text that starts outside quotes, without its closed quoted cells.

    A quote opens a cell only at the cell's start; elsewhere (``5" probe``) it is a character like any other. Doubled
    quotes can go first: they never change on which side of a quote the text goes on.
    """
    return F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), '(^|,)"[^"]*"', "$1")


def _state_before(ordered: WindowSpec, start: bool) -> Column:
    """Whether each row of ``(from_out, from_in)`` starts inside a cell, if the first one starts as given.

    A row either keeps the state, swaps it, or sets it whatever it was. So the state is what the last setting row left,
    swapped once per swapping row since.
    """
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("from_out") == F.col("from_in")
    swaps = F.col("from_out") & ~F.col("from_in")
    all_swaps = F.coalesce(F.count_if(swaps).over(earlier), F.lit(0))
    left = F.last(F.when(sets, F.col("from_out")), ignorenulls=True).over(earlier)
    # Swaps up to and with the last setting row, which is none itself.
    until = F.last(F.when(sets, F.col("swaps_so_far")), ignorenulls=True).over(earlier)
    swapped = (all_swaps - F.coalesce(until, F.lit(0))) % 2 == 1
    return F.coalesce(left, F.lit(start)) != swapped


def _with_states(table: DataFrame, ordered: WindowSpec, **starts: bool) -> DataFrame:
    """Add a column per named start, see :func:`_state_before`."""
    swaps = F.col("from_out") & ~F.col("from_in")
    counted = table.withColumn(
        "swaps_so_far", F.count_if(swaps).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return counted.withColumns({name: _state_before(ordered, start) for name, start in starts.items()})


def _joined_rows(records: DataFrame, width: int) -> DataFrame:
    # Behind the fence, so that a record is parsed once and not again for each mention of its row.
    parsed = fence(records.select("record", F.from_csv("record", _schema(width + 1), _CSV).alias("row")))
    # Outside quotes, a carriage return would be one more kind of line end; read as part of a line it would lose rows.
    record = F.col("record")
    stray_return = record.contains("\r") & _unquoted(record).contains("\r")
    return (
        parsed.where(
            _unless(stray_return, F.concat(F.lit("Carriage return as line end within: "), "record"))
            & _unless(F.col(f"row._c{width}").isNotNull(), F.concat(F.lit("Too many fields: "), "record"))
        )
        .select("row.*")
        .select(*_fields(width))
    )


class _Blocks:
    """The blocks of a file or folder after the first scan."""

    def __init__(self, spark: SparkSession, path: str, edge_bytes: int):
        self.spark, self.path = spark, path
        lines = _lines_of(spark, path)
        survey = staged(lines.mapInArrow(_surveyor(edge_bytes), _SURVEY), "csv-blocks")
        by_block = Window.partitionBy("file").orderBy("block")
        placed = _with_states(survey, by_block, inside=False)
        inside, closes = F.col("inside"), F.col("closes")
        self.placed = placed.withColumns(
            {
                "ends_inside": F.when(inside, F.col("from_in")).otherwise(F.col("from_out")),
                "tail": F.when(inside, F.col("tail_in")).otherwise(F.col("tail_out")),
                "tail_open": F.when(inside, closes & F.col("from_in")).otherwise(F.col("from_out")),
            }
        )
        found = self._found()
        if found["unclosed"] is not None:
            raise ValueError(f"A quoted cell is never closed in {self._name(found['unclosed'])}")
        if found["lowest"] and found["lowest"].header != found["highest"].header:
            told = [(x.header, self._name(x.file)) for x in (found["lowest"], found["highest"])]
            _raise_headers(sorted(told, key=lambda pair: pair[1]))
        self.has_open_lines, self.lost, self.inside_blocks = found["opens"], found["lost"], found["inside_blocks"]

    def _name(self, file: int) -> str:
        """The path of a file that is known by its number."""
        paths = self.spark.read.text(self.path).select("_metadata.file_path")
        return paths.where(F.xxhash64("file_path") == file).first()[0]

    def _found(self) -> dict:
        """What the driver has to know, in one row."""
        last = Window.partitionBy("file")
        # A header that its first block cuts is told by its beginning.
        header = F.regexp_replace(F.coalesce("header", "tail"), r"^\ufeff|\r$", "")
        told = F.when((F.col("block") == 0) & header.isNotNull(), F.struct(header.alias("header"), "file"))
        lost = (F.col("inside") & F.col("head").isNull()) | (F.col("tail_open") & F.col("tail").isNull())
        row = (
            self.placed.withColumn("last", F.max("block").over(last))
            .agg(
                F.min(F.when(F.col("ends_inside") & (F.col("block") == F.col("last")), F.col("file"))).alias("unclosed"),
                F.coalesce(F.bool_or("opens"), F.lit(False)).alias("opens"),
                F.coalesce(F.bool_or(lost), F.lit(False)).alias("lost"),
                F.count_if("inside").alias("inside_blocks"),
                F.min(told).alias("lowest"),
                F.max(told).alias("highest"),
            )
            .first()
        )
        return row.asDict()

    def records(self) -> DataFrame:
        """One text per record, without the header. A record's lines are joined again by the line break they had."""
        whole = self._lines().mapInArrow(_whole_records, "record string")
        if self.inside_blocks:
            whole = whole.union(self._mended())
        ended = F.col("record").endswith(F.lit("\r"))
        return whole.select(F.when(ended, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")).alias("record"))

    def _lines(self) -> DataFrame:
        """Every line with the state its block starts in."""
        lines = _lines_of(self.spark, self.path)
        if not self.inside_blocks:
            return lines.withColumn("inside", F.lit(False))
        starts = self.placed.where("inside").select("file", "block", "inside")
        if self.inside_blocks <= BROADCAST_BLOCKS:
            starts = F.broadcast(starts)
        return lines.join(starts, ["file", "block"], "left").select(
            *lines.columns, F.coalesce("inside", F.lit(False)).alias("inside")
        )

    def _mended(self) -> DataFrame:
        """The records that edges cut, from their pieces: an open end, and what follows in the blocks after it."""
        so_far = Window.partitionBy("file").orderBy("block", "part")
        numbered = self._pieces().withColumn("cell", F.count_if(F.col("part") == _TAIL).over(so_far))
        parts = F.array_sort(F.collect_list(F.struct("block", "part", "record")))  # the pieces of one record
        return (
            numbered.groupBy("file", "cell")
            .agg(parts.alias("parts"), F.max("is_header").alias("is_header"))
            .where(~F.col("is_header"))
            .select(F.array_join(F.transform("parts", lambda part: part["record"]), "\n").alias("record"))
        )

    def _pieces(self) -> DataFrame:
        """``(file, block, part, is_header, record)``; long ones take a scan of their own."""
        if self.lost:
            return staged(self._lines().mapInArrow(_cut_pieces, _PIECE), "csv-edges")
        is_header = (F.col("block") == 0) & F.col("header").isNull()
        head = F.struct(F.lit(_HEAD).alias("part"), F.lit(False).alias("is_header"), F.col("head").alias("record"))
        tail = F.struct(F.lit(_TAIL).alias("part"), is_header.alias("is_header"), F.col("tail").alias("record"))
        both = F.array_compact(F.array(F.when(F.col("inside"), head), F.when(F.col("tail_open"), tail)))
        return self.placed.select("file", "block", F.inline(both))


_SURVEY = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in ("file", "block")),
        # Whether a line opens a cell; the block's last state for either first one; whether an open cell closes in it.
        *(T.StructField(name, T.BooleanType()) for name in ("opens", "from_out", "from_in", "closes")),
        # The header, in a first block; what ends a record begun before; the open end for either start.
        *(T.StructField(name, T.StringType()) for name in ("header", "head", "tail_out", "tail_in")),
    ]
)
_PIECE = "file long, block long, part int, is_header boolean, record string"
# The end of a record that an earlier block began, and the beginning of one that goes on in a later block.
_HEAD, _TAIL = 0, 1


def _lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Every line, in file order within its task, with its file as a number and its block."""
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def _quotes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What changes the state, in order: the line each change is in, and whether it swaps the state or ends a cell.

    Of quotes in a row, pairs change nothing. A single one, or the odd one out, opens a cell where a cell may begin, behind
    a comma or at a line's start, and closes one that is open: it swaps. Elsewhere (``5" probe``) it can only close.
    """
    count = len(lines)
    edges = np.frombuffer(lines.buffers()[1], "int32")[lines.offset : lines.offset + count + 1]
    data = lines.buffers()[2]
    text = np.frombuffer(data, "uint8")[edges[0] : edges[-1]] if data is not None else np.zeros(0, "uint8")
    at = np.flatnonzero(text == ord('"'))
    line = np.searchsorted(edges[1:] - edges[0], at, "right")
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (line[1:] != line[:-1])
    begins = np.flatnonzero(first)
    odd = np.diff(np.append(begins, len(at))) % 2 == 1
    at, line = at[begins[odd]], line[begins[odd]]
    swaps = (at == edges[line] - edges[0]) | (text[at - 1] == ord(","))
    return line, swaps


def _states(lines: pa.Array, changes: tuple[np.ndarray, np.ndarray], start: bool) -> np.ndarray:
    """Whether each line ends inside a cell: what the last change that ends a cell left, swapped since."""
    line, swaps = changes
    swapped = np.concatenate([[0], np.cumsum(swaps)])
    ending = np.maximum.accumulate(np.concatenate([[0], np.where(swaps, 0, np.arange(1, len(swaps) + 1))]))
    state = np.where(ending > 0, False, start) ^ ((swapped - swapped[ending]) % 2 == 1)
    return state[np.searchsorted(line, np.arange(len(lines)), "right")]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Each batch cut where another block begins; a block's rows come in order, maybe in several pieces."""
    for batch in batches:
        if batch.num_rows:
            file, block = (batch.column(name).to_numpy() for name in ("file", "block"))
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                yield (int(file[begin]), int(block[begin])), batch.slice(begin, end - begin)


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """Stretches of lines, up to each of ``ends``, as one text each."""
    if len(ends) == len(lines):
        return lines
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


class _Pending:
    """Lines of a record that is still open, as texts that are joined when it closes."""

    def __init__(self, most: int | None = None):
        self.texts: list[str] = []
        self.size, self.most = 0, most

    def add(self, lines: pa.Array) -> None:
        if not len(lines):
            return
        self.size += pc.sum(pc.binary_length(lines)).as_py() + len(lines)
        if self.most is None or self.size <= self.most:
            self.texts.append(_joined(lines, np.array([len(lines)]))[0].as_py())

    def clear(self) -> None:
        self.texts, self.size = [], 0

    @property
    def text(self) -> str | None:
        """None if there were more bytes than are kept."""
        return None if self.most is not None and self.size > self.most else "\n".join(self.texts)


_TEXT = r"[^\x00-\x20]"  # Spark's own reader skips lines without such a character


class _Speculation:
    """One block, followed from one start."""

    def __init__(self, start: bool, most: int | None):
        self.starts_inside = self.state = start
        self.has_record = False  # whether a record that is not blank has ended
        self.ended = False  # whether a record has ended
        self.head: str | None = None
        self.pending = _Pending(most)

    def follow(self, lines: pa.Array, changes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Take in lines; gives the places behind those that end a record."""
        after = _states(lines, changes, self.state)
        ends = np.flatnonzero(~after) + 1
        if len(ends):
            if not self.ended:
                self.pending.add(lines.slice(0, ends[0]))
                self.head, self.ended = self.pending.text, True
            self.pending.clear()
        self.pending.add(lines.slice(ends[-1] if len(ends) else 0))
        self.state = bool(after[-1])
        return ends


def _surveyor(most: int):
    """The first scan: a row of ``_SURVEY`` for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        starts: dict[bool, _Speculation] = {}
        for (file, block), part in _blocks(batches):
            if not rows or (rows[-1]["file"], rows[-1]["block"]) != (file, block):
                _conclude(rows, starts)
                rows.append({"file": file, "block": block, "opens": False, "header": None})
                starts = {start: _Speculation(start, most) for start in (False, True)}
            lines = part.column("value")
            changes = _quotes(lines)
            before = starts[False].pending.text if block == 0 and rows[-1]["header"] is None else None
            ends = starts[False].follow(lines, changes)
            starts[True].follow(lines, changes)
            rows[-1]["opens"] |= len(ends) < len(lines)
            if block == 0 and rows[-1]["header"] is None and len(ends):
                rows[-1]["header"] = _first_record(lines, ends, before)
        _conclude(rows, starts)
        fields = [("file", pa.int64()), ("block", pa.int64())]
        fields += [(f.name, pa.bool_() if f.dataType == T.BooleanType() else pa.string()) for f in _SURVEY.fields[2:]]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    return run


def _conclude(rows: list[dict], starts: dict[bool, _Speculation]) -> None:
    """Add what the two speculations about a block came to."""
    if rows:
        out, inside = starts[False], starts[True]
        rows[-1] |= {"from_out": out.state, "from_in": inside.state, "closes": inside.ended}
        rows[-1]["head"] = inside.head if inside.ended else inside.pending.text
        rows[-1]["tail_out"] = out.pending.text if out.state else None
        rows[-1]["tail_in"] = inside.pending.text if inside.state and inside.ended else None


def _first_record(lines: pa.Array, ends: np.ndarray, before: str | None) -> str | None:
    """The first record that is not blank; ``before`` is what earlier batches hold of the first one."""
    for k, text in enumerate(_joined(lines.slice(0, ends[-1]), ends)):
        record = f"{before}\n{text.as_py()}" if before and not k else text.as_py()
        if pc.match_substring_regex(pa.array([record]), _TEXT)[0].as_py():
            return record
    return None


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second scan: a block's records as they stream by, but those that its edges cut. Blank lines between them go."""
    key: tuple[int, int] | None = None
    state = is_head = wants_header = False
    pending = _Pending()
    for place, part in _blocks(batches):
        if place != key:
            key, state, wants_header = place, part.column("inside")[0].as_py(), place[1] == 0
            is_head = state
            pending.clear()
        lines = part.column("value")
        after = _states(lines, _quotes(lines), state)
        state = bool(after[-1])
        ends = np.flatnonzero(~after) + 1
        if len(ends):
            records = _joined(lines.slice(0, ends[-1]), ends)
            if pending.texts or is_head:
                pending.add(lines.slice(0, ends[0]))
                first = [] if is_head else [pending.text]
                records = pa.concat_arrays([pa.array(first, records.type), records.slice(1)])
                pending.clear()
                is_head = False
            records = records.filter(pc.match_substring_regex(records, _TEXT))
            if wants_header and len(records):
                records, wants_header = records.slice(1), False
            yield pa.RecordBatch.from_arrays([records], names=["record"])
        if not is_head:
            pending.add(lines.slice(ends[-1] if len(ends) else 0))


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces at the edges of blocks, whatever their length."""
    key: tuple[int, int] | None = None
    follower = None
    out: list[tuple] = []

    def close() -> None:
        if follower and key:
            if follower.starts_inside:
                out.append((*key, _HEAD, False, follower.head if follower.ended else follower.pending.text))
            if follower.state and (follower.ended or not follower.starts_inside):
                out.append((*key, _TAIL, key[1] == 0 and not follower.has_record, follower.pending.text))

    for place, part in _blocks(batches):
        if place != key:
            close()
            key = place
            follower = _Speculation(part.column("inside")[0].as_py(), None)
        lines = part.column("value")
        ends = follower.follow(lines, _quotes(lines))
        if len(ends) and not follower.has_record:
            follower.has_record = pc.any(pc.match_substring_regex(lines.slice(0, ends[-1]), _TEXT)).as_py()
    close()
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    names = ["file", "block", "part", "is_header", "record"]
    columns = zip(*out, strict=True) if out else [[]] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)
