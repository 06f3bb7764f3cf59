"""Delimited files against the csv module, with and without line breaks in cells."""

from __future__ import annotations

import csv
import random

import pyarrow as pa
import pytest

from cohortloom.sources.delimited import _Blocks, _quotes, _states, distinct_names, read_delimited


def write(path, rows, **options):
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, **options).writerows(rows)
    return str(path)


def read(spark, path, **options):
    frame = read_delimited(spark, path, **options)
    assert all(field.dataType.simpleString() == "string" for field in frame.schema)
    return frame.columns, sorted(tuple("" if v is None else v for v in row) for row in frame.collect())


def test_everything_stays_text(spark, tmp_path):
    cells_in = [["0012", "33", "NA"], ["1", "", "null"], ["1e3", " a ", 'q"q,']]
    path = write(tmp_path / "a.csv", [["id", "apoe", "x"], *cells_in])
    columns, rows = read(spark, path)
    assert columns == ["id", "apoe", "x"]
    assert rows == [("0012", "33", "NA"), ("1", "", "null"), ("1e3", " a ", 'q"q,')]
    frame = read_delimited(spark, path)
    assert frame.where("apoe is null").count() == 1 and frame.count() == 3


def test_quoted_empty_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"",x\n')
    assert read_delimited(spark, str(tmp_path / "a.csv")).first()["a"] is None


def test_short_rows_fill_and_blank_lines_skip(spark, tmp_path):
    for multiline in (False, True):
        (tmp_path / "a.csv").write_text('a,b,c\n1\n\n  \n"x,y",2\n')
        assert read(spark, str(tmp_path / "a.csv"), multiline=multiline)[1] == [("1", "", ""), ("x,y", "2", "")]


@pytest.mark.parametrize("blank", ["\t", " \t ", "\x0b", "", "\x1f"])
def test_blank_lines_do_not_depend_on_the_reader(spark, tmp_path, blank):
    (tmp_path / "a.csv").write_text(f"a,b\n1,2\n{blank}\n3,4\n")
    (tmp_path / "b.csv").write_text(f'a,b\n1,2\n{blank}\n3,"4\n4"\n')
    assert read(spark, str(tmp_path / "a.csv"))[1] == [("1", "2"), ("3", "4")]
    assert read(spark, str(tmp_path / "b.csv"))[1] == [("1", "2"), ("3", "4\n4")]


@pytest.mark.parametrize("multiline", [None, False, True])
def test_headers_must_agree(spark, tmp_path, multiline):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("id,sex,age\na,F,70\n")
    (tmp_path / "d" / "2.csv").write_text("\nid,sex,age\r\nb,M,71\r\n")
    assert read(spark, str(tmp_path / "d"), multiline=multiline)[1] == [("a", "F", "70"), ("b", "M", "71")]
    (tmp_path / "d" / "3.csv").write_text("id,age,sex\nc,72,M\n")
    with pytest.raises(ValueError, match="different headers"):
        read_delimited(spark, str(tmp_path / "d"), multiline)


@pytest.mark.parametrize("multiline", [False, True])
def test_long_rows_stop_the_job(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,"4,4",5\n')
    frame = read_delimited(spark, str(tmp_path / "a.csv"), multiline)
    with pytest.raises(Exception, match="Too many fields"):
        frame.collect()
    with pytest.raises(Exception, match="Too many fields"):
        frame.select("a").collect()
    with pytest.raises(Exception, match="Too many fields"):
        frame.count()


def test_header_names(spark, tmp_path):
    assert distinct_names(["a", "a", "", "a.1", "a"]) == ["a", "a.2", "Unnamed: 2", "a.1", "a.3"]
    (tmp_path / "a.csv").write_text('﻿Sex,sex,a.b,"two\nlines"\nF,M,1,2\n', encoding="utf-8")
    assert read(spark, str(tmp_path / "a.csv")) == (["Sex", "sex", "a.b", "two\nlines"], [("F", "M", "1", "2")])


def cells(rng):
    return "".join(rng.choice(['"', ",", "\n", "\r\n", "a", "é", " ", "\r", "b,c", '""']) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split, edge", [(None, 1 << 16), (300, 1 << 16), (300, 5)])
def test_line_breaks_in_cells(spark, tmp_path, seed, split, edge):
    """Random cells full of quotes and breaks, whole and cut into small blocks, with and without room for cut pieces."""
    rng = random.Random(seed)
    width = 4
    rows = [[f"r{i}", *(cells(rng) for _ in range(width - 1))] for i in range(300)]
    path = write(tmp_path / "a.csv", [["id", "b\nb", "c", "d"], *rows], lineterminator=rng.choice(["\n", "\r\n"]))
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        columns, got = read(spark, path, edge_bytes=edge)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert columns == ["id", "b\nb", "c", "d"]
    assert got == sorted(tuple(row) for row in rows)


@pytest.mark.parametrize("multiline", [None, True])
def test_quotes_within_unquoted_cells(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text('a,b\n1,5" probe\n2,x\n3,6" probe\n4,"y"\n')
    want = [("1", '5" probe'), ("2", "x"), ("3", '6" probe'), ("4", "y")]
    assert read(spark, str(tmp_path / "a.csv"), multiline=multiline)[1] == want
    (tmp_path / "b.csv").write_text('a,b\n1,5" probe\n2,"x\n,"" z"\n3,6" probe\n4,"y\n"",""\n"\n5,\n')
    want = [("1", '5" probe'), ("2", 'x\n," z'), ("3", '6" probe'), ("4", 'y\n","\n'), ("5", "")]
    assert read(spark, str(tmp_path / "b.csv"), multiline=multiline)[1] == want


@pytest.mark.parametrize("edge", [1 << 16, 3])
def test_cells_longer_than_blocks(spark, tmp_path, edge):
    """Cells over several blocks, with blank lines and quotes, and a header that a block's edge cuts."""
    rows = [["id", "two\n" * 30 + "lines"], *([f"r{i}", "\n".join(["x", "", 'say ""', ","] * (i * 9))] for i in range(12))]
    path = write(tmp_path / "a.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 150)
    try:
        columns, got = read(spark, path, edge_bytes=edge)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert columns == rows[0] and got == sorted(map(tuple, rows[1:]))


def test_states_of_lines():
    """The end of each line against a walk over its characters, from either start."""
    rng = random.Random(3)
    for _ in range(400):
        lines = ["".join(rng.choice('""",,ab ') for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 30))]
        some = pa.array(["", 'x"', *lines]).slice(2)
        for start in (False, True):
            state, want = start, []
            for line in lines:
                state = ends_inside(line, state)
                want.append(state)
            assert _states(some, _quotes(some), start).tolist() == want, lines


def ends_inside(line: str, inside: bool) -> bool:
    k, begins = 0, True
    while k < len(line):
        if inside and line[k] == '"':
            if line[k + 1 : k + 2] == '"':
                k += 1
            else:
                inside = False
        elif line[k] == '"' and begins:
            inside = True
        begins = line[k] == ","
        k += 1
    return inside


def test_two_scans_of_the_text(spark, tmp_path):
    """One scan finds out about the blocks, one reads the records; no line is shuffled by either."""
    path = write(tmp_path / "a.csv", [["id", "t"], *([f"r{i}", f"x\ny{i}"] for i in range(2000))])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        blocks = _Blocks(spark, path, 1 << 16)
        plan = blocks.records()._jdf.queryExecution().executedPlan().toString()
        assert read_delimited(spark, path).count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert blocks.has_open_lines and blocks.inside_blocks > 0 and not blocks.lost
    assert plan.count("FileScan text") == 1
    branch = plan[: plan.index("FileScan text")].splitlines()
    assert "hashpartitioning(value" not in plan and any("MapInArrow" in line for line in branch)
    one_line = _Blocks(spark, write(tmp_path / "b.csv", [["id", "t"], ["1", "a,b"]]), 1 << 16)
    assert not one_line.has_open_lines


def test_folder_of_files(spark, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    for i in range(3):
        write(folder / f"{i}.csv", [["id", "t"], [f"{i}a", "x\ny"], [f"{i}b", "z"]])
    assert read(spark, str(folder))[1] == sorted((f"{i}{k}", t) for i in range(3) for k, t in (("a", "x\ny"), ("b", "z")))


def test_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(ValueError, match="never closed"):
        read_delimited(spark, str(tmp_path / "a.csv"))


def test_stray_carriage_return_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\n1,"x\ny"\r3,4\n')
    with pytest.raises(Exception, match="Carriage return"):
        read_delimited(spark, str(tmp_path / "a.csv")).collect()
