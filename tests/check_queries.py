"""Compare every registered query with its SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
)


def open_tables(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or nothing."""
    frame = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    types = {c[0]: str(c[1]).lower() for c in result.description}
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(columns)} != {sorted(frame.columns)}"
    names = {"bigint": "bigint", "varchar": "string", "double": "double", "boolean": "boolean", "integer": "int"}
    for field in frame.schema:
        if names.get(types[field.name], types[field.name]) != field.dataType.simpleString():
            return f"type of {field.name}: {types[field.name]} != {field.dataType.simpleString()}"
    want, got = multiset(columns, result.fetchall()), multiset(frame.columns, frame.collect())
    if want != got:
        only_sql, only_spark = list((want - got).items())[:3], list((got - want).items())[:3]
        return f"{sum(want.values())} and {sum(got.values())} rows; only SQL {only_sql}; only Spark {only_spark}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        begun = time.time()
        problem = compare(spark, con, name, sf_dir)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - begun:6.1f}s  {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
