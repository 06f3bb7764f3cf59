"""Marks in the plan that keep the optimizer from copying costly expressions into filters and projections."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(frame: DataFrame) -> DataFrame:
    """The same rows, behind a row count that Spark observes on the way (see ``DataFrame.observe``).

    Without it, a filter on a normalized column is pushed down to the raw one: every mention of the column becomes a
    copy of its whole expression, regexes and all, and costs a run of them per copy. It also ends a stretch of generated
    code, which the JVM compiles only up to 8,000 bytes a method and interprets, several times slower, beyond.
    Unused columns are still pruned across it, and nothing is shuffled or stored.
    """
    return frame.observe(f"rows-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def bound(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows, with the named columns evaluated once, whatever reads them; they come last.

    A let-binding: unpivoting one set of columns is a projection whose results are new columns to the optimizer. Filters
    on a bound column stay behind it instead of repeating its expression; filters on other columns still pass to the
    scan, and columns that nobody reads are still pruned. A null cell stays a row. The names must be plain identifiers.
    """
    values = ", ".join(names)
    if len(names) > 1:
        values = f"({values})"
    return frame.sparkSession.sql(
        f"SELECT * EXCEPT (__bound) FROM {{frame}} UNPIVOT INCLUDE NULLS ({values} FOR __bound IN ({values} AS `row`))",
        frame=frame,
    )
