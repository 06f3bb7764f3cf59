"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is built and run whole, its rows going to Spark's ``noop`` sink. All run once to warm up, then in three more
rounds, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortloom.plans.catalogue import FILES, QUERIES, bronze_lake  # noqa: E402
from cohortloom.plans.run import run_all  # noqa: E402

HEADLINE = (
    "flagship_summary",
    "harmonize_union",
    "rule_duplicate_sample_id",
    "normalize_text",
    "rule_counts",
    "validate_split",
    "diagnosis_counts",
    "bronze_scan_multiline",
)
RUNS = 3


def timed(actions: dict[str, Callable[[], object]]) -> dict[str, float]:
    seconds: dict[str, list[float]] = {name: [] for name in actions}
    for _ in range(RUNS + 1):
        for name, action in actions.items():
            begun = time.perf_counter()
            action()
            seconds[name].append(time.perf_counter() - begun)
    return {name: round(statistics.median(runs[1:]), 3) for name, runs in seconds.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Python call sites for error messages; they double the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    lake = bronze_lake(spark, sf_dir)
    actions: dict[str, Callable[[], object]] = {name: partial(run, name) for name in HEADLINE}
    actions["published_run"] = lambda: run_all(lake, FILES, run_id="bench")
    queries = timed(actions)
    spark.stop()

    result = {
        "metric": "total seconds, median of 3 warm runs per query",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
