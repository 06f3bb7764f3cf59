"""The shared folder for tables a job writes only to read them back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_MADE: ContextVar[list[str] | None] = ContextVar("scratch paths of the innermost scope", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Executors must all reach it, so a machine-local folder is made up only for a local master.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing else writes to it."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to a scratch path and read back: run once, pruned by column, of known size."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end or after a failure, every scratch path made inside."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """What ``build`` gives as a scratch table, and its path; what was staged on the way there is removed."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        frame = build()
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path
