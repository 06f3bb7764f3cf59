"""The layered lake: bronze deliveries in, silver and quarantine runs out, on any file system Spark can reach.

A run is published by its manifest. Every try at a run writes its tables to attempt folders of its own, which nobody reads
yet; the manifest, a single small file written last, names the attempt. Readers take, for each run, what the latest manifest
names. So a run that dies anywhere leaves the earlier one whole in all its tables, and no folder is ever renamed, which
object stores cannot do at once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.schema import MANIFEST_SCHEMA, QUARANTINE_SCHEMA, SILVER_SCHEMA
from cohortloom.sources.delimited import read_delimited
from cohortloom.sources.headers import delivered_headers

BRONZE = "bronze"
SILVER = "silver"
QUARANTINE = "quarantine"

SAMPLES = "samples"
MANIFESTS = "_manifests"

_RUN_ID = T.StructField("run_id", T.StringType())
_ATTEMPT = T.StructField("attempt", T.StringType())


@dataclass(frozen=True)
class Lake:
    """Where the layers lie. ``template`` holds ``{layer}``, e.g. ``s3a://lake/{layer}``."""

    spark: SparkSession
    template: str

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> Lake:
        """Layers as folders below a root URI."""
        return cls(spark, f"{str(root).rstrip('/')}/{{layer}}")

    @classmethod
    def in_account(cls, spark: SparkSession, account_url: str) -> Lake:
        """Layers as containers of an ADLS Gen2 account; credentials come from the cluster's Hadoop settings."""
        host = account_url.split("://", 1)[-1].rstrip("/")
        return cls(spark, f"abfss://{{layer}}@{host}")

    def path(self, layer: str, relative: str = "") -> str:
        base = self.template.format(layer=layer)
        return f"{base}/{relative}" if relative else base

    def run_path(self, layer: str, run_id: str, table: str = SAMPLES, attempt: str | None = None) -> str:
        run = self.path(layer, f"{table}/run_id={run_id}")
        return f"{run}/attempt={attempt}" if attempt else run

    def read_csv(self, layer: str, relative: str, multiline: bool | None = None) -> DataFrame:
        return read_delimited(self.spark, self.path(layer, relative), multiline)

    def headers(self, layer: str, sources: Mapping[str, str]) -> DataFrame:
        """``(study_id, column_name)`` of many deliveries, by one job."""
        return delivered_headers(self.spark, {study: self.path(layer, path) for study, path in sources.items()})

    def write_run(self, frame: DataFrame, layer: str, run_id: str, attempt: str, table: str = SAMPLES) -> str:
        """Write a table of one attempt at a run. Gives the location; readers see it once the manifest is written.

        The attempt's own folder is the target, not a ``partitionBy``: an empty table keeps its schema that way.
        """
        target = self.run_path(layer, run_id, table, attempt)
        # The manifest says what is complete; marker files would only have to be listed and skipped.
        frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
        return target

    def commit_run(self, run_id: str, attempt: str, manifest_json: str) -> None:
        """Publish an attempt, then remove those that started before it: it has taken their place."""
        record = self.spark.createDataFrame([(run_id, manifest_json)], MANIFEST_SCHEMA).coalesce(1)
        self.write_run(record, SILVER, run_id, attempt, MANIFESTS)
        for layer, table in ((SILVER, MANIFESTS), (SILVER, SAMPLES), (QUARANTINE, SAMPLES)):
            run = self.run_path(layer, run_id, table)
            tries = _names(self.spark, run)
            earlier = [name for name in tries if name < f"attempt={attempt}"]
            for name in earlier:
                remove(self.spark, f"{run}/{name}")
            if tries and len(earlier) == len(tries):
                remove(self.spark, run)

    def abandon_run(self, run_id: str, attempt: str) -> None:
        """Remove what an attempt wrote that will not be published."""
        for layer in (SILVER, QUARANTINE):
            remove(self.spark, self.run_path(layer, run_id, SAMPLES, attempt))

    def read_silver(self) -> DataFrame:
        return self._read_runs(SILVER, SILVER_SCHEMA)

    def read_quarantine(self) -> DataFrame:
        return self._read_runs(QUARANTINE, QUARANTINE_SCHEMA)

    def read_manifests(self) -> DataFrame:
        """The manifest of each run's latest attempt."""
        return self._committed().select(*MANIFEST_SCHEMA.names)

    def _read_runs(self, layer: str, schema: T.StructType) -> DataFrame:
        """All published runs of a table, pruned by ``run_id`` when filtered."""
        committed = self._committed().select("run_id", "attempt")
        rows = self._attempts(layer, SAMPLES, T.StructType([*schema.fields, _RUN_ID]))
        return rows.join(committed, ["run_id", "attempt"], "left_semi").select(*schema.names, "run_id")

    def _committed(self) -> DataFrame:
        attempts = self._attempts(SILVER, MANIFESTS, MANIFEST_SCHEMA)
        latest = attempts.groupBy("run_id").agg(F.max(F.struct("attempt", "manifest_json")).alias("latest"))
        return latest.select("run_id", "latest.manifest_json", "latest.attempt")

    def _attempts(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """A table with the attempt of each row. The given types keep run ids like ``0012`` text."""
        schema = T.StructType([*schema.fields, _ATTEMPT])
        path = self.path(layer, table)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def list_files(self, layer: str, prefix: str = "") -> DataFrame:
        """``(path, length, modified)`` of all of a layer's files, paths relative to it and sorted; empty if there is none.

        Spark lists what it shows in parallel. Names that start with an underscore or a dot, which it hides, are looked for
        level by level, as folders that are then listed in parallel too, or as files. The store's own count of files tells
        when none is missing, so the search goes as deep as it must and no deeper. Only the folder that ``prefix`` reaches
        into is searched.
        """
        folder = prefix.rpartition("/")[0]
        base = self.path(layer, folder)
        listing = self.spark.createDataFrame([], "path string, length bigint, modified timestamp")
        if not exists(self.spark, base):
            return listing
        root = qualified(self.spark, self.path(layer))
        system, top = _file_system(self.spark, _hadoop_path(self.spark, base)), _hadoop_path(self.spark, base)
        total = system.getContentSummary(top)
        shown = self._shown([base])
        missing = total.getFileCount() - shown.count()
        listing = listing.union(shown)
        # No level lies deeper than there are folders.
        for depth in range(total.getDirectoryCount() + 1):
            if missing <= 0:
                break
            folders, files = _hidden(self.spark, base, depth)
            if folders:
                shown = self._shown(folders)
                missing -= shown.count()
                listing = listing.union(shown)
            if files:
                missing -= len(files)
                hidden = self.spark.createDataFrame(files, "path string, length bigint, millis bigint")
                listing = listing.union(hidden.select("path", "length", F.timestamp_millis("millis")))
        return (
            listing.withColumn("path", F.expr(f"substring(path, {len(root) + 2})"))
            .where(F.col("path").startswith(prefix))
            .orderBy("path")
        )

    def _shown(self, roots: list[str]) -> DataFrame:
        """What Spark lists below some folders, each of them hidden or not."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
        return found.select("path", "length", F.col("modificationTime").alias("modified"))


def _hidden(spark: SparkSession, base: str, depth: int) -> tuple[list[str], list[tuple[str, int, int]]]:
    """Folders and files so many levels below a path whose own names Spark hides; few, as a lake has one or two kinds."""
    system = _file_system(spark, _hadoop_path(spark, base))
    folders, files = [], []
    for status in system.globStatus(_hadoop_path(spark, f"{base}/{'*/' * depth}[._]*")) or []:
        path = status.getPath().toString()
        if status.isDirectory():
            folders.append(path)
        else:
            files.append((path, status.getLen(), status.getModificationTime()))
    return folders, files


def _names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder."""
    target = _hadoop_path(spark, path)
    system = _file_system(spark, target)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target = _hadoop_path(spark, path)
    return _file_system(spark, target).exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's file sources report it, with scheme."""
    target = _hadoop_path(spark, path)
    return _file_system(spark, target).makeQualified(target).toString()


def remove(spark: SparkSession, path: str) -> None:
    target = _hadoop_path(spark, path)
    _file_system(spark, target).delete(target, True)
