"""Whole runs over a lake in a temporary folder."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from conftest import FILES, RAW, write_csv
from pyspark.sql import functions as F

from cohortloom import QualityGateError, SourceMapping, enforce_gate, run_all, run_study, validate
from cohortloom.plans.run import deliver
from cohortloom.schema import CANONICAL_COLUMNS, QUARANTINE_SCHEMA, SILVER_SCHEMA
from cohortloom.sources.lake import BRONZE, QUARANTINE, SILVER, Lake, exists
from cohortloom.sources.scratch import ensure_checkpoint_dir

MANIFEST_FIELDS = 13


def bronze(lake, name, **columns):
    write_csv(Path(lake.path(BRONZE, name)), columns)


def duplicates(**changes):
    columns = RAW["GSE33000"] | {"sample": ["X1", "X1", "X2"]} | changes
    return columns


def test_study_run(lake):
    frame, summary = run_study(lake, "GSE5281", FILES["GSE5281"])
    assert frame.count() == 4 and tuple(frame.columns) == CANONICAL_COLUMNS
    assert summary == "GSE5281: 7 mapped, 0 missing [], 0 source columns unused"
    bronze(lake, "z.csv", **(RAW["GSE5281"] | {"geo_accession": ["0012", "0013", "0014", "0015"]}))
    frame, _ = run_study(lake, "GSE5281", "z.csv")
    assert sorted(row.sample_id for row in frame.collect()) == ["0012", "0013", "0014", "0015"]


def test_study_run_with_another_mapping(lake):
    mapping = SourceMapping("OWN", {"sample_id": "subject", "rin": "no such"}, {"platform": "P"}, "notes")
    frame, summary = run_study(lake, "GSE5281", FILES["GSE5281"], mapping)
    assert sorted(row.sample_id for row in frame.collect()) == ["K10", "K7", "K8", "K9"]
    assert {(row.source_study, row.platform, row.sex) for row in frame.collect()} == {("OWN", "P", None)}
    assert summary == "OWN: 1 mapped, 1 missing ['no such'], 6 source columns unused"


def test_full_run(lake, spark):
    manifest = run_all(lake, FILES, run_id="0012")
    assert (manifest.rows_in, manifest.rows_clean, manifest.rows_quarantined) == (12, 12, 0)
    assert manifest.studies == sorted(FILES) and "run_id=0012" in manifest.silver_path
    assert manifest.quarantine_path is None and manifest.pass_rate == 1.0
    assert manifest.rule_counts["degraded_rna"] == 1 and sum(manifest.rule_counts.values()) == 1

    written = spark.read.parquet(manifest.silver_path)
    assert [(f.name, f.dataType) for f in written.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]
    assert {row.source_study for row in written.collect()} == set(FILES)
    assert {row.run_id for row in lake.read_silver().collect()} == {"0012"}
    assert lake.read_quarantine().count() == 0

    record = lake.read_manifests().first()
    stored = json.loads(record.manifest_json)
    assert record.run_id == "0012" and len(stored) == MANIFEST_FIELDS
    assert stored["source_paths"] == FILES and stored["quarantine_path"] is None
    assert "Safe Harbor" in stored["mapping_notes"]["GSE33000"]
    assert manifest.to_json() == json.dumps(json.loads(manifest.to_json()), indent=2, sort_keys=True)
    assert json.loads(manifest.to_json()) == stored


def test_quarantine_only_when_needed(lake, spark):
    bronze(lake, "dupes.csv", **duplicates())
    manifest = run_all(lake, {"GSE33000": "dupes.csv"}, run_id="r")
    assert (manifest.rows_clean, manifest.rows_quarantined) == (1, 2)
    rejected = spark.read.parquet(manifest.quarantine_path)
    assert [(f.name, f.dataType) for f in rejected.schema] == [(f.name, f.dataType) for f in QUARANTINE_SCHEMA]
    assert [row.quarantine_reason for row in rejected.collect()] == ["duplicate_sample_id"] * 2
    with pytest.raises(QualityGateError):
        enforce_gate(manifest)
    enforce_gate(manifest, 1 / 3)

    again = run_all(lake, {"GSE33000": FILES["GSE33000"]}, run_id="r")
    assert again.quarantine_path is None and not exists(spark, lake.run_path(QUARANTINE, "r"))
    enforce_gate(again)


def test_nothing_clean_still_writes_silver(lake, spark):
    bronze(lake, "bad.csv", **duplicates(sample=["", "NA", "-"]))
    manifest = run_all(lake, {"GSE33000": "bad.csv"}, run_id="bad")
    written = spark.read.parquet(manifest.silver_path)
    assert written.count() == 0 and written.columns == SILVER_SCHEMA.names


def test_run_without_sources(lake, spark):
    manifest = run_all(lake, {}, run_id="none")
    assert manifest.rows_in == 0 and manifest.pass_rate == 1.0
    assert set(manifest.rule_counts.values()) == {0}
    enforce_gate(manifest)
    assert spark.read.parquet(manifest.silver_path).columns == SILVER_SCHEMA.names


def test_unknown_study_writes_nothing(lake, spark):
    with pytest.raises(KeyError, match="Known studies"):
        run_all(lake, {"GSE0": "x.csv"}, run_id="x")
    assert not exists(spark, lake.path(SILVER))


def test_default_run_id(lake):
    assert len(run_all(lake, {"GSE5281": FILES["GSE5281"]}).run_id) == len("20240101T000000Z")


def test_listing(lake, spark, tmp_path):
    assert [row.path for row in lake.list_files(BRONZE).collect()] == sorted(FILES.values())
    assert [row.path for row in lake.list_files(BRONZE, "GSE5").collect()] == [FILES["GSE5281"]]
    assert Lake.at(spark, str(tmp_path / "no")).list_files(BRONZE).collect() == []
    run_all(lake, FILES, run_id="r")
    base = Path(lake.path(SILVER))
    here = [p for p in base.rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    rows = lake.list_files(SILVER).collect()
    assert [(r.path, r.length) for r in rows] == sorted((str(p.relative_to(base)), p.stat().st_size) for p in here)
    paths = [row.path for row in rows]
    assert {path.rsplit("/", 2)[0] for path in paths} == {"_manifests/run_id=r", "samples/run_id=r"}
    assert len(lake.list_files(SILVER, "samples/run").collect()) == sum(path.startswith("samples") for path in paths)


def test_hidden_names_are_listed_once(lake):
    base = Path(lake.path(BRONZE))
    for name in ("_a/x.txt", "_a/_b/y.txt", "_a/_b/.z", "c/_d/.e/f", "c/_g", ".h"):
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(name)
    here = sorted(str(p.relative_to(base)) for p in base.rglob("*") if p.is_file())
    assert [row.path for row in lake.list_files(BRONZE).collect()] == here


def test_hidden_names_at_any_depth(lake):
    base = Path(lake.path(BRONZE))
    deep = "/".join("abcdefghijkl")
    for name in (f"{deep}/seen.csv", f"{deep}/_hidden.csv", f"{deep}/m/n/_o/.p/q", "a/b/_c/" + deep + "/.z"):
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(name)
    here = sorted(str(p.relative_to(base)) for p in base.rglob("*") if p.is_file())
    assert [row.path for row in lake.list_files(BRONZE).collect()] == here
    below = [path for path in here if path.startswith("a/b/c/d")]
    assert [row.path for row in lake.list_files(BRONZE, "a/b/c/d").collect()] == below


def test_a_broken_run_leaves_the_earlier_one_whole(lake, spark, monkeypatch):
    """A run that dies between its two tables: readers still see both tables and the manifest of the one before."""
    bronze(lake, "dupes.csv", **duplicates())
    first = run_all(lake, {"GSE33000": "dupes.csv"}, run_id="r")
    before = [sorted(map(tuple, t.collect()), key=str) for t in (lake.read_silver(), lake.read_quarantine(), lake.read_manifests())]
    write, abandon = Lake.write_run, Lake.abandon_run

    def dies(self, frame, layer, *rest):
        if layer == QUARANTINE:
            raise OSError("no more disk")
        return write(self, frame, layer, *rest)

    monkeypatch.setattr(Lake, "write_run", dies)
    for clean in (abandon, lambda *_: None):  # also where the run could not even tidy up
        monkeypatch.setattr(Lake, "abandon_run", clean)
        with pytest.raises(OSError):
            run_all(lake, {"GSE33000": "dupes.csv", "GSE5281": FILES["GSE5281"]}, run_id="r")
        after = [sorted(map(tuple, t.collect()), key=str) for t in (lake.read_silver(), lake.read_quarantine(), lake.read_manifests())]
        assert after == before and exists(spark, first.silver_path)

    monkeypatch.setattr(Lake, "write_run", write)
    second = run_all(lake, {"GSE33000": "dupes.csv", "GSE5281": FILES["GSE5281"]}, run_id="r")
    assert lake.read_silver().count() == second.rows_clean == 5 and lake.read_quarantine().count() == 2
    assert json.loads(lake.read_manifests().first().manifest_json)["silver_path"] == second.silver_path
    left = {p.name for p in Path(lake.path(SILVER)).rglob("attempt=*")}
    assert left == {second.silver_path.rsplit("/", 1)[1]}, "earlier attempts are gone"


def test_runs_are_pruned(lake):
    for run in ("a", "b"):
        run_all(lake, {"GSE5281": FILES["GSE5281"]}, run_id=run)
    plan = lake.read_silver().where("run_id = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "(run_id" in plan.split("PartitionFilters", 1)[1].split("PushedFilters", 1)[0]
    assert lake.read_silver().where("run_id = 'a'").count() == 4


def test_account_paths(spark):
    lake = Lake.in_account(spark, "https://acct.dfs.core.windows.net/")
    assert lake.path(BRONZE, "a.csv") == "abfss://bronze@acct.dfs.core.windows.net/a.csv"


def scratch_names(spark) -> set[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    return {s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)}


def test_scratch_is_emptied(lake, spark, monkeypatch):
    bronze(lake, "lines.csv", **duplicates(tissue=["two\nlines", "one", "one"]))
    before = scratch_names(spark)
    run_all(lake, FILES | {"GSE33000": "lines.csv"}, run_id="tidy")
    assert scratch_names(spark) == before
    monkeypatch.setattr("cohortloom.plans.run.summarize", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_all(lake, FILES, run_id="broken")
    assert scratch_names(spark) == before


def test_deliveries_are_looked_at_side_by_side(lake, spark, monkeypatch):
    """More deliveries than run at once: all arrive, by study, and their scratch tables go."""
    waiting, most = [], []

    def slow(lake, study, path, crosswalk, multiline):
        waiting.append(study)
        time.sleep(0.2)
        most.append(len(waiting))
        waiting.remove(study)
        return deliver(lake, study, path, crosswalk, multiline)

    mappings = {f"S{k:02}": SourceMapping(f"S{k:02}", {"sample_id": "geo_accession"}, {}, "") for k in range(24)}
    monkeypatch.setattr("cohortloom.plans.run.deliver", slow)
    monkeypatch.setattr("cohortloom.plans.run.get_mapping", mappings.__getitem__)
    before = scratch_names(spark)
    manifest = run_all(lake, dict.fromkeys(mappings, FILES["GSE5281"]), run_id="many")
    assert manifest.studies == sorted(mappings) and manifest.rows_in == 24 * 4
    assert 8 <= max(most) <= 16 and scratch_names(spark) == before


def test_lost_counts_stop_the_run(lake, spark, monkeypatch):
    bronze(lake, "dupes.csv", **duplicates())
    first = run_all(lake, {"GSE33000": "dupes.csv"}, run_id="r")
    monkeypatch.setattr("cohortloom.plans.run.Observation.get", property(lambda self: {}))
    with pytest.raises(RuntimeError, match="3 rows staged, but none counted"):
        run_all(lake, {"GSE33000": "dupes.csv"}, run_id="r")
    assert spark.read.parquet(first.quarantine_path).count() == 2
    assert run_all(lake, {}, run_id="none").rows_in == 0


def test_counts_come_from_the_write(lake, spark):
    """The observed counts equal a plain count of what was published."""
    bronze(lake, "dupes.csv", **duplicates(braak=["9", "0", "I"], sample=["X1", "X2", "X3"]))
    manifest = run_all(lake, {"GSE33000": "dupes.csv", "GSE5281": FILES["GSE5281"]}, run_id="c")
    silver, rejected = lake.read_silver(), lake.read_quarantine()
    assert manifest.rows_clean == silver.count() and manifest.rows_quarantined == rejected.count()
    reasons = rejected.select(F.explode(F.split("quarantine_reason", ";")).alias("r")).groupBy("r").count()
    for row in reasons.collect():
        assert manifest.rule_counts[row.r] == row["count"]


def test_rules_are_counted_apart_from_the_write(lake, spark, monkeypatch):
    """One observed measure, whatever the number of rules; flags of rejected rows count, and so do rules nobody fails."""
    bronze(lake, "dupes.csv", **duplicates(braak=["9", "0", "I"], age_at_death=["", "", "70"]))
    kind, observed = type(spark.range(0)), []
    observe = kind.observe
    monkeypatch.setattr(kind, "observe", lambda self, at, *measures: observed.append(len(measures)) or observe(self, at, *measures))
    sources = {"GSE33000": "dupes.csv", "GSE5281": FILES["GSE5281"]}
    manifest = run_all(lake, sources, run_id="c")
    assert observed and observed[-1] == 1
    monkeypatch.undo()
    frames = [run_study(lake, study, path)[0] for study, path in sources.items()]
    plain = validate(frames[0].unionByName(frames[1]))
    assert manifest.rule_counts == plain.rule_counts and set(plain.rule_counts.values()) > {0}
    assert (manifest.rows_in, manifest.rows_quarantined) == (plain.total, plain.counts["rows_quarantined"])
    assert plain.quarantined.count() and manifest.rule_counts["missing_age"]


def test_job(lake, capsys):
    from cohortloom.__main__ import main

    root = lake.template.removesuffix("/{layer}")
    good = ["--root", root, "--study", f"GSE5281={FILES['GSE5281']}", "--run-id", "job"]
    assert main(good) == 0
    assert json.loads(capsys.readouterr().out)["run_id"] == "job"
    bronze(lake, "dupes.csv", **duplicates())
    bad = ["--root", root, "--study", "GSE33000=dupes.csv", "--one-line", "GSE33000"]
    assert main(bad) == 1
    assert main([*bad, "--min-pass-rate", "0.3"]) == 0
    for wrong in (["--root", root, "--study", "no-path"], ["--root", root, "--account-url", "x", "--study", "A=b"]):
        with pytest.raises(SystemExit):
            main(wrong)
