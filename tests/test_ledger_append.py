"""Ledger: idempotent append with a fault at every step, footer census, catalog table that grows, layout by day, log reduction."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from concord import PHASE2, reconcile
from concord.plans import sweep
from concord.sources import commit_log, layout, ledger
from concord.sources.ledger import LEDGER
from concord.sources.manifest import manifest_frame


def verdicts(spark, *names):
    cols = [f.name for f in LEDGER.fields]
    return spark.createDataFrame([tuple(n if c in ("dag_id", "gen2_path") else (1 if c == "gen1_count" else None) for c in cols) for n in names], LEDGER)


def logged(spark, path):
    found = ledger.read_if_any(spark, path)
    return [] if found is None else sorted(r["dag_id"] for r in found.collect())


@pytest.mark.parametrize("step", ["before staging", "after staging", "before the rename", "after the rename"])
def test_a_lost_driver_publishes_a_batch_once(spark, tmp_path, monkeypatch, step):
    path, batch = str(tmp_path / "l"), verdicts(spark, "a", "b")
    assert ledger.append(verdicts(spark, "z"), path, "run-0")
    publish, names = ledger._publish, layout.child_names

    def lost(*_):
        raise RuntimeError("lost")

    def then_lost(*args):
        publish(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "before staging":
            m.setattr(ledger, "conform", lost)
        elif step == "after staging":
            m.setattr(layout, "child_names", lost)
        else:
            m.setattr(ledger, "_publish", lost if step == "before the rename" else then_lost)
        with pytest.raises(RuntimeError, match="lost"):
            ledger.append(batch, path, "run-1")
    assert layout.child_names is names
    published = step == "after the rename"
    assert logged(spark, path) == (["a", "b", "z"] if published else ["z"])
    assert ledger.append(batch, path, "run-1") is not published
    assert logged(spark, path) == ["a", "b", "z"] and not ledger.append(batch, path, "run-1")
    assert ledger.append(batch, path) and logged(spark, path) == ["a", "a", "b", "b", "z"]  # another batch of its own


def test_batches_without_rows_and_names_of_any_kind(spark, tmp_path):
    path = str(tmp_path / "l")
    assert ledger.append(verdicts(spark, "a").limit(0), path, "none") and logged(spark, path) == []
    assert ledger.append(verdicts(spark, "a"), path, "../x y/é") and logged(spark, path) == ["a"]


def test_without_a_ledger_verdicts_lie_in_the_shared_folder(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    manifest = manifest_frame(spark, [("prod", f"t{k}", f"{tmp_path}/t", f"{tmp_path}/t") for k in range(5)])
    out = reconcile(spark, manifest, PHASE2, batch_size=2)
    assert len(out.inputFiles()) == 3 and {r["gen1_count"] for r in out.collect()} == {3}
    assert all("concord-run-" in f for f in out.inputFiles())


def test_census_groups_files_by_schema_in_one_job(spark, tmp_path):
    files = []
    for kind, expr in (("a", ["id as gen1_count"]), ("b", ["cast(id as string) as gen1_count"]), ("c", ["id as gen1_count", "'x' as more"])):
        spark.range(300).selectExpr(*expr).repartition(30).write.parquet(f"{tmp_path}/{kind}")
        files += [f for f in map(str, sorted((tmp_path / kind).glob("*.parquet")))]
    sc = spark.sparkContext
    sc.setJobGroup("census", "census")
    try:
        got = ledger.census(spark, files, per_task=10)
        assert len(sc.statusTracker().getJobIdsForGroup("census")) <= 4
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(len(g) for g in got) == [30, 30, 30] and all(len({f.split("/")[-2] for f in g}) == 1 for g in got)
    assert ledger.census(spark, []) == []


def test_catalog_ledger_grows(spark, tmp_path):
    name = "concord_ledger_test"
    spark.sql(f"drop table if exists {name}")
    try:
        ledger.append_table(verdicts(spark, "old"), name, f"{tmp_path}/table")
        ledger.append_table(verdicts(spark, "new").select("*", F.lit("g").alias("Reviewer"), F.lit(2).alias("score")), name)
        ledger.append_table(verdicts(spark, "last").select("dag_id", "gen1_count", F.lit("h").alias("reviewer")), name)
        rows = {r["dag_id"]: (r["gen1_count"], r["Reviewer"], r["score"]) for r in ledger.read_table(spark, name).collect()}
        assert rows == {"old": (1, None, None), "new": (1, "g", 2), "last": (1, "h", None)}
        assert all(r["ts"] is not None for r in ledger.read_table(spark, name).collect())
        assert spark.sql(f"describe extended {name}").where("col_name = 'Type'").first()["data_type"] == "EXTERNAL"
    finally:
        spark.sql(f"drop table if exists {name}")


def test_a_ledger_by_day_is_read_at_that_day(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1 + k % 4, 10)) for k in range(20)]
    led = spark.createDataFrame(rows, "k int, ts timestamp").select(F.col("k").cast("string").alias("gen2_path"), "ts")
    ledger.write_by_day(led, f"{tmp_path}/l")
    by_day = ledger.read(spark, f"{tmp_path}/l")
    done = sweep.checked_on(by_day, "2024-01-02")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ledger_day" in plan
    assert sorted(int(r[0]) for r in done.collect()) == [1, 5, 9, 13, 17]
    assert sorted(map(tuple, sweep.checked_on(led, "2024-01-02").collect())) == sorted(map(tuple, done.collect()))


def test_resume_scans(spark):
    from concord.plans import workload

    plan = workload.q_resume_manifest(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 9 and "PartitionFilters: [isnotnull(ledger_day" in plan


def _log(root, name, files):
    log = root / name / "_delta_log"
    log.mkdir(parents=True)
    for file, columns in files.items():
        (log / file).write_text("".join(json.dumps(a) + "\n" for a in ([{"metaData": {"partitionColumns": columns}}] if columns is not None else []) + [{"commitInfo": {"timestamp": 1}}]))
    return str(root / name)


def test_metadata_of_many_tables_by_one_reduction(spark, tmp_path):
    a = _log(tmp_path, "a[1]", {"00000000000000000009.json": ["x"], "00000000000000000010.json": ["y", "z"], "00000000000000000011.json": None})
    b = _log(tmp_path, "b", {"00000000000000000002.json": ["late"]})
    cp = spark.createDataFrame([(["kept"],)], "cols array<string>").select(F.struct(F.col("cols").alias("partitionColumns")).alias("metaData"))
    cp.coalesce(1).write.parquet(f"{tmp_path}/cp")
    part = next((tmp_path / "cp").glob("part-*.parquet")).read_bytes()
    for k in (1, 2):  # a checkpoint of two parts, newer than what is left of the commits
        (tmp_path / "b" / "_delta_log" / f"00000000000000000007.checkpoint.000000000{k}.0000000002.parquet").write_bytes(part)
    c = _log(tmp_path, "c", {"00000000000000000000.json": [" "]})
    d = _log(tmp_path, "d", {"00000000000000000000.json": []})
    e = _log(tmp_path, "e", {"00000000000000000000.json": None})
    paths = [a, b, c, d, e, str(tmp_path / "gone")]
    got = {r["table"].rsplit("/", 1)[1]: (r["version"], r["partition_columns"], r["first_partition_column"]) for r in commit_log.table_metadata(commit_log.read_logs(spark, paths)).collect()}
    assert got == {"a[1]": (10, ["y", "z"], "y"), "b": (7, ["kept"], "kept"), "c": (0, [" "], None), "d": (0, [], None)}
    assert [commit_log.partition_columns(spark, p) for p in paths] == [["y", "z"], ["kept"], [" "], [], [], []]
    assert commit_log.read_logs(spark, []).count() == 0
