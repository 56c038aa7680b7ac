"""The path-level runner: resolution of each path, listings, ledgers of text, slow pairs, errors in full."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from concord import CURRENT_HISTORY, FINAL, reconcile
from concord.plans import reconcile as runner
from concord.plans.verdict import pair_verdicts
from concord.sources import commit_log, layout, ledger
from concord.sources.manifest import manifest_frame
from concord.sources.tables import DELTA, detect_format, first_partition_column


def _days(spark, path, days, column="load_date", extra=0):
    for k, d in enumerate(days):
        spark.range(k + 1 + extra).write.parquet(f"{path}/{column}={d}")


def _history(spark, **paths):
    row = {"env": "prod", "dag_id": "t_daily", "gen1_hist_path": paths["old"], "gen2_hist_path": paths["new"], "gen1_path": paths["old"], "gen2_path": paths["new"]}
    return {scope: frame.first().asDict() for scope, frame, _ in pair_verdicts(spark, row, CURRENT_HISTORY, history=True)}


def test_each_path_is_resolved_by_itself(spark, tmp_path):
    root = str(tmp_path)
    spark.range(2).write.parquet(f"{root}/flat")
    _days(spark, f"{root}/part", ["2024-01-01", "2024-01-02"])
    _days(spark, f"{root}/other", ["2024-01-02"], column="day", extra=1)
    # old side whole, new side at its last partition, and the other way round, and two column names
    for old, new in ((f"{root}/flat", f"{root}/part"), (f"{root}/part", f"{root}/flat"), (f"{root}/part", f"{root}/other")):
        got = _history(spark, old=old, new=new)
        cur, hist = got["current"], got["history"]
        assert (cur["gen1_count"], cur["gen2_count"], cur["except_validation"]) == (2, 2, "Passed"), (old, new)
        assert hist["except_validation"] == ("Passed" if "part" in old else "NA")
        assert cur["files_validation"] == cur["schema_validation"] == "Passed"


def test_directories_of_no_date_are_ignored(spark, tmp_path):
    root = str(tmp_path)
    for side in ("a", "b"):
        _days(spark, f"{root}/{side}", ["2024-01-02", "2024-01-01", "zzz", "tmp", layout.HIVE_NULL])
    got = _history(spark, old=f"{root}/a", new=f"{root}/b")["current"]
    assert (got["gen1_partition"], got["gen1_count"], got["except_validation"]) == ("2024-01-02", 1, "Passed")
    only = str(tmp_path / "none")
    _days(spark, only, ["zzz"])
    assert layout.root_latest(spark, only) is None


def test_history_path_that_is_a_partition_directory_is_compared(spark, tmp_path):
    root = str(tmp_path)
    _days(spark, f"{root}/a", ["2024-01-01"])
    got = _history(spark, old=f"{root}/a/load_date=2024-01-01", new=f"{root}/a/load_date=2024-01-01")
    assert got["history"]["except_validation"] == "Passed"


def test_latest_by_value_types(spark, tmp_path):
    def latest(*texts):
        frame = layout.local(spark, "/t", [f"p={t}" for t in texts], column="P")
        return layout.latest_by_column(frame).first()

    assert latest("9", "10", layout.HIVE_NULL)["latest_text"] == "10" and latest("1.5", "11")["latest_text"] == "11"
    assert latest("2024-01-09", "2023-12-31")["latest_text"] == "2024-01-09" and latest("b", "10", "9")["latest_text"] == "b"
    assert latest("2023_12", "2024_1")["latest_text"] == "2024_1" and latest("01", "1", "0")["latest_names"] == ["p=01", "p=1"]
    assert latest("nan", "5")["kind"] == "text" and latest("1_0.5", "2")["latest_text"] == "2"
    assert latest("2024-1-5", "2024-01-02")["latest_text"] == "2024-1-5"
    assert latest(layout.HIVE_NULL)["latest_names"] is None and latest()["kind"] is None
    names = tmp_path / "odd"
    for n in ("p=a,b", "p=c", "_tmp=1", "x.parquet"):
        (names / n).mkdir(parents=True)
    assert layout.child_names(spark, str(names)) == ["_tmp=1", "p=a,b", "p=c", "x.parquet"]
    assert [p["text"] for p in layout.parts_of(layout.child_names(spark, str(names)))] == ["a,b", "c"]
    assert layout.child_names(spark, str(tmp_path / "gone")) is None and not layout.has_data_file(spark, str(tmp_path / "gone"))
    (tmp_path / "empty").mkdir()
    assert layout.child_names(spark, str(tmp_path / "empty")) == []


def test_no_job_before_the_compare(spark, tmp_path):
    root = str(tmp_path)
    for side in ("lake1", "lake2"):
        _days(spark, f"{root}/{side}/t", ["2024-01-01", "2024-01-02"])
    row = {"env": "prod", "dag_id": "t_daily", "gen1_path": f"{root}/lake1/t", "gen2_path": f"{root}/lake2/t"}
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        assert detect_format(spark, row["gen1_path"]) == "parquet" and first_partition_column(spark, row["gen1_path"], "parquet") == "load_date"
        assert layout.has_data_file(spark, row["gen1_path"])
        assert not sc.statusTracker().getJobIdsForGroup("listing")
        pair_verdicts(spark, row, FINAL)
        # the Parquet reader opens one footer for each side's schema; nothing else runs
        assert len(sc.statusTracker().getJobIdsForGroup("listing")) <= 3
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


TEXT = "env string, dag_id string, gen1_path string, gen2_path string, gen1_count string, gen2_count string, gen1_except_gen2 string, gen2_except_gen1 string, except_validation string"


def test_ledgers_with_counts_as_text(spark, tmp_path):
    path = str(tmp_path / "ledger")
    old = spark.createDataFrame([("prod", "a_daily", "/l1/a", "/l2/a", "12", "n/a", "0", "0", "Failed")], TEXT)
    old.withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp")).write.parquet(path)
    assert [(r.gen1_count, r.gen2_count) for r in ledger.read(spark, path).collect()] == [(12, None)]
    spark.range(3).write.parquet(f"{tmp_path}/t")
    manifest = manifest_frame(spark, [("prod", "t_daily", f"{tmp_path}/t", f"{tmp_path}/t")])
    got = reconcile(spark, manifest, FINAL, ledger_path=path, resume_on="2024-01-01").collect()
    assert [(r.gen1_count, r.except_validation) for r in got] == [(3, "Passed")]  # the mixed directory is read back
    assert ledger.read(spark, path).schema["gen1_count"].dataType.simpleString() == "bigint" and ledger.read(spark, path).count() == 2


def test_an_unreadable_ledger_raises(spark, tmp_path):
    path = tmp_path / "ledger"
    path.mkdir()
    assert ledger.read_if_any(spark, str(path)) is None
    (path / "part-0.parquet").write_text("no parquet")
    manifest = manifest_frame(spark, [("prod", "t_daily", "/gone1", "/gone2")])
    with pytest.raises(Exception, match="(?i)parquet"):
        reconcile(spark, manifest, FINAL, ledger_path=str(path), resume_on="2024-01-01")


def test_a_slow_pair_holds_back_no_other(spark, tmp_path, monkeypatch):
    done, release = [], threading.Event()

    def slow_first(spark_, row, profile, history, found):
        if row["dag_id"] == "0":
            assert release.wait(60)
        else:
            done.append(row["dag_id"])
            if len(done) == 12:
                release.set()  # all others have run while the first is still open
        return [runner._error_row(row, "x\ny" * 3000, "current")]

    monkeypatch.setattr(runner, "check_pair", slow_first)
    manifest = manifest_frame(spark, [("prod", str(k), "/a", "/b") for k in range(13)])
    got = reconcile(spark, manifest.coalesce(1), FINAL, ledger_path=str(tmp_path / "l"), concurrency=2, batch_size=3).collect()
    assert len(got) == 13 and {len(r.error_msg) for r in got} == {9000}  # the whole message is kept


def test_partition_columns_after_log_clean_up(spark, tmp_path):
    log = tmp_path / "t" / "_delta_log"
    log.mkdir(parents=True)
    row = [(dt.date.today().isoformat(), ["load_date", "region"])]
    frame = spark.createDataFrame(row, "x string, cols array<string>").select(F.struct(F.col("cols").alias("partitionColumns")).alias("metaData"))
    frame.coalesce(1).write.parquet(str(tmp_path / "cp"))
    part = next((tmp_path / "cp").glob("part-*.parquet"))
    (log / "00000000000000000010.checkpoint.parquet").write_bytes(part.read_bytes())
    t = str(tmp_path / "t")
    assert detect_format(spark, t) == DELTA and commit_log.partition_columns(spark, t) == ["load_date", "region"]
    (log / "00000000000000000011.json").write_text(json.dumps({"commitInfo": {"timestamp": 1}}) + "\n")
    assert first_partition_column(spark, t, DELTA) == "load_date"
    (log / "00000000000000000012.json").write_text(json.dumps({"metaData": {"partitionColumns": ["day"]}}) + "\n")
    assert first_partition_column(spark, t, DELTA) == "day"
