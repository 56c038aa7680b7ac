"""Writer jobs by a stream: equal to the batch query after each batch, after a restart and after a lost driver."""

import json
import pathlib

from concord.sources import commit_log
from concord.streaming import lineage, lineage_stream, run_lineage
from conftest import rows


def _commit(root, table, version, *jobs):
    log = pathlib.Path(root, table, "_delta_log")
    log.mkdir(parents=True, exist_ok=True)
    actions = [{"commitInfo": {"timestamp": 1, "operation": "WRITE", "job": {"jobName": j}} if j else {"operation": "WRITE"}} for j in jobs]
    lines = [json.dumps(a) for a in [*actions, {"add": {"path": "x"}}]]
    (log / f"{version:020d}.json").write_text("\n".join(lines))


def _batch(spark, root, tables):
    commits = commit_log.read_commits(spark, [f"{root}/{t}" for t in tables])
    return rows(commit_log.writer_jobs(commits))


def test_equal_to_the_batch_query_after_each_batch(spark, tmp_path):
    root, out = str(tmp_path / "a lake"), str(tmp_path / "report")
    _commit(root, "t1", 0, "load_a", None, "Cloud Migration")
    _commit(root, "t2", 0, "load_a", "load_b")
    run_lineage(spark, f"{root}/*", out)
    assert rows(lineage(spark, out)) == _batch(spark, root, ["t1", "t2"]) != []
    _commit(root, "t1", 1, "load_a")  # known
    _commit(root, "t1", 2, "load_c")
    _commit(root, "t3", 0, "load_a")  # a table that was not there before
    pathlib.Path(root, "t3", "_delta_log", "_last_checkpoint").write_text("{}")
    pathlib.Path(root, "t3", "_delta_log", f"{1:020d}.json").write_text("no json\n")
    run_lineage(spark, f"{root}/*", out)
    assert rows(lineage(spark, out)) == _batch(spark, root, ["t1", "t2", "t3"])
    before = rows(lineage(spark, out))
    run_lineage(spark, f"{root}/*", out)  # a restart without new commits
    assert rows(lineage(spark, out)) == before


def test_a_batch_whose_driver_was_lost_is_reported_once(spark, tmp_path):
    root, out = str(tmp_path / "lake"), str(tmp_path / "report")
    for v in range(4):
        _commit(root, "t", v, f"job_{v % 2}", f"own_{v}")
    run_lineage(spark, f"{root}/*", out, files_per_batch=1)
    # the last batch was written but its end not noted: it runs again
    last = max((tmp_path / "report.checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run_lineage(spark, f"{root}/*", out)
    assert rows(lineage(spark, out)) == _batch(spark, root, ["t"])


def test_state_is_one_entry_per_table_and_job(spark, tmp_path):
    root = str(tmp_path / "lake")
    for v in range(6):
        _commit(root, "t", v, "a", "b", "a")
    query = (
        lineage_stream(spark, f"{root}/*").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert max(states) == 2
