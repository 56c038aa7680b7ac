import json

from concord.sources import commit_log
from concord.sources.tables import DELTA, first_partition_column
from conftest import rows


def _log(path, commits):
    log = path / "_delta_log"
    log.mkdir(parents=True)
    for version, actions in enumerate(commits):
        text = "\n".join(json.dumps(a) for a in actions) + "\n"
        (log / f"{version:020d}.json").write_text(text)


def _fixture(tmp_path):
    t = tmp_path / "sales"
    _log(t, [
        [{"commitInfo": {"timestamp": 1, "operation": "WRITE", "job": {"jobName": "load_sales"}}},
         {"metaData": {"partitionColumns": ["region"]}}],
        [{"commitInfo": {"timestamp": 2, "operation": "WRITE", "job": {"jobName": "Cloud Migration"}}}],
        [{"commitInfo": {"timestamp": 3, "operation": "OPTIMIZE", "job": {"jobName": "Optimize_nzdata"}}}],
        [{"commitInfo": {"timestamp": 4, "operation": "WRITE", "job": {"jobName": "my spark task"}}}],
        [{"commitInfo": {"timestamp": 5, "operation": "WRITE"}}],
        [{"commitInfo": {"timestamp": 6, "operation": "WRITE", "job": {"jobName": "load_sales"}}},
         {"metaData": {"partitionColumns": ["load_date", "region"]}}],
        [{"commitInfo": {"timestamp": 7, "operation": "MERGE", "job": {"jobName": "fix_sales"}}}],
    ])
    u = tmp_path / "stock"
    _log(u, [[{"commitInfo": {"timestamp": 1, "operation": "WRITE", "job": {"jobName": "load_stock"}}}]])
    return str(t), str(u)


def test_writer_jobs_and_partition_columns(spark, tmp_path):
    t, u = _fixture(tmp_path)
    commits = commit_log.read_commits(spark, [t, u])
    got = rows(commit_log.writer_jobs(commits))
    assert got == [(t, "fix_sales"), (t, "load_sales"), (u, "load_stock")]
    assert commit_log.job_list(spark, t) == "[fix_sales, load_sales]"
    assert commit_log.partition_columns(spark, t) == ["load_date", "region"]
    assert first_partition_column(spark, t, DELTA) == "load_date"
    assert commit_log.partition_columns(spark, u) == []


def test_writer_jobs_many_keeps_seed(spark, tmp_path):
    t, u = _fixture(tmp_path)
    got = rows(commit_log.writer_jobs_many(commit_log.read_commits(spark, [t, u])))
    assert got == [("Cloud Migration",), ("fix_sales",), ("load_sales",), ("load_stock",)]
