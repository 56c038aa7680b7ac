"""Supervised pairs: a pair that hangs, in Spark or outside, becomes an error row and the rest end."""

import threading
import time

from pyspark.sql import functions as F

from concord.plans import reconcile as runner
from concord.plans.profiles import PHASE2
from concord.plans.supervise import by_size, supervise
from concord.sources.manifest import manifest_frame
from conftest import SF001


def _manifest(spark, n=4):
    path = f"{SF001}/nation.parquet"
    return manifest_frame(spark, [("prod", f"d{i}_daily", path, path) for i in range(n)])


def _run(spark, monkeypatch, hang, deadline=8.0, **kw):
    real = runner.pair_verdicts

    def verdicts(session, row, *rest):
        frames = real(session, row, *rest)
        return hang(frames) if row["dag_id"] == "d1_daily" else frames

    monkeypatch.setattr(runner, "pair_verdicts", verdicts)
    begun = time.monotonic()
    got = {r["dag_id"]: r.asDict() for r in runner.reconcile(spark, _manifest(spark), PHASE2, deadline=deadline, **kw).collect()}
    return got, time.monotonic() - begun


def _check(got):
    assert sorted(got) == [f"d{i}_daily" for i in range(4)]
    assert {d: r["except_validation"] for d, r in got.items() if d != "d1_daily"} == {f"d{i}_daily": "Passed" for i in (0, 2, 3)}
    late = got["d1_daily"]
    assert (late["except_validation"], late["gen1_except_gen2"], late["error_msg"]) == ("Failed", -1, "not done within 8 seconds")


def test_a_pair_whose_job_hangs_is_cancelled(spark, monkeypatch):
    @F.udf("string")
    def slow(_):
        time.sleep(300)

    def hang(frames):
        return [(s, f.withColumn("env", slow("env")), fmt) for s, f, fmt in frames]

    got, took = _run(spark, monkeypatch, hang, concurrency=1)  # the pairs behind it still run
    _check(got)
    assert took < 100
    for _ in range(40):  # its task was killed, not left running
        if not spark.sparkContext.statusTracker().getActiveJobsIds():
            break
        time.sleep(0.5)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_a_pair_that_hangs_outside_spark_is_left_behind(spark, monkeypatch):
    gate = threading.Event()

    def hang(frames):
        gate.wait(300)
        return frames

    got, took = _run(spark, monkeypatch, hang, grace=1.0, concurrency=1)
    gate.set()
    _check(got)
    assert took < 100


def test_without_a_deadline_pairs_take_their_time(spark, monkeypatch):
    got, _ = _run(spark, monkeypatch, lambda frames: (time.sleep(1), frames)[1], deadline=None)
    assert {r["except_validation"] for r in got.values()} == {"Passed"}


def test_pools_by_size_and_tags(spark):
    pool_of = by_size("bytes", large=100)
    sc = spark.sparkContext

    def work(item):
        return item["n"], sc.getLocalProperty("spark.scheduler.pool"), len(sc.getJobTags())

    items = [{"n": 0, "bytes": 5}, {"n": 1, "bytes": 100}, {"n": 2}, {"n": 3, "bytes": None}]
    got = sorted(supervise(spark, items, work, late=None, width=2, pool_of=pool_of))
    assert got == [(0, "small", 1), (1, "large", 1), (2, "small", 1), (3, "small", 1)]
    assert not sc.getJobTags() and sc.getLocalProperty("spark.scheduler.pool") is None  # the caller's thread keeps its own


def test_at_most_width_items_are_taken_ahead(spark):
    taken, ended = [], []

    def items():
        for i in range(6):
            taken.append(i)
            assert len(taken) - len(ended) <= 2
            yield i

    for i in supervise(spark, items(), lambda i: i, late=None, width=2):
        ended.append(i)
    assert sorted(ended) == list(range(6))
