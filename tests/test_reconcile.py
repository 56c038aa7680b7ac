import datetime as dt

from pyspark.sql import functions as F

from concord.plans.profiles import CURRENT_HISTORY, FINAL
from concord.plans.reconcile import reconcile
from concord.sources import ledger
from concord.sources.manifest import manifest_frame, parse_manifest_lines
from conftest import SF001


def _lake(spark, root):
    """old/new copies of orders partitioned by load_date, plus a test copy and a baseline."""
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    days = o.withColumn("load_date", F.when(F.col("o_orderkey") % 2 == 0, "2024-01-01").otherwise("2024-01-02"))
    days = days.withColumn("load_date", F.col("load_date").cast("date"))
    days.write.partitionBy("load_date").parquet(f"{root}/lake1/orders")
    days.write.partitionBy("load_date").parquet(f"{root}/lake1_test/orders")
    changed = days.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    changed.write.partitionBy("load_date").parquet(f"{root}/lake2/orders")
    # an unpartitioned pair with a different load timestamp: ignored audit column
    o.withColumn("load_timestamp", F.lit("a")).write.parquet(f"{root}/lake1/cust")
    o.withColumn("load_timestamp", F.lit("b")).write.parquet(f"{root}/lake2/cust")
    # a pair that fails at run time: column sets differ
    o.write.parquet(f"{root}/lake1/bad")
    o.drop("o_orderpriority").write.parquet(f"{root}/lake2/bad")


def test_reconcile_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    _lake(spark, root)
    manifest = manifest_frame(spark, [
        ("prod", "orders_daily", f"{root}/lake1/orders", f"{root}/lake2/orders"),
        ("prod", "orders_test_daily", f"{root}/lake1_test/orders", f"{root}/lake2/orders"),
        ("prod", "cust_daily", f"{root}/lake1/cust", f"{root}/lake2/cust"),
        ("prod", "gone_daily", f"{root}/lake1/gone", f"{root}/lake2/gone"),
        ("prod", "bad_daily", f"{root}/lake1/bad", f"{root}/lake2/bad"),
    ])
    ledger_path = f"{root}/ledger"
    out = {r["dag_id"]: r.asDict() for r in reconcile(spark, manifest, FINAL, ledger_path=ledger_path, concurrency=3).collect()}
    o = out["orders_daily"]
    # latest partition (2024-01-02: odd keys) of each side; key 1 changed there
    assert o["gen1_partition"] == "2024-01-02" and o["gen2_partition"] == "2024-01-02"
    assert o["partition_validation"] == "Passed"
    assert out["cust_daily"]["partition_validation"] == "NA"
    assert o["gen1_count"] == o["gen2_count"] == 750
    assert (o["gen1_except_gen2"], o["gen2_except_gen1"], o["except_validation"]) == (1, 1, "Failed")
    assert o["schema_validation"] == "Passed" and o["files_validation"] == "Passed"
    assert o["source_job"] == "NA"
    # the _test copy is checked against its baseline (lake1/orders) for schema
    assert out["orders_test_daily"]["schema_validation"] == "Passed"
    assert out["cust_daily"]["except_validation"] == "Passed"
    for bad in ("gone_daily", "bad_daily"):
        e = out[bad]
        assert (e["gen1_count"], e["gen1_except_gen2"], e["except_validation"]) == (0, -1, "Failed")
        assert e["error_msg"]
    # ledger appended with ts, readable with mergeSchema
    led = ledger.read(spark, ledger_path)
    assert led.count() == 5 and "ts" in led.columns
    # resume: everything logged today is skipped
    again = reconcile(spark, manifest, FINAL, ledger_path=ledger_path, resume_on=dt.date.today().isoformat())
    assert again.count() == 0


def test_history_scope_na_when_unpartitioned(spark, tmp_path):
    root = str(tmp_path)
    _lake(spark, root)
    manifest = manifest_frame(spark, [
        ("prod", "orders_daily", f"{root}/lake1/orders", f"{root}/lake2/orders",
         f"{root}/lake1/cust", f"{root}/lake2/cust"),
    ], history=True)
    got = {r["scope"]: r.asDict() for r in reconcile(spark, manifest, CURRENT_HISTORY, history=True).collect()}
    cur, hist = got["current"], got["history"]
    assert cur["except_validation"] == "Failed" and cur["gen1_count"] == 750
    assert hist["except_validation"] == "NA" and hist["gen1_except_gen2"] == 0
    assert hist["count_validation"] == "Passed"


def test_ledger_merge_schema(spark, tmp_path):
    path = str(tmp_path / "ledger")
    old = spark.createDataFrame([("prod", "a", 1)], "env string, dag_id string, gen1_count bigint")
    old.withColumn("ts", F.current_timestamp()).write.parquet(path)
    new = spark.createDataFrame([("prod", "b", 2)], "env string, dag_id string, gen1_count bigint")
    ledger.append(new, path)
    led = ledger.read(spark, path)
    assert led.count() == 2 and "schema_diff" in led.columns


def test_manifest_lines(spark):
    lines = spark.createDataFrame([("prod,d,/a,/b",), ("no comma here",), ("dev,e, /c ,/d",)], "value string")
    got = [tuple(r) for r in parse_manifest_lines(lines).collect()]
    assert got == [("prod", "d", "/a", "/b"), ("dev", "e", " /c ", "/d")]


def test_side_lists_only_latest_partition(spark, tmp_path):
    from concord.plans.verdict import _by_column

    root = str(tmp_path)
    _lake(spark, root)
    side = _by_column(spark, f"{root}/lake1/orders", "parquet", "load_date")
    files = side.df.inputFiles()
    assert files and all("load_date=2024-01-02" in f for f in files)
    assert "load_date" in side.df.columns and side.df.count() == 750


def test_command_line_round_trip(spark):
    import pathlib
    import tempfile

    from concord.__main__ import main

    # the sweep drops every path containing "test", so no pytest tmp_path here
    root = tempfile.mkdtemp(prefix="concord-cli-")
    _lake(spark, root)
    pathlib.Path(root, "m.csv").write_text(
        f"prod,orders_daily,{root}/lake1/orders,{root}/lake2/orders\n"
        f"prod,cust_weekly,{root}/lake1/cust,{root}/lake2/cust\n"
        "a line without the separator\n"
    )
    led = f"{root}/ledger"
    assert main(["run", "--manifest", f"{root}/m.csv", "--ledger", led, "--concurrency", "2", "--method", "digest"]) == 0
    assert ledger.read(spark, led).count() == 2
    assert main(["failures", "--ledger", led, "--out", f"{root}/failed"]) == 0
    assert [r[0] for r in spark.read.csv(f"{root}/failed").collect()] == [f"{root}/lake2/orders"]
    assert main(["sweep", "--ledger", led, "--second-ledger", led, "--out", f"{root}/next"]) == 0
    assert main(["retry", "--ledger", led, "--out", f"{root}/retry"]) == 0
    assert [r[2] for r in spark.read.csv(f"{root}/retry").collect()] == [f"{root}/lake1/orders"]
    got = sorted(tuple(r) for r in spark.read.csv(f"{root}/next").collect())
    assert got == sorted([
        ("prod", "cust_weekly", f"{root}/lake1/cust", f"{root}/lake2/cust"),
        ("prod", "orders_daily", f"{root}/lake1/orders", f"{root}/lake2/orders"),
    ])


def test_runtime_cast_error_becomes_error_row(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, 10), (2, 20)], "k int, v int").write.parquet(f"{root}/lake1/num")
    spark.createDataFrame([(1, "10"), (2, "twenty")], "k int, v string").write.parquet(f"{root}/lake2/num")
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{root}/lake1/ok")
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{root}/lake2/ok")
    manifest = manifest_frame(spark, [
        ("prod", "num_daily", f"{root}/lake1/num", f"{root}/lake2/num"),
        ("prod", "ok_daily", f"{root}/lake1/ok", f"{root}/lake2/ok"),
    ])
    out = {r["dag_id"]: r.asDict() for r in reconcile(spark, manifest, FINAL, concurrency=1).collect()}
    bad = out["num_daily"]
    if bad["error_msg"]:  # ANSI on: 'twenty' cannot be read as a number
        assert (bad["gen1_except_gen2"], bad["except_validation"]) == (-1, "Failed")
    else:  # ANSI off: the value becomes NULL and the rows differ
        assert bad["except_validation"] == "Failed"
    assert out["ok_daily"]["except_validation"] == "Passed"


def test_baseline_rules_per_profile(spark, tmp_path):
    from concord.plans.verdict import pair_verdicts

    root = str(tmp_path)
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    o.write.parquet(f"{root}/lk_test/priority2/123/t")   # the dev copy
    o.write.parquet(f"{root}/lk/t")                       # baseline by the dev pattern
    o.withColumn("extra", F.lit(1)).write.parquet(f"{root}/lk/priority2/123/t")  # by the marker
    row = {"env": "dev", "dag_id": "t_daily", "gen1_path": f"{root}/lk_test/priority2/123/t",
           "gen2_path": f"{root}/lk_test/priority2/123/t",
           "gen1_hist_path": f"{root}/lk_test/priority2/123/t", "gen2_hist_path": f"{root}/lk_test/priority2/123/t"}
    final = pair_verdicts(spark, row, FINAL)[0][1].first()
    assert final["schema_validation"] == "Passed"          # compared with lk/t
    hist = pair_verdicts(spark, row, CURRENT_HISTORY)[0][1].first()
    assert hist["schema_validation"] == "Failed"           # compared with lk/priority2/123/t
    assert "extra" in hist["schema_diff"]


def test_lagging_partition_is_flagged(spark, tmp_path):
    root = str(tmp_path)
    o = spark.read.parquet(f"{SF001}/orders.parquet").withColumn("load_date", F.lit("2024-01-02").cast("date"))
    o.write.partitionBy("load_date").parquet(f"{root}/lake1/t")
    o.withColumn("load_date", F.lit("2024-01-01").cast("date")).write.partitionBy("load_date").parquet(f"{root}/lake2/t")
    manifest = manifest_frame(spark, [("prod", "t_daily", f"{root}/lake1/t", f"{root}/lake2/t")])
    r = reconcile(spark, manifest, FINAL).first()
    # load_date is an ignored audit column, so the data check passes on two different days
    assert r["except_validation"] == "Passed"
    assert (r["gen1_partition"], r["gen2_partition"], r["partition_validation"]) == ("2024-01-02", "2024-01-01", "Failed")


def test_whole_table_profile_without_file_check(spark, tmp_path):
    root = str(tmp_path)
    _lake(spark, root)
    profile = FINAL.with_(latest_partition=False, check_files=False)
    manifest = manifest_frame(spark, [("prod", "orders_daily", f"{root}/lake1/orders", f"{root}/lake2/orders")])
    r = reconcile(spark, manifest, profile).first()
    assert (r["gen1_count"], r["files_validation"], r["gen1_partition"]) == (1500, "NA", None)
    assert (r["gen1_except_gen2"], r["gen2_except_gen1"]) == (1, 1)


def test_lineage_on_failed_delta_pair(spark, tmp_path, monkeypatch):
    import json

    from concord.plans import reconcile as runner
    from concord.plans.verdict import verdict_frame

    gen2 = tmp_path / "lake2" / "t"
    (gen2 / "_delta_log").mkdir(parents=True)
    commits = [{"commitInfo": {"timestamp": 1, "job": {"jobName": "load_t"}}},
               {"commitInfo": {"timestamp": 2, "job": {"jobName": "Cloud Migration"}}}]
    for v, c in enumerate(commits):
        (gen2 / "_delta_log" / f"{v:020d}.json").write_text(json.dumps(c) + "\n")
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,)], "k int")

    def fake_pair_verdicts(spark_, row, profile, history, found=None):
        frame = verdict_frame(a, b, profile=profile, env=row["env"], dag_id=row["dag_id"],
                              gen1_path=row["gen1_path"], gen2_path=row["gen2_path"])
        return [("current", frame, "delta")]

    monkeypatch.setattr(runner, "pair_verdicts", fake_pair_verdicts)
    row = {"env": "prod", "dag_id": "t_daily", "gen1_path": str(tmp_path / "lake1" / "t"), "gen2_path": str(gen2)}
    (r,) = runner.check_pair(spark, row, FINAL)
    got = dict(zip(ledger.LEDGER_COLUMNS, r))
    assert got["except_validation"] == "Failed" and got["source_job"] == "[load_t]"
    (r,) = runner.check_pair(spark, row, FINAL.with_(lineage=False))
    assert dict(zip(ledger.LEDGER_COLUMNS, r))["source_job"] == "NA"


def test_read_manifest_file_with_history_fields(spark, tmp_path):
    from concord.sources.manifest import manifest_text, read_manifest

    p = tmp_path / "m.csv"
    p.write_text("prod,a_daily,/l1/a,/l2/a,/l1/a_hist,/l2/a_hist\nnot a manifest line\ndev,b_daily,/l1/b,/l2/b,,\n")
    m = read_manifest(spark, str(p), history=True)
    got = sorted(tuple(r) for r in m.collect())
    assert got == [("dev", "b_daily", "/l1/b", "/l2/b", "", ""),
                   ("prod", "a_daily", "/l1/a", "/l2/a", "/l1/a_hist", "/l2/a_hist")]
    assert sorted(r[0] for r in manifest_text(m).collect())[1] == "prod,a_daily,/l1/a,/l2/a,/l1/a_hist,/l2/a_hist"


def test_integer_partition_column(spark, tmp_path):
    root = str(tmp_path)
    o = spark.read.parquet(f"{SF001}/orders.parquet").withColumn("bucket", (F.col("o_orderkey") % 12).cast("int"))
    o.write.partitionBy("bucket").parquet(f"{root}/lake1/b")
    o.write.partitionBy("bucket").parquet(f"{root}/lake2/b")
    manifest = manifest_frame(spark, [("prod", "b_daily", f"{root}/lake1/b", f"{root}/lake2/b")])
    r = reconcile(spark, manifest, FINAL).first()
    # numeric maximum (11), not the text maximum ("9")
    assert (r["gen1_partition"], r["gen1_count"], r["except_validation"]) == ("11", 125, "Passed")
