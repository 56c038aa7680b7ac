import datetime as dt

from pyspark.sql import functions as F

from concord import latest_partition
from concord.sources import files, layout
from concord.sources.tables import PARQUET, detect_format, first_partition_column
from conftest import SF001, one


def _write_partitioned(spark, path, days=("2024-01-01", "2024-01-03", "2024-01-02")):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    parts = []
    for d in days:
        parts.append(ev.limit(50).withColumn("load_date", F.lit(d).cast("date")))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    df.write.mode("overwrite").partitionBy("load_date").parquet(path)


def test_latest_partition_scalar_subquery_and_listing(spark, tmp_path):
    path = str(tmp_path / "ev")
    _write_partitioned(spark, path)
    df = spark.read.parquet(path)
    assert first_partition_column(spark, path, PARQUET) == "load_date"
    by_subquery = latest_partition(df, "load_date")
    assert by_subquery.select("load_date").distinct().collect()[0][0] == dt.date(2024, 1, 3)
    assert layout.root_latest(spark, path, "load_date").text == "2024-01-03"
    assert latest_partition(df, "load_date", dt.date(2024, 1, 3)).count() == 50
    plan = latest_partition(df, "load_date", dt.date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan


def test_latest_partition_path_and_default_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    _write_partitioned(spark, path)
    # a non-date partition directory is ignored
    spark.range(3).write.parquet(path + "/load_date=__HIVE_DEFAULT_PARTITION__")
    assert files.latest_partition_path(spark, path).endswith("/t/load_date=2024-01-03")
    flat = str(tmp_path / "flat")
    spark.range(3).write.parquet(flat)
    assert files.latest_partition_path(spark, flat) == flat


def test_latest_partition_dirs_fixture(spark):
    listing = spark.createDataFrame(
        [("/w/t", "/w/t/load_date=2023-09-18/a.parquet"), ("/w/t", "/w/t/load_date=2023-10-02/b.parquet"),
         ("/w/t", "/w/t/load_date=__HIVE_DEFAULT_PARTITION__/c.parquet"), ("/w/u", "/w/u/x.parquet")],
        "root string, path string",
    )
    got = {r["root"]: r["partition_path"] for r in files.latest_partition_dirs(listing).collect()}
    assert got == {"/w/t": "/w/t/load_date=2023-10-02", "/w/u": "/w/u"}


def test_files_check(spark, tmp_path):
    path = str(tmp_path / "ev")
    _write_partitioned(spark, path)
    r = one(files.files_check(spark, path, f"{SF001}/orders.parquet"))
    assert r["files_validation"] == "Passed" and r["gen1_files"] >= 3
    r = one(files.files_check(spark, path, str(tmp_path / "missing")))
    assert r == {"gen1_files": r["gen1_files"], "gen2_files": 0, "files_validation": "Failed"}


def test_detect_format(spark, tmp_path):
    assert detect_format(spark, f"{SF001}/orders.parquet") == "parquet"
    d = tmp_path / "dt"
    (d / "_delta_log").mkdir(parents=True)
    (d / "_delta_log" / "00000000000000000000.json").write_text('{"commitInfo":{"timestamp":1}}\n')
    assert detect_format(spark, str(d)) == "delta"
