import pytest
from pyspark.sql import functions as F

from concord.functions import baseline_path, normalize_job_id, table_name
from concord.plans import sweep
from concord.sources.ledger import typed_counts
from conftest import rows

# Literal ledgers of FIXTURES.md §3 (values are test inputs, not registered queries).
LEDGER1 = [
    ("prod", "sales_daily", "/lake1/sales", "/lake2/sales", 10, 10),
    ("prod", "sales_daily_b_daily", "/lake1/sales", "/lake2/sales", 10, 10),
    ("prod", "stock_weekly", "/lake1/stock", "/lake2/stock", 7, 7),
    ("prod", "x_monthly_weekly", "/lake1/x", "/lake2/x", 7, 7),
    ("prod", "foodaily", "/lake1/food", "/lake2/food", 3, 3),
    ("prod", "late_daily_2", "/lake1/late", "/lake2/late", 5, 5),
    ("prod", "clicks_streaming_daily", "/lake1/clicks", "/lake2/clicks", 5, 5),
    ("prod", "empty_daily", "/lake1/empty", "/lake2/empty", 0, 0),
    ("prod", "t_daily", "/lake1_test/t", "/lake2/t", 5, 5),
    ("prod", "rep_monthly", "/lake1/rep", "/lake2/rep", 5, 5),
]
LEDGER2 = [
    ("prod", "sales_daily", "/lake1/sales", "/lake2/sales", 10, 10),
    ("dev", "devonly_daily", "/lake1/devonly", "/lake2/devonly", 10, 10),
    ("prod", "ads_daily", "/lake1/ads", "/lake2/ads", 4, 4),
]
SCHEMA = "env string, dag_id string, gen1_path string, gen2_path string, gen1_count bigint, gen2_count bigint"
RESULTS = [
    ("/lake2/sales", "Passed", 10, 0, 0, "2024-01-02 03:00:00"),
    ("/lake2/stock", "Failed", 7, 2, 2, "2024-01-02 04:00:00"),
    ("/lake2/ads", "Failed", 4, 3, 1, "2024-01-01 04:00:00"),
    ("/lake2/gone", "Failed", 0, -1, -1, "2024-01-02 05:00:00"),
    (None, "Failed", 1, 1, 1, "2024-01-02 06:00:00"),
]


@pytest.fixture
def ledgers(spark):
    l1 = spark.createDataFrame(LEDGER1, SCHEMA)
    l2 = spark.createDataFrame(LEDGER2, SCHEMA)
    res = spark.createDataFrame(
        RESULTS, "gen2_path string, except_validation string, gen1_count bigint, "
        "gen1_except_gen2 bigint, gen2_except_gen1 bigint, ts string",
    ).withColumn("ts", F.to_timestamp("ts")).withColumn("dag_id", F.lit("d")).withColumn("gen1_path", F.lit("p"))
    return l1, l2, res


def _ids(df):
    return sorted(r["dag_id"] for r in df.collect())


def test_sweep_corrected_and_literal(ledgers):
    l1, l2, _ = ledgers
    assert _ids(sweep.sweep_manifest(l1, l2)) == [
        "ads_daily", "foodaily_daily", "sales_daily", "stock_weekly", "x_monthly_weekly"]
    assert _ids(sweep.sweep_manifest(l1, l2, rules="literal")) == [
        "ads_daily", "foodaily_daily", "sales_daily", "stock_weekly_weekly", "x_weekly"]


def test_resume_ignores_null_paths(ledgers):
    l1, l2, res = ledgers
    m = sweep.sweep_manifest(l1, l2)
    assert _ids(sweep.resume_manifest(m, res, "2024-01-02")) == ["ads_daily", "foodaily_daily", "x_monthly_weekly"]


def test_failure_and_drift_reports(ledgers):
    *_, res = ledgers
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted([tuple(r) for r in sweep.failure_report(res).collect()], key=key) == [
        ("/lake2/ads",), ("/lake2/stock",), (None,)]
    assert sorted([tuple(r) for r in sweep.value_drift_report(res).collect()], key=key) == [
        ("/lake2/stock",), (None,)]
    assert sweep.retry_manifest(res).count() == 4  # one per failed gen2_path (NULL included)


def test_job_id_rules(spark):
    df = spark.createDataFrame(
        [("a_weekly",), ("x_monthly_weekly",), ("foodaily",), ("a_daily_weekly",), ("plain",)], "d string")
    got = rows(df.select("d", normalize_job_id("d").alias("c"), normalize_job_id("d", "literal").alias("l")))
    assert got == sorted([
        ("a_daily_weekly", "a_daily", "a_daily"),
        ("a_weekly", "a_weekly", "a_weekly_weekly"),
        ("foodaily", "foodaily_daily", "foodaily_daily"),
        ("plain", "plain", "plain"),
        ("x_monthly_weekly", "x_monthly_weekly", "x_weekly"),
    ], key=repr)


def test_baseline_path_and_table_name(spark):
    m = spark.createDataFrame(
        [("dev", "/lk_test/priority2/123/a"), ("prod", "/lk_test/a"), ("prod", "/lk/b")], "env string, gen1_path string")
    got = [r[0] for r in m.select(baseline_path("env", "gen1_path")).collect()]
    assert got == ["/lk/a", "/lk/a", "/lk/b"]
    assert [r[0] for r in m.select(table_name("gen1_path")).collect()] == ["a", "a", "b"]
    slashes = spark.createDataFrame([("/lake/db/orders/",), ("/lake//db/x",), ("y",)], "p string")
    assert [r[0] for r in slashes.select(table_name("p")).collect()] == ["orders", "x", "y"]


def test_typed_counts_for_text_ledgers(spark):
    old = spark.createDataFrame([("10", "x"), ("abc", "y")], "gen1_count string, dag_id string")
    assert [r[0] for r in typed_counts(old).collect()] == [10, None]
