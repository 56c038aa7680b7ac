from pyspark.sql import functions as F

from concord.sources import ledger
from concord.streaming import run_failure_report


def _verdicts(spark, rows):
    return spark.createDataFrame(
        rows, "gen2_path string, dag_id string, gen1_count bigint, gen1_except_gen2 bigint, "
        "gen2_except_gen1 bigint, except_validation string")


def test_incremental_failure_report(spark, tmp_path):
    led, out, ck = str(tmp_path / "ledger"), str(tmp_path / "report"), str(tmp_path / "ck")
    ledger.append(_verdicts(spark, [
        ("/l2/a", "a_daily", 5, 1, 0, "Failed"),
        ("/l2/b", "b_daily", 5, 0, 0, "Passed"),
        ("/l2/c", "c_daily", 0, -1, -1, "Failed"),
    ]), led)
    run_failure_report(spark, led, out, ck)
    assert sorted(r[0] for r in spark.read.parquet(out).select("gen2_path").collect()) == ["/l2/a"]
    ledger.append(_verdicts(spark, [
        ("/l2/a", "a_daily", 5, 1, 0, "Failed"),
        ("/l2/d", "d_daily", 3, 2, 2, "Failed"),
    ]), led)
    run_failure_report(spark, led, out, ck)
    got = sorted(r[0] for r in spark.read.parquet(out).select("gen2_path").collect())
    assert got == ["/l2/a", "/l2/d"]
    assert spark.read.parquet(out).where(F.col("gen2_path") == "/l2/a").count() == 1


def test_default_checkpoint_lies_beside_the_report(spark, tmp_path):
    led, out = str(tmp_path / "ledger"), str(tmp_path / "report")
    ledger.append(_verdicts(spark, [("/l2/x", "x_daily", 2, 1, 1, "Failed")]), led)
    run_failure_report(spark, led, out)
    assert (tmp_path / "report.checkpoint").is_dir()
    before = spark.conf.get("spark.checkpoint.dir", None)
    run_failure_report(spark, led, out)  # a later run, also of another process, repeats nothing
    assert spark.read.parquet(out).count() == 1 and spark.conf.get("spark.checkpoint.dir", None) == before
