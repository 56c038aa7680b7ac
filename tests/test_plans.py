"""Physical-plan properties the design relies on, read from ``explain``."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from concord import compare, diff_rows, latest_partition, row_count_check
from concord.plans import workload
from conftest import SF001


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_fused_compare_is_one_data_shuffle(spark):
    o = workload.table(spark, SF001, "orders")
    p = plan(compare(o, workload.orders_b(o)))
    exchanges = re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition)", p)
    data = [e for e in exchanges if e.startswith("hashpartitioning")]
    assert len(data) == 1 and "o_totalprice" in data[0]  # one shuffle on the row values
    assert exchanges.count("SinglePartition") == 1       # and the one-row merge
    # partial aggregation before the data shuffle (map-side combine)
    assert re.search(r"partial_sum\(__concord_n1", p)


def test_row_count_reads_no_column(spark):
    o = workload.table(spark, SF001, "orders")
    p = plan(row_count_check(o, workload.orders_b(o)))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert "struct<>" in schemas
    assert all("o_totalprice" not in s for s in schemas)


def test_altered_copy_filters_reach_the_scan(spark):
    o = workload.table(spark, SF001, "orders")
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan(compare(o, workload.orders_b(o)))
    e = workload.table(spark, SF001, "events")
    assert "LessThan(ts," in plan(compare(e, workload.events_b(e)))


def test_latest_partition_prunes_files(spark, tmp_path):
    path = str(tmp_path / "p")
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("day", F.to_date("ts"))
    ev.write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path)
    p = plan(latest_partition(df, "day"))
    assert re.search(r"PartitionFilters: \[.*day.*subquery", p), p
    # the maximum over a partition column needs no data column
    assert "ReadSchema: struct<>" in p


def test_diff_rows_spreads_copies_by_hash(spark):
    o = workload.table(spark, SF001, "orders")
    p = plan(diff_rows(o, workload.orders_b(o)))
    assert re.search(r"hashpartitioning\(xxhash64\(", p)
    assert "RoundRobinPartitioning" not in p  # deterministic under task retries
    # an explicit count, so adaptive execution does not coalesce the few chunk rows into one task
    assert "REPARTITION_BY_NUM" in p


def test_grouped_compare_second_level_is_pre_aggregated(spark):
    e = workload.table(spark, SF001, "events").withColumn("day", F.to_date("ts"))
    p = plan(compare(e, workload.events_b(e), by="day"))
    # the per-day level runs partial sums before its shuffle on `day` alone
    assert re.search(r"hashpartitioning\(day#\d+, \d+\)", p)
    assert p.count("partial_sum(__concord_n1") >= 1


def test_hot_path_runs_in_whole_stage_codegen(spark):
    """Every operator of the compare and difference plans, scans aside, is in a codegen stage."""
    o = workload.table(spark, SF001, "orders")
    e = workload.table(spark, SF001, "embeddings")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan shows the stage boundaries
    try:
        for df in (compare(o, workload.orders_b(o)), diff_rows(o, workload.orders_b(o)),
                   compare(e, workload.embeddings_b(e), method="digest")):
            nodes = re.findall(r"^\((\d+)\) (\w+)( \[codegen id : \d+\])?", plan(df), re.M)
            outside = {n[1] for n in nodes if not n[2]} - {"Exchange", "Union", "Scan", "ColumnarToRow"}
            assert not outside, outside
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
