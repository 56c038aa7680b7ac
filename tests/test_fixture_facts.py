"""The vetted numbers of FIXTURES.md §4 (sf0.01), reproduced by the fused compare."""

from pyspark.sql import functions as F

from concord import compare, diff_counts, latest_partition
from concord.plans import workload
from conftest import SF01, one


def test_orders_pair(spark):
    o = workload.table(spark, SF01, "orders")
    r = one(compare(o, workload.orders_b(o)))
    assert (r["gen1_count"], r["gen2_count"]) == (15000, 14997)
    assert (r["gen1_distinct_count"], r["gen2_distinct_count"]) == (15000, 14854)
    assert (r["gen1_except_gen2"], r["gen2_except_gen1"]) == (299, 296)
    r = one(compare(o, workload.orders_b(o), ignore=["o_totalprice"]))
    assert (r["gen1_distinct_count"], r["gen2_distinct_count"]) == (15000, 14853)
    assert (r["gen1_except_gen2"], r["gen2_except_gen1"]) == (147, 144)


def test_lineitem_pairs(spark):
    li = workload.table(spark, SF01, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    r = one(diff_counts(li.select(*cols), workload.lineitem_b(li).select(*cols)))
    assert r["gen1_except_gen2"] == 588
    r = one(diff_counts(li.select("l_partkey", "l_suppkey"), li.select("l_suppkey", "l_partkey"), align_by="position"))
    assert r["gen1_except_gen2"] == 59338


def test_events_last_day(spark):
    e = workload.table(spark, SF01, "events")
    day = F.to_date("ts")
    a, b = latest_partition(e, day), latest_partition(workload.events_b(e), day)
    assert (a.count(), b.count()) == (329, 326)
    r = one(compare(a, b))
    assert (r["gen1_except_gen2"], r["gen2_except_gen1"]) == (329, 326)
    s = latest_partition(e.where(F.col("event_id") % 7 != 0), day)
    r = one(compare(a, s))
    assert (r["gen1_count"], r["gen2_count"], r["gen1_except_gen2"], r["gen2_except_gen1"]) == (329, 282, 47, 0)
