"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion through the ``noop`` sink (the whole result
is computed, nothing is written); the time reported is the best of
``BENCH_REPS`` runs (default 2) after one warm-up query. ``value`` is the sum
over the headline queries. ``reference_form`` times the same lineitem pair
checked the old way — six separate actions (2 counts, 2 distinct counts,
2 ``exceptAll`` counts) — for comparison with the fused compare; it is not
part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from concord.operators.compare import compare  # noqa: E402
from concord.plans import workload  # noqa: E402
from concord.plans.profiles import FINAL  # noqa: E402
from concord.plans.reconcile import reconcile  # noqa: E402
from concord.sources.manifest import manifest_frame  # noqa: E402
from concord.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "2"))


def q_compare_lineitem(spark, sf):
    li = workload.table(spark, sf, "lineitem")
    return compare(li, workload.lineitem_b(li))


HEADLINE = {
    "compare_fused": workload.q_compare_fused,
    "compare_lineitem": q_compare_lineitem,
    "compare_fused_two_lists": workload.q_compare_fused_two_lists,
    "diff_left_only": workload.q_diff_left_only,
    "compare_by_day": workload.q_compare_by_day,
    "compare_documents": workload.q_compare_documents,
    "compare_documents_digest": workload.q_compare_documents_digest,
    "diff_documents_digest": workload.q_diff_documents_digest,
    "compare_pages_digest": workload.q_compare_pages_digest,
    "compare_embeddings": workload.q_compare_embeddings,
    "compare_conversations_by_conv": workload.q_compare_conversations_by_conv,
    "latest_partition_compare": workload.q_latest_partition_compare,
    "schema_diff": workload.q_schema_diff,
    "latest_partition_path": workload.q_latest_partition_path,
    "order_ledger": workload.q_order_ledger,
    "sweep_manifest": workload.q_sweep_manifest,
    "resume_manifest": workload.q_resume_manifest,
    "failure_report": workload.q_failure_report,
    "writer_jobs": workload.q_writer_jobs,
    "pair_verdict": workload.q_pair_verdict,
    "reconcile_tables": workload.q_reconcile_tables,
    "pair_verdict_history": workload.q_pair_verdict_history,
}


def partitioned_pair(spark, sf):
    """events and its lagging copy written per day (setup, not timed); returns the two paths."""
    root = tempfile.mkdtemp(prefix="concord-bench-")
    ev = workload.table(spark, sf, "events").withColumn("load_date", F.to_date("ts"))
    ev.write.partitionBy("load_date").parquet(f"{root}/lake1/events")
    workload.events_b(ev).write.partitionBy("load_date").parquet(f"{root}/lake2/events")
    return f"{root}/lake1/events", f"{root}/lake2/events"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    best = float("inf")
    for _ in range(max(1, REPS)):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return best


def reference_form(spark, sf) -> None:
    li = workload.table(spark, sf, "lineitem")
    b = workload.lineitem_b(li)
    li.count()
    b.count()
    li.distinct().count()
    b.distinct().count()
    li.exceptAll(b).count()
    b.exceptAll(li).count()


def main() -> None:
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(CPUS))))
    spark = local_session(CPUS, shuffle_partitions=shuffle, app="concord-bench")
    run(workload.q_row_count_check(spark, SF_DIR))  # warm-up: JVM, file index, codegen
    times = {}
    for name, q in HEADLINE.items():
        times[name] = round(timed(lambda q=q: run(q(spark, SF_DIR))), 3)
    # path-level check of the latest day partition (listing-based, old partitions never read)
    p1, p2 = partitioned_pair(spark, SF_DIR)
    m = manifest_frame(spark, [("prod", "events_daily", p1, p2)])
    times["reconcile_latest_partition"] = round(timed(lambda: reconcile(spark, m, FINAL).collect()), 3)
    ref = round(timed(lambda: reference_form(spark, SF_DIR)), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": CPUS,
                "reference_form": {"lineitem_six_actions": ref, "lineitem_fused": times["compare_lineitem"]},
            }
        )
    )


if __name__ == "__main__":
    main()
