"""Physical-plan facts of every registered query of the catalogue, as a markdown table.

    python scripts/plan_report.py [sf_dir] > PLANS_TABLE.md

Counts come from ``explain("formatted")`` of each query before execution
(adaptive execution may later turn a shuffle join into a broadcast on
measured sizes): hash shuffles, single-partition merges, explicit-count
repartitions, broadcasts, file scans and scans with pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from concord.plans import workload  # noqa: E402
from concord.session import local_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def facts(p: str) -> dict:
    args = re.findall(r"Arguments: (hashpartitioning|SinglePartition|HashedRelationBroadcastMode|RoundRobinPartitioning)[^\n]*", p)
    by_num = len(re.findall(r"REPARTITION_BY_NUM", p))
    return {
        "hash": args.count("hashpartitioning") - by_num,
        "single": args.count("SinglePartition"),
        "spread": by_num,
        "broadcast": args.count("HashedRelationBroadcastMode"),
        "scans": len(re.findall(r"\(\d+\) Scan parquet", p)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", p)),
        "partial": len(re.findall(r"partial_", p)) > 0,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("| query | hash shuffles | single-partition merges | spread repartitions | broadcasts | parquet scans | scans with pushed filters | map-side partial aggregation |")
    print("|---|---:|---:|---:|---:|---:|---:|---|")
    for name, fn in workload.QUERIES.items():
        try:
            f = facts(plan_text(fn(spark, sf)))
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {str(e).splitlines()[0][:80]} |")
            continue
        print(f"| {name} | {f['hash']} | {f['single']} | {f['spread']} | {f['broadcast']} | {f['scans']} | {f['pushed']} | {'yes' if f['partial'] else 'no'} |")


if __name__ == "__main__":
    main()
