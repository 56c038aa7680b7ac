"""concord — reconcile tables at scale with Spark DataFrame plans.

Given pairs of tables (an old platform's copy and a new one), concord checks
schema drift against a baseline, file presence, row counts, distinct counts
and exact multiset equality, writes one verdict row per pair into an
append-only ledger, and answers ledger queries (next manifest, resume,
failure report, retries).

Layout:
    operators/  alignment, the fused compare, schema diff, latest partition
    sources/    table loading, file listings, commit logs, manifests, ledger
    functions/  column expressions over paths and job ids
    plans/      verdict assembly, the reconcile runner, sweep queries
    streaming/  the failure report as an incremental query over the ledger
"""

from concord.operators.align import AlignmentError, align, drop_columns
from concord.operators.compare import (
    compare,
    diff_counts,
    diff_rows,
    distinct_count_check,
    row_count_check,
)
from concord.operators.partition import latest_partition
from concord.operators.schema import schema_check, schema_diff, schema_frame
from concord.plans.profiles import CURRENT_HISTORY, FINAL, PHASE2, PHASE4, Profile
from concord.plans.reconcile import reconcile

__all__ = [
    "CURRENT_HISTORY",
    "FINAL",
    "PHASE2",
    "PHASE4",
    "AlignmentError",
    "Profile",
    "reconcile",
    "align",
    "compare",
    "diff_counts",
    "diff_rows",
    "distinct_count_check",
    "drop_columns",
    "latest_partition",
    "row_count_check",
    "schema_check",
    "schema_diff",
    "schema_frame",
]
