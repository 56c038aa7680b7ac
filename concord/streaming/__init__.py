"""Incremental queries: the failure report over the ledger, writer jobs over commit logs."""

from concord.streaming.ledger_stream import failure_stream, run_failure_report
from concord.streaming.lineage_stream import lineage, lineage_stream, run_lineage

__all__ = ["failure_stream", "lineage", "lineage_stream", "run_failure_report", "run_lineage"]
