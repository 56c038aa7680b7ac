"""Check profiles: which columns each check ignores, how columns pair, what is restricted.

The presets reproduce the four historical variants of the sweep:

* ``FINAL``     — name alignment, latest partition, writer jobs on failure
* ``PHASE2``    — as FINAL without writer jobs
* ``PHASE4``    — as PHASE2 with the eight-name data list
* ``CURRENT_HISTORY`` — positional alignment, current and history pairs,
  each side read at its latest partition with the partition column left
  out (the old form loaded the partition directory itself), history data
  check only for partitioned history tables (else ``NA``)
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from concord.sources.commit_log import EXCLUDED_JOBS

# Audit columns, ignored by the distinct and data checks.
DISTINCT_AUDIT = ("load_date", "load_timestamp")
DATA_AUDIT = (
    "load_date",
    "load_timestamp",
    "update_time",
    "load_dtm",
    "update_dtm",
    "azure_export_date",
    "q_promo_deal_id",
    "last_update",
    "ImportDate",
)
DATA_AUDIT_PHASE4 = (
    "load_date",
    "load_timestamp",
    "update_time",
    "load_dtm",
    "update_dtm",
    "azure_export_date",
    "last_update",
    "q_promo_deal_id",
)


@dataclass(frozen=True)
class Profile:
    name: str
    ignore_distinct: tuple[str, ...] = DISTINCT_AUDIT
    ignore_data: tuple[str, ...] = DATA_AUDIT
    align_by: str = "name"
    latest_partition: bool = True
    # which partition is the latest: "column" (greatest value of the old side's first
    # partition column, on each side) or "date" (each path's own latest key=date directory)
    latest_by: str = "column"
    lineage: bool = False
    # "always" or "if_partitioned" (history pairs: NA when the table is not partitioned)
    history_data_check: str = "always"
    check_files: bool = True
    # "by_env": env 'dev' removes the dev pattern, others the marker text;
    # "marker": always the marker text
    baseline_rule: str = "by_env"
    # "exact" (group by row values, which the runner packs without loss) or "digest" (group by a 128-bit row digest; for wide rows)
    method: str = "exact"
    # jobs that are never reported as writers
    excluded_jobs: tuple[str, ...] = EXCLUDED_JOBS

    def with_(self, **kw) -> "Profile":
        return replace(self, **kw)


FINAL = Profile("final", lineage=True)
PHASE2 = Profile("phase2")
PHASE4 = Profile("phase4", ignore_data=DATA_AUDIT_PHASE4)
CURRENT_HISTORY = Profile(
    "current_history",
    ignore_data=DISTINCT_AUDIT,
    align_by="position",
    latest_by="date",
    history_data_check="if_partitioned",
    baseline_rule="marker",
)

PROFILES = {p.name: p for p in (FINAL, PHASE2, PHASE4, CURRENT_HISTORY)}
