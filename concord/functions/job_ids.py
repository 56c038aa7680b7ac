"""Normalising scheduler job ids to ``<name>_daily`` / ``<name>_weekly``.

Rule: an id matching ``LIKE '%_daily%'`` keeps the text before the first
``_daily`` and gets ``_daily`` appended; otherwise an id matching
``LIKE '%_weekly%'`` keeps the text before the first ``_weekly`` (corrected
rule) and gets ``_weekly``; other ids are kept. ``_`` in the LIKE patterns is
the one-character wildcard, so ``foodaily`` matches and becomes
``foodaily_daily``.

The ``"literal"`` rule set reproduces the historical form, which cut weekly
ids at ``_monthly``: ``a_weekly -> a_weekly_weekly``, ``x_monthly_weekly ->
x_weekly``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (LIKE pattern, cut-at text, suffix) per rule set, in order.
RULES = {
    "corrected": (("%_daily%", "_daily", "_daily"), ("%_weekly%", "_weekly", "_weekly")),
    "literal": (("%_daily%", "_daily", "_daily"), ("%_weekly%", "_monthly", "_weekly")),
}


def normalize_job_id(job_id, rules: str = "corrected") -> Column:
    col = F.col(job_id) if isinstance(job_id, str) else job_id
    out = col
    for pattern, cut, suffix in reversed(RULES[rules]):
        out = F.when(col.like(pattern), F.concat(F.substring_index(col, cut, 1), F.lit(suffix))).otherwise(out)
    return out
