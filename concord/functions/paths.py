"""Path expressions used by manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a test copy's path maps to its production baseline.
# env 'dev': remove the regex below; any other env: remove the literal text.
DEV_BASELINE_PATTERN = "_test/priority2/[0-9][0-9][0-9]"
BASELINE_MARKER = "_test"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def baseline_path(env, path) -> Column:
    """Path of the production copy whose schema the old side is checked against."""
    env, path = _c(env), _c(path)
    return F.when(env == F.lit("dev"), F.regexp_replace(path, DEV_BASELINE_PATTERN, "")).otherwise(
        F.replace(path, F.lit(BASELINE_MARKER), F.lit(""))
    )


def table_name(path) -> Column:
    """Last non-empty path segment: ``/lake/db/orders`` and ``/lake/db/orders/`` -> ``orders``."""
    return F.substring_index(F.regexp_replace(_c(path), "/+$", ""), "/", -1)
