"""Ledger queries: the next manifest, resume, failure report, retries.

All are DataFrame plans over ledgers; none collects. Ledgers written with
counts as text can be passed through :func:`concord.sources.ledger.typed_counts`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.job_ids import normalize_job_id
from concord.operators.compare import FAILED
from concord.sources.ledger import DAY

# Job ids and paths containing these are never swept, and only
# jobs whose raw id ends in one of the schedules are.
SWEEP_EXCLUDE = ("streaming", "test")
SWEEP_EXCLUDE_PATHS = ("test",)
SWEEP_SCHEDULES = ("daily", "weekly")
SWEEP_ENV = "prod"


def _sweepable(exclude, exclude_paths) -> Column:
    dag, p1, p2 = F.col("dag_id"), F.col("gen1_path"), F.col("gen2_path")
    keep = F.lit(True)
    for word in exclude:
        keep = keep & ~dag.like(f"%{word}%")
    for word in exclude_paths:
        keep = keep & ~p1.like(f"%{word}%") & ~p2.like(f"%{word}%")
    return keep & (F.col("gen1_count") > 0) & (F.col("gen2_count") > 0)


def sweep_manifest(
    ledger1: DataFrame,
    ledger2: DataFrame,
    rules: str = "corrected",
    *,
    exclude=SWEEP_EXCLUDE,
    exclude_paths=SWEEP_EXCLUDE_PATHS,
    schedules=SWEEP_SCHEDULES,
    env: str = SWEEP_ENV,
) -> DataFrame:
    """Manifest of pairs worth re-checking, from two ledgers.

    Both ledgers: drop streaming and test jobs and test paths, keep pairs
    with rows on both sides; the second ledger only for ``env='prod'``. The
    union is distinct; jobs whose raw id ends in ``daily`` / ``weekly`` are
    kept and their ids normalised (:func:`normalize_job_id`).
    """
    cols = ["dag_id", "gen1_path", "gen2_path"]
    keep = _sweepable(exclude, exclude_paths)
    a = ledger1.where(keep).select(*cols)
    b = ledger2.where(keep & (F.col("env") == env)).select(*cols)
    dag = F.col("dag_id")
    scheduled = F.lit(False)
    for schedule in schedules:
        scheduled = scheduled | dag.like(f"%{schedule}")
    return (
        a.union(b)
        .distinct()
        .where(scheduled)
        .select(
            F.lit(env).alias("env"),
            normalize_job_id(dag, rules).alias("dag_id"),
            "gen1_path",
            "gen2_path",
        )
        .distinct()
    )


def _day(day) -> Column:
    if isinstance(day, (_dt.date, _dt.datetime)):
        day = day.strftime("%Y-%m-%d")
    return F.lit(day).cast("date")


def checked_on(ledger: DataFrame, day) -> DataFrame:
    """Distinct ``gen2_path`` logged on ``day`` (NULL paths removed)."""
    on = F.col(DAY) if DAY in ledger.columns else F.to_date(F.col("ts"))  # a ledger by day is read at that day alone
    return (
        ledger.where(on == _day(day))
        .where(F.col("gen2_path").isNotNull())
        .select("gen2_path")
        .distinct()
    )


def resume_manifest(manifest: DataFrame, ledger: DataFrame, day) -> DataFrame:
    """``manifest`` without the pairs whose ``gen2_path`` was already checked on ``day``.

    A left-anti join; NULL paths in the ledger are ignored (a ``NOT IN``
    against a set holding NULL would return nothing at all).
    """
    return manifest.join(checked_on(ledger, day), "gen2_path", "left_anti").select(*manifest.columns)


def failure_report(ledger: DataFrame, equal_sizes: bool = False) -> DataFrame:
    """Distinct ``gen2_path`` whose data check failed while the old side had rows.

    ``equal_sizes=True`` keeps only failures with as many rows missing as
    extra: same row count, changed values.
    """
    cond = (F.col("except_validation") == FAILED) & (F.col("gen1_count") != 0)
    if equal_sizes:
        cond = cond & (F.col("gen1_except_gen2") == F.col("gen2_except_gen1"))
    return ledger.where(cond).select("gen2_path").distinct()


def value_drift_report(ledger: DataFrame) -> DataFrame:
    """Failed pairs with equal difference sizes both ways."""
    return failure_report(ledger, equal_sizes=True)


def retry_manifest(ledger: DataFrame) -> DataFrame:
    """Manifest of every pair whose data check failed (each pair once)."""
    return (
        ledger.where(F.col("except_validation") == FAILED)
        .select(F.lit(SWEEP_ENV).alias("env"), "dag_id", "gen1_path", "gen2_path")
        .distinct()
    )
