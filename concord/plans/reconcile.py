"""The reconcile runner: every manifest row to one verdict row per scope, into the ledger.

Each pair is its own Spark job (a fused compare); several pairs run at once
on the one session, so small tables do not leave a large cluster idle, and a
failing or hanging pair never stops the others (:mod:`concord.plans.supervise`:
job tags, a deadline, scheduler pools). The driver holds
the manifest and one verdict row per pair, nothing else. Verdicts are
appended to the ledger in batches (few files, and an interrupted sweep
keeps everything flushed so far); ``resume_on`` skips pairs already in the
ledger for a date, so a rerun after a lost driver continues where it was.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.plans.profiles import FINAL, Profile
from concord.plans.supervise import supervise
from concord.plans.sweep import resume_manifest
from concord.plans.verdict import DELTA, FAILED, error_values, pair_verdicts, scope_paths
from concord.sources import commit_log, ledger
from concord.session import ensure_checkpoint_dir
from concord.sources.layouts import Layouts, ManifestLayouts
from concord.sources.ledger import LEDGER, LEDGER_COLUMNS

LAYOUT_CHUNK = 512  # manifest rows whose roots are listed by one job
LAYOUT_JOB_FROM = 16  # fewer pairs are listed by the driver


def _error_row(row, message, scope) -> tuple:
    old, new = ("gen1_hist_path", "gen2_hist_path") if scope == "history" else ("gen1_path", "gen2_path")
    return error_values(
        env=row.get("env"), dag_id=row.get("dag_id"), gen1_path=row.get(old), gen2_path=row.get(new),
        message=message, scope=scope,
    )


def chunk_layouts(spark: SparkSession, rows: list[dict], profile: Profile, history: bool) -> Layouts:
    """Layouts of all pairs of a chunk, from two jobs; a few pairs, or roots that tasks cannot list, are listed one by one."""
    if len(rows) < LAYOUT_JOB_FROM:
        return Layouts(spark)
    try:
        pairs = [(p1, (p2, base)) for r in rows for _, p1, p2, base in scope_paths(r, profile, history)]
        return ManifestLayouts(spark, pairs, by=profile.latest_by)
    except Exception:  # noqa: BLE001 - one bad root must not stop the others: each pair lists its own and reports it
        return Layouts(spark)


def packed(profile: Profile) -> Profile:
    """The profile as the runner compares by it: exact profiles pack row values, so fewer bytes are shuffled."""
    return profile.with_(method="packed") if profile.method == "exact" else profile


def check_pair(spark: SparkSession, row: dict, profile: Profile = FINAL, history: bool = False, found: Layouts | None = None) -> list:
    """Verdict rows (as ``Row``) for one manifest row; errors become error rows, never raise."""
    scopes = ["current", "history"] if history else ["current"]
    # names this thread's jobs after the pair, so stages are found in the event log
    try:
        spark.sparkContext.setJobDescription(f"concord {profile.name}: {row.get('dag_id')} {row.get('gen2_path')}")
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        pass
    try:
        frames = pair_verdicts(spark, row, packed(profile), history, found)
    except Exception as e:  # noqa: BLE001 - any failure of one pair is recorded, the sweep goes on
        return [_error_row(row, _message(e), s) for s in scopes]
    rows = []
    for scope, frame, fmt in frames:
        try:
            r = frame.first().asDict()
            if profile.lineage and fmt == DELTA and r["except_validation"] == FAILED:
                r["source_job"] = commit_log.job_list(spark, r["gen2_path"], profile.excluded_jobs)
            rows.append(tuple(r[c] for c in LEDGER_COLUMNS))
        except Exception as e:  # noqa: BLE001
            rows.append(_error_row(row, _message(e), scope))
    return rows


def _batch_name(run_id: str, rows: list[tuple]) -> str:
    """A name that the same verdicts of the same run have again."""
    return f"{run_id}-{uuid.uuid5(uuid.NAMESPACE_OID, repr(sorted(rows, key=repr))).hex}"


def _message(e: Exception) -> str:
    return str(e).strip() or type(e).__name__


def reconcile(
    spark: SparkSession,
    manifest: DataFrame,
    profile: Profile = FINAL,
    *,
    ledger_path: str | None = None,
    history: bool = False,
    concurrency: int = 4,
    batch_size: int = 32,
    resume_on: str | None = None,
    run_id: str | None = None,
    deadline: float | None = None,
    grace: float = 30.0,
    pool_of: Callable[[dict], str | None] | None = None,
) -> DataFrame:
    """Check every pair of ``manifest``; return the verdicts (and append them to ``ledger_path``).

    The manifest is streamed to the driver partition by partition
    (``toLocalIterator``), ``LAYOUT_CHUNK`` rows at a time, whose directories
    are listed by one job for them all, with ``concurrency`` pairs in flight, so
    the driver never holds it whole. Verdicts go to the ledger in
    batches (without ``ledger_path`` to one of this run, below the shared
    checkpoint folder) and the result is read back by ``run_id``.
    ``resume_on='YYYY-MM-DD'`` first removes pairs already in the ledger on that date.

    A pair that takes more than ``deadline`` seconds is cancelled and becomes an
    error row (per scope); one that hangs outside Spark is left behind after ``grace``
    more. ``pool_of(row)`` names the FAIR scheduler pool of a pair's jobs, e.g.
    ``supervise.by_size("bytes")`` for a manifest with that column, so that small
    pairs do not queue behind the tasks of a large one.
    """
    run_id = run_id or uuid.uuid4().hex
    given = ledger_path is not None
    ledger_path = ledger_path or f"{ensure_checkpoint_dir(spark)}/concord-run-{run_id}"
    if resume_on is not None and given:
        logged = ledger.read_if_any(spark, ledger_path)  # an unreadable ledger raises: nothing is checked twice
        if logged is not None:
            manifest = resume_manifest(manifest, logged, resume_on)
    pending: list[tuple] = []
    run_col = LEDGER_COLUMNS.index("run_id")

    def collect(rows):
        for r in rows:
            r = list(r)
            r[run_col] = run_id
            pending.append(tuple(r))
        if len(pending) >= batch_size:
            flush()

    def flush():
        if pending:
            ledger.append(spark.createDataFrame(pending, LEDGER), ledger_path, _batch_name(run_id, pending))
        pending.clear()

    def pairs():
        rows = (r.asDict() for r in manifest.toLocalIterator(prefetchPartitions=True))
        while chunk := list(itertools.islice(rows, LAYOUT_CHUNK)):
            found = chunk_layouts(spark, chunk, profile, history)
            yield from ((r, found) for r in chunk)

    def late(pair):
        scopes = ["current", "history"] if history else ["current"]
        return [_error_row(pair[0], f"not done within {deadline:g} seconds", s) for s in scopes]

    # whichever ends first: one large pair holds back neither the others nor finished verdicts
    for verdicts in supervise(
        spark, pairs(), lambda pair: check_pair(spark, pair[0], profile, history, pair[1]), late,
        width=concurrency, deadline=deadline, grace=grace, pool_of=pool_of and (lambda pair: pool_of(pair[0])),
    ):
        collect(verdicts)
    flush()
    out = ledger.read_if_any(spark, ledger_path)
    if out is None:  # empty manifest: no ledger yet
        return spark.createDataFrame([], LEDGER)
    return out.where(F.col("run_id") == run_id).select(*LEDGER_COLUMNS)
