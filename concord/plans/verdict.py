"""One verdict row per table pair, in the ledger's columns.

:func:`verdict_frame` works on DataFrames and stays lazy: the row is a
projection over the fused compare, so a verdict is one Spark job.
:func:`pair_verdicts` works on paths: it detects the format, loads both
sides and the baseline, restricts to the latest partition, checks files and
returns the verdict frames (one per scope). :func:`error_verdict` is the row
written when a pair cannot be checked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.align import drop_columns, quoted
from concord.operators.compare import FAILED, NA, PASSED, compare
from concord.operators.partition import latest_partition, latest_value
from concord.operators.schema import schema_check
from concord.functions.paths import BASELINE_MARKER, DEV_BASELINE_PATTERN
from concord.plans.profiles import FINAL, Profile
from concord.sources import layout
from concord.sources.layouts import Layouts
from concord.sources.ledger import LEDGER, LEDGER_COLUMNS
from concord.sources.tables import DELTA, PARQUET, load_table


def _lit(v) -> Column:
    return F.lit(v).cast("string")


def verdict_frame(
    left: DataFrame,
    right: DataFrame,
    *,
    profile: Profile = FINAL,
    env: str | None = None,
    dag_id: str | None = None,
    gen1_path: str | None = None,
    gen2_path: str | None = None,
    baseline: DataFrame | None = None,
    files_validation: str = NA,
    data_check: bool = True,
    scope: str = "current",
    gen1_partition: Column | None = None,
    gen2_partition: Column | None = None,
    source_job: str = NA,
) -> DataFrame:
    """The verdict of ``left`` (old platform) against ``right`` (new) as a one-row frame.

    The schema check compares ``left`` with ``baseline`` (NA without one);
    with ``data_check=False`` the difference is reported as NA with sizes 0.
    """
    stats = compare(
        left,
        right,
        ignore=profile.ignore_data,
        ignore_distinct=profile.ignore_distinct,
        align_by=profile.align_by,
        method=profile.method,
    )
    if baseline is None:
        schema_status, schema_text = NA, None
    else:
        schema_status, schema_text = schema_check(left, baseline)
    p1 = (gen1_partition if gen1_partition is not None else _lit(None)).cast("string")
    p2 = (gen2_partition if gen2_partition is not None else _lit(None)).cast("string")
    # both sides restricted to their own latest partition: flag when those differ
    partition_status = (
        F.when(p1.isNull() & p2.isNull(), F.lit(NA))
        .when(p1.eqNullSafe(p2), F.lit(PASSED))
        .otherwise(F.lit(FAILED))
    )
    if data_check:
        e1, e2, ev = F.col("gen1_except_gen2"), F.col("gen2_except_gen1"), F.col("except_validation")
    else:
        e1, e2, ev = F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), _lit(NA)
    out = stats.select(
        _lit(env).alias("env"),
        _lit(dag_id).alias("dag_id"),
        _lit(gen1_path).alias("gen1_path"),
        _lit(gen2_path).alias("gen2_path"),
        "gen1_count",
        "gen2_count",
        "gen1_distinct_count",
        "gen2_distinct_count",
        e1.alias("gen1_except_gen2"),
        e2.alias("gen2_except_gen1"),
        _lit(files_validation).alias("files_validation"),
        "count_validation",
        "dis_count_validation",
        ev.alias("except_validation"),
        _lit(schema_status).alias("schema_validation"),
        _lit(schema_text or None).alias("schema_diff"),
        _lit(None).alias("error_msg"),
        _lit(source_job).alias("source_job"),
        _lit(scope).alias("scope"),
        p1.alias("gen1_partition"),
        p2.alias("gen2_partition"),
        partition_status.alias("partition_validation"),
        _lit(None).alias("run_id"),  # stamped by the runner
    )
    return out


def error_verdict(
    spark: SparkSession,
    *,
    env=None,
    dag_id=None,
    gen1_path=None,
    gen2_path=None,
    message: str = "",
    scope: str = "current",
) -> DataFrame:
    """The row for a pair that could not be checked: counts 0, sizes -1, every status Failed."""
    values = error_values(env=env, dag_id=dag_id, gen1_path=gen1_path, gen2_path=gen2_path, message=message, scope=scope)
    return spark.createDataFrame([values], LEDGER)


def error_values(*, env=None, dag_id=None, gen1_path=None, gen2_path=None, message: str = "", scope: str = "current") -> tuple:
    """The values of :func:`error_verdict` in the ledger's column order (no Spark job)."""
    row = {n: None for n in LEDGER_COLUMNS}
    row.update(
        env=env,
        dag_id=dag_id,
        gen1_path=gen1_path,
        gen2_path=gen2_path,
        gen1_count=0,
        gen2_count=0,
        gen1_distinct_count=0,
        gen2_distinct_count=0,
        gen1_except_gen2=-1,
        gen2_except_gen1=-1,
        files_validation=FAILED,
        count_validation=FAILED,
        dis_count_validation=FAILED,
        except_validation=FAILED,
        schema_validation=FAILED,
        error_msg=message,
        source_job=NA,
        scope=scope,
    )
    return tuple(row[n] for n in LEDGER_COLUMNS)


def baseline_path_text(env: str | None, path: str) -> str:
    """Driver-side twin of :func:`concord.functions.paths.baseline_path` for one path."""
    if env == "dev":
        return re.sub(DEV_BASELINE_PATTERN, "", path)
    return path.replace(BASELINE_MARKER, "")


@dataclass(frozen=True)
class Side:
    """One input of a pair, ready to be read."""

    df: DataFrame
    partition: Column | None  # the latest partition value it was restricted to
    read_paths: tuple[str, ...]  # the directories that are read


def _whole(spark: SparkSession, path: str, fmt: str) -> Side:
    return Side(load_table(spark, path, fmt), None, (path,))


#: What a partition column is read as where the chosen directories alone would say less than all of them.
_READ_AS = {"number": "double", "time": "timestamp"}


def _by_column(spark: SparkSession, path: str, fmt: str, column: str, found: Layouts | None = None) -> Side:
    """``path`` at the greatest value of its partition column ``column``.

    Parquet: the directories are chosen from the names below the root and only
    they are listed and read (``basePath`` keeps the partition column). Delta:
    the greatest value is a scalar subquery (a runtime partition filter).
    """
    if fmt != PARQUET:
        df = load_table(spark, path, fmt)
        return Side(latest_partition(df, column), latest_value(df, column), (path,))
    latest = (found or Layouts(spark)).latest(path, column)
    if latest is None:  # no value (or another layout): let the column decide, or its absence be reported
        df = load_table(spark, path, fmt)
        return Side(df.where(quoted(column).isNotNull()).where(F.lit(False)), None, (path,))
    df = spark.read.format(fmt).option("basePath", path).load([layout.escaped(p) for p in latest.paths])
    if latest.kind == "text":  # a value may look like a number where others do not
        df = df.withColumn(column, F.lit(latest.text))
    elif latest.kind in _READ_AS:
        df = df.withColumn(column, quoted(column).cast(_READ_AS[latest.kind]))
    value = df.select(quoted(column)).schema.fields[0].dataType
    return Side(df, F.lit(latest.text).cast(value), latest.paths)


def _by_date(spark: SparkSession, path: str, fmt: str, found: Layouts | None = None) -> Side:
    """``path`` at its own latest ``key=date`` directory, read by itself, or whole when it has none."""
    latest = (found or Layouts(spark)).latest(path, None)
    if latest is None:
        return _whole(spark, path, fmt)
    if fmt == PARQUET:
        return Side(load_table(spark, latest.paths, fmt), F.lit(latest.text), latest.paths)
    key = unquote(latest.paths[0].rsplit("/", 1)[1].split("=", 1)[0])
    df = load_table(spark, path, fmt)
    df = df.where(layout.lenient_date(quoted(key).cast("string")) == F.lit(latest.text).cast("date"))
    return Side(drop_columns(df, [key]), F.lit(latest.text), latest.paths)


def scope_paths(row: dict, profile: Profile, history: bool) -> list[tuple[str, str, str, str]]:
    """``(scope, old path, new path, baseline path)`` of one manifest row."""
    scopes = [("current", row["gen1_path"], row["gen2_path"])]
    if history:
        scopes.append(("history", row["gen1_hist_path"], row["gen2_hist_path"]))
    by_env = lambda scope: scope == "current" and profile.baseline_rule == "by_env"
    return [(s, p1, p2, baseline_path_text(row.get("env"), p1) if by_env(s) else p1.replace(BASELINE_MARKER, "")) for s, p1, p2 in scopes]


def pair_verdicts(
    spark: SparkSession,
    row: dict,
    profile: Profile = FINAL,
    history: bool = False,
    found: Layouts | None = None,
) -> list[tuple[str, DataFrame, str]]:
    """Lazy verdicts for one manifest row: ``[(scope, frame, format), ...]``.

    The old side's format applies to every input of the row. With
    ``profile.latest_by == "column"`` so does its first partition column, and
    each input is restricted to its own greatest value of it; with ``"date"``
    every path is resolved by itself to its latest ``key=date`` directory, if
    it has one. Inputs are chosen from one directory level each (``found``; by
    default each is listed here, without a job); the baseline is resolved alike and read for its schema only. Raises
    on unreadable input; the runner turns that into an error row.

    With the method ``"packed"`` (as exact; the runner's) the ranges by which row values are
    packed are found here, by one pass over both sides.
    """
    env, dag_id = row.get("env"), row.get("dag_id")
    found = found or Layouts(spark)
    fmt = found.format(row["gen1_path"])
    out = []
    for scope, p1, p2, base_path in scope_paths(row, profile, history):
        by_date = profile.latest_by == "date"
        column = None if by_date else found.column(p1, fmt)

        def side(path: str) -> Side:
            if profile.latest_partition and by_date:
                return _by_date(spark, path, fmt, found)
            if profile.latest_partition and column:
                return _by_column(spark, path, fmt, column, found)
            return _whole(spark, path, fmt)

        gen1, gen2 = side(p1), side(p2)
        base = gen1 if base_path == p1 else side(base_path)
        files_status = NA
        if profile.check_files:
            both = all(any(found.has_data(p) for p in s.read_paths) for s in (gen1, gen2))
            files_status = PASSED if both else FAILED
        data_check = True
        if scope == "history" and profile.history_data_check == "if_partitioned":
            # the resolved path tells, so a history path that is a partition directory counts as well
            data_check = any("=" in p for p in gen1.read_paths)
        verdict = partial(
            verdict_frame,
            gen1.df,
            gen2.df,
            env=env,
            dag_id=dag_id,
            gen1_path=p1,
            gen2_path=p2,
            baseline=base.df,
            files_validation=files_status,
            data_check=data_check,
            scope=scope,
            gen1_partition=gen1.partition,
            gen2_partition=gen2.partition,
        )
        try:
            frame = verdict(profile=profile)
        except Exception:  # noqa: BLE001 - what is wrong is reported below, or in its own scope where the frame is run
            if profile.method != "packed":
                raise
            frame = verdict(profile=profile.with_(method="exact"))
        out.append((scope, frame, fmt))  # already in ledger columns and types
    return out


__all__ = ["DELTA", "PASSED", "FAILED", "NA", "error_values", "error_verdict", "pair_verdicts", "verdict_frame"]
