"""Loading one side of a pair: format detection, read, partition column.

A table is Delta iff ``<path>/_delta_log/`` holds commit files; otherwise
Parquet. The format found for the old side is used for every input of a
manifest row, as in the original sweep. Delta data is read through
``format("delta")`` when the connector is on the classpath; without it the
load raises and the pair gets an error verdict.

Delta partition columns come from the last ``metaData`` action of the log
(see :mod:`concord.sources.commit_log`); Parquet partition columns from the
names of the root's ``key=value`` directories.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from concord.sources import commit_log, layout

DELTA = "delta"
PARQUET = "parquet"


def detect_format(spark: SparkSession, path: str) -> str:
    """``"delta"`` when ``path/_delta_log`` has JSON commits or checkpoints, else ``"parquet"``. No job."""
    return DELTA if layout.is_delta(spark, path) else PARQUET


def load_table(spark: SparkSession, path: str | Iterable[str], fmt: str = PARQUET) -> DataFrame:
    """``spark.read.format(fmt).load(path)`` of one path or several, as they are written (no patterns).

    A missing path raises ``FileNotFoundError``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return spark.read.format(fmt).load([layout.escaped(p) for p in paths] if fmt == PARQUET else paths[0])
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"path does not exist: {', '.join(paths)}") from e
        raise


def first_partition_column(spark: SparkSession, path: str, fmt: str) -> str | None:
    """The table's first partition column, or None when it is not partitioned."""
    if fmt == DELTA:
        cols = commit_log.partition_columns(spark, path)
        first = cols[0] if cols else None
    else:
        first = layout.root_column(spark, path)
    return first if first is not None and first.strip() else None
