"""Restricting a table to its latest partition.

Each side is restricted by its *own* maximum, as the original sweep did; rows
whose partition value is NULL drop out. Two forms:

* ``value=None``: ``WHERE p = (SELECT max(p) FROM t)`` as a scalar subquery.
  On a partition column of a file source Catalyst turns it into a runtime
  partition filter, so only the last partition's files are read.
* ``value=v``: a literal filter, for when the latest value is already known
  from the file listing (see :mod:`concord.sources.layout`)
  — then pruning happens at planning time and no data file is opened for
  the maximum at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.align import quoted


def _expr(column) -> Column:
    return quoted(column) if isinstance(column, str) else column


def latest_value(df: DataFrame, column) -> Column:
    """``(SELECT max(column) FROM df)`` as a scalar-subquery column."""
    return df.select(F.max(_expr(column))).scalar()


def latest_partition(df: DataFrame, column, value=None) -> DataFrame:
    """Rows of ``df`` whose ``column`` (name or expression) equals its maximum."""
    col = _expr(column)
    if value is None:
        return df.where(col == latest_value(df, column))
    return df.where(col == F.lit(value))
