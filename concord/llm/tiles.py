"""Vectors in tiles: blocks of rows packed into matrices, and pairs of tiles as work units.

A tile is one row of a table that holds a block of vectors of one length; a
unit is a pair of tiles in one task. Tiles are cut by a hash of the id, so
their sizes follow the number of rows and no value can crowd one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = "dim int, tile int, rows int, ids binary, extra binary, data binary"


def finite(col: Column) -> Column:
    """Whether a vector holds numbers only: not null, no null, NaN or infinite component."""
    good = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(col.isNotNull() & good, F.lit(False))


def tiles_for(rows: int, size: int) -> int:
    """Number of tiles for so many rows."""
    return max(1, -(-rows // size))


def pack(rows: DataFrame, tiles: int) -> DataFrame:
    """``rows(id long, extra long, vector array<double>)`` in ``tiles`` tiles for each vector length.

    Tiles without rows are left out.
    """
    cut = rows.select("*", F.size("vector").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile"))

    def one(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        vectors = table.column("vector").combine_chunks()
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        data = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(order), dim)[order]
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "tile": pa.array([table.column("tile")[0].as_py()], pa.int32()),
                "rows": pa.array([len(order)], pa.int32()),
                "ids": [table.column("id").to_numpy()[order].astype("<i8").tobytes()],
                "extra": [table.column("extra").to_numpy()[order].astype("<i8").tobytes()],
                "data": [np.ascontiguousarray(data, dtype="<f8").tobytes()],
            }
        )

    return cut.groupBy("dim", "tile").applyInArrow(one, TILE)


class Tile:
    """One row of :func:`pack` inside a task."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.extra = np.frombuffer(row["extra"], "<i8")
        self.data = np.frombuffer(row["data"], "<f8").reshape(row["rows"], row["dim"])


def per_unit(units: DataFrame, work: Callable[[list[dict]], pa.Table], schema: str) -> DataFrame:
    """``work`` on the one or two tile rows of each unit (``dim, i, j``); ``side`` orders the two.

    A unit of two tiles has one row if the other tile is empty.
    """

    def one(table: pa.Table) -> pa.Table:
        return work(sorted(table.to_pylist(), key=lambda r: r["side"]))

    return units.groupBy("dim", "i", "j").applyInArrow(one, schema)
