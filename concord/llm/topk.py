"""Exact top-k by inner product: Fagin's threshold algorithm over sorted lists.

Candidates are cut into tiles. In a tile every dimension has a list of the
rows sorted by its value. For a query the lists are read from the end that its
weight favours, a few entries of all lists at a time; rows seen for the first
time are scored in full. No unseen row can score above the threshold, the sum
over dimensions of weight times the value last read. Reading stops when the
kth best score is above it, so that not even a tie could get in.

Queries are a stated set, in tiles of their own, each against all candidate
tiles; a unit returns at most k rows a query, and the best k of those remain.
"""

from __future__ import annotations

import decimal
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.store import python_workers
from concord.llm.tiles import Tile, finite, pack, per_unit, tiles_for

_SAFE = 1 << 53
_PLAIN = 1 << 20  # codes below take part in the sorted lists
_WIDE = 10**38  # scores are compared as whole numbers of up to 38 digits
_LONG = (1 << 63) - 1


class SortedLists:
    """The sorted lists of a tile: for each dimension its rows by ascending value."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        self.ids, self.data = ids, data
        self.order = np.argsort(data, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(data, self.order, axis=0)

    def best(self, query: np.ndarray, own: int, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows besides ``own``; ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        seen = np.zeros(n, bool)
        best_ids, best_scores = np.empty(0, np.int64), np.empty(0)
        at = 0
        while True:
            to = min(at + step, n)
            if len(up) + len(down):
                new = np.zeros(n, bool)
                new[self.order[at:to, up]] = True
                new[self.order[n - to : n - at, down]] = True
                new &= ~seen
            else:  # no dimension counts: every row scores zero
                new, to = ~seen, n
            seen |= new
            rows = np.flatnonzero(new)
            rows = rows[self.ids[rows] != own]
            if len(rows):
                scores = self.data[rows] @ query
                if len(best_scores) == k:
                    rows, scores = rows[scores >= best_scores[-1]], scores[scores >= best_scores[-1]]
                best_ids = np.concatenate([best_ids, self.ids[rows]])
                best_scores = np.concatenate([best_scores, scores])
                first = np.lexsort((best_ids, -best_scores))[:k]
                best_ids, best_scores = best_ids[first], best_scores[first]
            if to == n:
                return best_ids, best_scores
            bound = self.sorted[to - 1, up] @ query[up] + self.sorted[n - to, down] @ query[down]
            if len(best_scores) == k and best_scores[-1] > bound:
                return best_ids, best_scores
            at = to


def _whole(data: np.ndarray) -> np.ndarray:
    """Codes as Python's whole numbers."""
    return np.array([int(x) for x in data.ravel().tolist()], dtype=object).reshape(data.shape)


def _largest(data: np.ndarray) -> np.ndarray:
    return np.abs(data).max(axis=1, initial=0.0)


def _unit(k: int):
    """Top k of the queries of one tile in another.

    Rows and queries with large codes, whose products a double may not hold,
    are apart: they meet the others, and one another, in whole numbers of any size.
    """

    def work(rows: list[dict]) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) == 2:
            queries, tile = Tile(rows[0]), Tile(rows[1])
            large = _largest(tile.data) >= _PLAIN
            lists = SortedLists(tile.ids[~large], tile.data[~large])
            ids_large, whole = tile.ids[large], _whole(tile.data[large])
            every = None
            plain = _largest(queries.data) * _PLAIN * max(1, tile.data.shape[1]) < _SAFE
            for own, query, fits in zip(queries.ids.tolist(), queries.data, plain, strict=True):
                found: list[tuple[int, int]] = []
                if fits:
                    ids, scores = lists.best(query, own, k)
                    found = [(-int(s), i) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
                    exact, exact_ids = whole, ids_large
                else:
                    every = _whole(tile.data) if every is None else every
                    exact, exact_ids = every, tile.ids
                if len(exact_ids):
                    scores = (exact * _whole(query)).sum(axis=1) if exact.shape[1] else [0] * len(exact_ids)
                    found += [(-s, i) for i, s in zip(exact_ids.tolist(), scores, strict=True) if i != own]
                for s, i in heapq.nsmallest(k, found):
                    out["query_id"].append(own)
                    out["vec_id"].append(i)
                    out["score"].append(-s)
        score = [decimal.Decimal(s) if abs(s) < _WIDE else decimal.Decimal(_WIDE - 1).copy_sign(decimal.Decimal(s)) for s in out["score"]]
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(score, pa.decimal128(38, 0))})

    return work


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    tile_rows: int = 1 << 14,
    query_rows: int = 1 << 11,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row its ``k`` best other rows.

    ``score``: the inner product of the vectors' codes ``floor(scale * x)``, a
    whole number; equal scores go to the smaller id, and with fewer than ``k``
    candidates all are returned. ``is_query`` is a condition on ``id``.
    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without id; vectors of different lengths have no product. Of
    rows that share an id the largest vector counts, so a repeated row counts
    once. Large codes are multiplied as whole numbers, so scores of up to 38
    digits are in exact order; one that a long cannot hold is returned as the nearest long.
    """
    python_workers(vectors.sparkSession)
    most = F.lit(np.finfo("f8").max)
    # beyond 2^53 a double has no fraction; a product beyond all doubles counts as the largest one
    code = lambda x: F.when(F.abs(x * scale) < _SAFE, F.floor(x * scale).cast("double")).otherwise(F.greatest(-most, F.least(most, x * scale)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("vector")))
    rows = rows.groupBy("id").agg(F.max("vector").alias("vector"))
    rows = rows.select("id", F.lit(0).cast("long").alias("extra"), F.transform("vector", code).alias("vector"))
    asked = rows.where(is_query)
    of_all, of_asked = tiles_for(rows.count(), tile_rows), tiles_for(asked.count(), query_rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = pack(asked, of_asked).withColumns({"i": F.col("tile"), "side": F.lit(0)}).withColumn("j", every(of_all))
    right = pack(rows, of_all).withColumns({"j": F.col("tile"), "side": F.lit(1)}).withColumn("i", every(of_asked))
    found = per_unit(left.unionByName(right), _unit(k), "query_id long, vec_id long, score decimal(38,0)")
    score = F.greatest(F.lit(-_LONG - 1).cast("decimal(38,0)"), F.least(F.lit(_LONG).cast("decimal(38,0)"), F.col("score"))).cast("long")
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
