"""Equality without a row shuffle, and differences from a sketch of their size.

Both work on 128-bit row digests (two seeded 64-bit hashes, see
:mod:`concord.operators.compare`) that the map side adds up with a sign, plus
for the left side and minus for the right, so equal rows cancel. A sum of
digests is kept as sums of 21- and 22-bit pieces, which longs hold for 10^12 rows.

**Fingerprint** (:func:`equality`). Rows fall into ``BUCKETS`` buckets by
digest; a bucket is equal if its signed count and its sums are zero. What is
shuffled is a row per bucket and task, whatever the tables hold. Only the rows
of unequal buckets go on to the exact comparison; where all are equal, adaptive
execution drops that part before it starts. Two unlike tables pass as equal if
both hashes cancel by chance, about once in 2^128.

**Invertible table** (:func:`differing_digests`). Each digest is added into three cells
of a table; a cell that in the end holds one digest (some times over) gives it
up, which is taken out of its other cells, until the table is empty. A table
holds three quarters as many digests as it has cells, so it is sized by an
estimate: strata of the digests, each half of the one before, are tables of a
fixed size, and the fullest one that empties says how many differ.
The digests are dealt to as many tables of one size as the estimate asks for, and each
is emptied by a task of its own; those that do not empty are built again, twice as large,
from their own digests. What is shuffled grows with the difference, not with the tables.

A task adds its rows to a table of its own, so a difference that is large beside a
task's rows makes tables that are nearly empty and of which each row fills three cells. Where
that would be more than the digests themselves (:func:`_sparse`), they are first added up
one by one (a shuffle of about 24 bytes per digest) and only what is left of them
goes into the tables: what is shuffled grows with the difference or with the
digests, whichever is less.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.align import align, quoted
from concord.session import ensure_checkpoint_dir, worker_imports

BUCKETS = 4096  # rows of the fingerprint, and bound of what is broadcast
THIRD = 512  # cells of a third of a table
STRATA, STRATUM_THIRD = 40, 64
FILL = 1.5  # digests expected in a third, as a part of its cells, is 1 / FILL
CELL_COST = 4  # a cell has about four times the bytes of a digest with its count

_PIECES = ((0, 22), (22, 21), (43, 21))  # (shift, bits)
_SIGN = "__concord_sign"
_CELL, _PART = "__concord_cell", "__concord_part"


def _pieces(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1)) for at, bits in _PIECES]


def _signed_sums(names: list[str]) -> list[Column]:
    """``sum(sign)`` and the signed sums of all pieces of the longs ``names``."""
    return [F.sum(_SIGN).alias("n")] + [F.sum(F.col(_SIGN) * p).alias(f"s{k}_{j}") for k, c in enumerate(names) for j, p in enumerate(_pieces(F.col(c)))]


# ------------------------------------------------------------------ fingerprint


def equality(left: DataFrame, right: DataFrame, *, ignore=(), align_by: str = "name", by=None, buckets: int = BUCKETS) -> DataFrame:
    """Counts and multiset differences of a pair (or of each group ``by``) without shuffling rows of equal buckets.

    ``gen1_count, gen2_count, gen1_except_gen2, gen2_except_gen1, count_validation, except_validation``.
    """
    from concord.operators import compare as c

    by = c._by_names(by)
    c._check_by(left, right, by)
    pair = align(left, right, [x for x in ignore if x.lower() not in {b.lower() for b in by}], align_by)
    c._check_internal(pair.names)
    group = [b.lower() if align_by == "name" else b for b in by]
    keys = [quoted(g) for g in group]
    u = c._tagged(pair.left, pair.right, pair.names)
    sign = (F.col(c._L) - F.col(c._R)).cast("bigint")
    digested = u.select("*", *c._digest(u, pair.names, c._H)).withColumn(_SIGN, sign)
    digested = digested.withColumn(_PART, F.pmod(c._H[0], F.lit(buckets)))
    sums = digested.groupBy(_PART).agg(*_signed_sums(list(c._H)))
    unequal = sums.where(" or ".join(f"{x} <> 0" for x in sums.columns if x != _PART)).select(_PART)
    rest = digested.join(F.broadcast(unequal), _PART, "left_semi")  # at most `buckets` rows
    sizes = rest.groupBy(*[quoted(n) for n in pair.names]).agg(F.sum(c._L).alias(c._N1), F.sum(c._R).alias(c._N2))
    zero = F.lit(0).cast("bigint")
    differ = sizes.groupBy(*keys).agg(F.sum(c._surplus(c._N1, c._N2)).alias(c._E1), F.sum(c._surplus(c._N2, c._N1)).alias(c._E2))
    totals = u.groupBy(*keys).agg(F.sum(c._L).alias(c._K1), F.sum(c._R).alias(c._K2))
    both = totals.select(*keys, c._K1, c._K2, zero.alias(c._E1), zero.alias(c._E2))
    both = both.unionByName(differ.select(*keys, zero.alias(c._K1), zero.alias(c._K2), c._E1, c._E2))
    stats = both.groupBy(*keys).agg(
        *[F.sum(a).alias(b) for a, b in zip((c._K1, c._K2, c._E1, c._E2), c.COUNT_COLUMNS + c.EXCEPT_COLUMNS, strict=True)]
    )
    return c._finish(stats, group, c.COUNT_COLUMNS + c.EXCEPT_COLUMNS)


# ------------------------------------------------------------------ invertible table


def _check(h1: Column, h2: Column) -> Column:
    return F.xxhash64(h1, h2)


def _hash(*longs: int) -> int:
    """``xxhash64`` of longs, as the DataFrame function gives it, unsigned."""
    import xxhash

    seed = 42
    for x in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return seed


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _place(h1: int, h2: int, j: int, salt: int, third: int) -> int:
    return j * third + _long(_hash(h1, h2, 3 * salt + j)) % third


def _cells(digests: DataFrame, part: Column, third: int, salt: int) -> DataFrame:
    """The signed table of each part: ``part, cell, n, s..``; ``digests(h1, h2, sign)``."""
    from concord.operators.compare import _H

    h1, h2 = (F.col(h) for h in _H)
    places = [(F.lit(j * third) + F.pmod(F.xxhash64(h1, h2, F.lit(3 * salt + j).cast("bigint")), F.lit(third))).cast("int") for j in range(3)]
    rows = digests.select(*_H, _SIGN, part.cast("int").alias(_PART), _check(h1, h2).alias("__concord_check"), F.explode(F.array(*places)).alias(_CELL))
    return rows.groupBy(_PART, _CELL).agg(*_signed_sums([*_H, "__concord_check"])).where(" or ".join(["n <> 0"] + [f"s{k}_{j} <> 0" for k in range(3) for j in range(3)]))


def _emptied(n: dict[int, int], sums: dict[int, list[int]], third: int, salt: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Digests with their signed counts that the table gives up, and whether it is empty then."""

    def alone(cell: int) -> tuple[int, int] | None:
        c, s = n[cell], sums[cell]
        if c == 0 or any(x % c for x in s):
            return None
        pieces = [x // c for x in s]
        if any(not 0 <= p < 1 << _PIECES[i % 3][1] for i, p in enumerate(pieces)):
            return None
        h1, h2, check = (_long(sum(pieces[3 * k + j] << _PIECES[j][0] for j in range(3))) for k in range(3))
        return (h1, h2) if _long(_hash(h1, h2)) == check and cell in [_place(h1, h2, j, salt, third) for j in range(3)] else None

    out, open_ = [], list(n)
    while open_:
        cell = open_.pop()
        if cell not in n or (found := alone(cell)) is None:
            continue
        h1, h2 = found
        c, s = n[cell], list(sums[cell])
        out.append((h1, h2, c))
        for at in {_place(h1, h2, j, salt, third): None for j in range(3)}:
            times = sum(_place(h1, h2, j, salt, third) == at for j in range(3))
            n[at] = n.get(at, 0) - c * times
            sums[at] = [a - b * times for a, b in zip(sums.get(at, [0] * 9), s, strict=True)]
            if n[at] == 0 and not any(sums[at]):
                del n[at], sums[at]
            else:
                open_.append(at)
    return out, not n


def _emptied_tables(cells: DataFrame, third: int, salt: int) -> DataFrame:
    """``part, h1, h2, c, failed``: what each part's table holds; one row with ``failed`` where it does not empty."""
    names = ["n"] + [f"s{k}_{j}" for k in range(3) for j in range(3)]

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(x).to_pylist() for x in names]
        at = table.column(_CELL).to_pylist()
        out, empty = _emptied(dict(zip(at, columns[0], strict=True)), {c: list(s) for c, s in zip(at, zip(*columns[1:]), strict=True)}, third, salt)
        rows = out if empty else [(0, 0, 0)]
        h1, h2, c = zip(*rows) if rows else ((), (), ())
        part = table.column(_PART)[0].as_py()
        return pa.table({"part": pa.array([part] * len(rows), pa.int32()), "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "c": pa.array(c, pa.int64()), "failed": pa.array([not empty] * len(rows), pa.bool_())})

    return cells.groupBy(_PART).applyInArrow(run, "part int, h1 long, h2 long, c long, failed boolean")


def estimate(digests: DataFrame) -> int:
    """How many digests differ, from the strata: exact if all of them empty."""
    from concord.operators.compare import _H

    u = F.pmod(F.xxhash64(*_H, F.lit(-1).cast("bigint")), F.lit(1 << 52)) / float(1 << 52)
    level = F.least(F.lit(STRATA - 1), F.floor(-F.log2(u + 2.0**-53)))
    found = _emptied_tables(_cells(digests, level, STRATUM_THIRD, 0), STRATUM_THIRD, 0)
    rows = {r["part"]: (r["k"], r["failed"]) for r in found.groupBy("part").agg(F.count("*").alias("k"), F.max("failed").alias("failed")).collect()}
    total = 0
    for at in reversed(range(STRATA)):
        k, failed = rows.get(at, (0, False))
        if failed:
            return max(total, 1) << (at + 1)
        total += k
    return total


def _sparse(digests: DataFrame, cells: int) -> bool:
    """Whether the tables of all tasks, of ``cells`` cells each, would be more than the digests themselves."""
    per_task = digests.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    filled = F.sum(F.least(3 * F.col("n"), F.lit(cells).cast("bigint")))
    r = per_task.agg(filled.alias("filled"), F.sum("n").alias("n")).first()
    return CELL_COST * (r["filled"] or 0) > (r["n"] or 0)


def _added_up(digests: DataFrame, path: str) -> DataFrame:
    """``(h1, h2, sign)`` with the sums of the signs that are not zero, kept below ``path``."""
    from concord.operators.compare import _H

    left = digests.groupBy(*_H).agg(F.sum(_SIGN).alias(_SIGN)).where(F.col(_SIGN) != 0)
    left.write.parquet(path)
    return digests.sparkSession.read.schema(left.schema).parquet(path)


def differing_digests(digests: DataFrame, third: int = THIRD) -> DataFrame:
    """``(h1, h2, c)`` of the digests whose signed count ``c`` is not zero; ``digests(h1, h2, sign)`` by their column names."""
    from concord.operators.compare import _H

    spark = digests.sparkSession
    worker_imports(spark)
    parts = max(1, int(np.ceil(estimate(digests) * FILL / third)))
    part = F.pmod(F.xxhash64(*_H, F.lit(-2).cast("bigint")), F.lit(parts))
    folder = f"{ensure_checkpoint_dir(spark)}/concord-sketch-{uuid.uuid4().hex}"
    if _sparse(digests, 3 * third * parts):
        digests = _added_up(digests, f"{folder}/digests")
    todo: DataFrame | None = None
    salt, written = 1, []
    while True:
        rows = digests
        if todo is not None:  # tables that did not empty, at most `parts` of them
            rows = rows.withColumn(_PART, part.cast("int")).join(F.broadcast(todo), _PART, "left_semi").drop(_PART)
        path = f"{folder}/{salt}"
        _emptied_tables(_cells(rows, part, third, salt), third, salt).write.parquet(path)
        written.append(path)
        todo = spark.read.parquet(path).where("failed").select(F.col("part").alias(_PART)).distinct()
        if todo.isEmpty():
            break
        third, salt = 2 * third, salt + 1
    found = spark.read.parquet(*written).where("not failed")
    return found.select(F.col("h1").alias(_H[0]), F.col("h2").alias(_H[1]), "c")


def signed_digests(tagged: DataFrame) -> DataFrame:
    """``(h1, h2, sign)`` of digested rows that carry their side."""
    from concord.operators.compare import _H, _L, _R

    return tagged.select(*_H, (F.col(_L) - F.col(_R)).cast("bigint").alias(_SIGN))
