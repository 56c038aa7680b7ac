"""Mixing sources to target weights by a Pfair schedule.

Each source is cut into blocks of about ``block_bytes`` of text. With its exact
share ``w`` of all weights, a fraction of whole numbers, block ``k`` of a source
is released at slot ``floor(k / w)`` and has its deadline at ``ceil((k + 1) / w)``;
each slot goes to the released block with the earliest deadline. As the shares
add up to one, no deadline is missed: after any number ``t`` of slots every
source has had ``floor(t * w)`` or ``ceil(t * w)`` blocks, so it is less than one
block off its exact share, at any time and for any number of blocks. Nothing
is rounded and nothing repeats.

The schedule is laid out by one task as a stream, which holds a few numbers per
source and writes a row per block; every block's slot follows by a lookup. Nothing of the
input passes through the driver but one total per source.

Documents are numbered within a source by a running sum of bytes in the order
of a hash of their id (of their text, where they have none). A source is cut into ranges of that hash, summed up
first, so a source with a third of all rows is numbered by many tasks.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.store import python_workers, written

BROADCAST_SLOTS = 1 << 17  # a plan of up to so many rows is broadcast (some 10 MB)


def exact_shares(weights: Mapping[str, float | Fraction]) -> dict[str, Fraction]:
    """Each source's share of all weights, as a fraction; sources without weight are left out."""
    there = {s: Fraction(x) for s, x in weights.items() if x > 0}
    total = sum(there.values())
    return {s: x / total for s, x in there.items()}


def window(share: Fraction, k: int) -> tuple[int, int]:
    """(release, deadline) of a source's block ``k``."""
    return k * share.denominator // share.numerator, -(-(k + 1) * share.denominator // share.numerator)


def slots_of(shares: Mapping[str, Fraction], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) by earliest deadline first, ties by name.

    Every source keeps its share to the end; what comes are its blocks below
    its number, and the walk ends with the last of them, after the largest
    number of blocks by share among the sources.
    """
    open_ = sum(blocks.get(s, 0) for s in shares)
    waiting = [(0, s, 0) for s in shares]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []  # (deadline, source, block, release)
    slot = 0
    while open_:
        while waiting and waiting[0][0] <= slot:
            release, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (window(shares[s], k)[1], s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        if k < blocks.get(s, 0):
            open_ -= 1
            yield s, k, release, deadline, slot
        heapq.heappush(waiting, (window(shares[s], k + 1)[0], s, k + 1))
        slot += 1


def _plan(spark: SparkSession, shares: Mapping[str, Fraction], blocks: Mapping[str, int]) -> DataFrame:
    """The rows of :func:`slots_of`, written by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        rows = slots_of(shares, blocks)
        while part := list(itertools.islice(rows, 1 << 13)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*part))],
                names=["source", "block", "release", "deadline", "slot"],
            )

    start = spark.range(0, 1, 1, 1)
    return start.mapInArrow(run, "source string, block long, release long, deadline long, slot long")


COLUMNS = ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_offset")


def mix(
    docs: DataFrame,
    shares: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block_bytes: int = 1 << 16,
    temperature: float = 0.5,
    range_rows: int = 1 << 12,
) -> DataFrame:
    """``docs`` with ``mix_block, mix_release, mix_deadline, mix_slot, mix_offset``.

    The training order is ``mix_slot, mix_offset``. ``shares``: target weight of
    each source; by default a source's share of all bytes to the power of
    ``temperature``. Every row stays and comes once: a source that has ended
    leaves its slots empty, and one without a share has no slot (null; such
    rows sort behind the others by ``nulls last``). Null sources are a source
    of their own. A text counts its bytes and 1, so null and empty texts have
    a place; a text longer than a block takes up the blocks that it covers and
    stands in its first. Rows that share an id are placed each by itself.
    Columns named like an output column are replaced; any other name may occur.
    """
    spark = docs.sparkSession
    python_workers(spark)
    kept = [c for c in docs.columns if c.lower() not in COLUMNS]
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    work = docs.select(
        *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)],  # no struct: a column that is not asked for is not carried along
        F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("n")).alias("source"),
        (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + 1).cast("long").alias("bytes"),
        F.when(own.isNull(), F.xxhash64(text, F.lit(0))).otherwise(F.xxhash64(own)).alias("hash"),
        own.alias("id"),
        F.xxhash64(text).alias("text"),
    )
    rows = docs.count()
    bits = min(40, max(8, math.ceil(math.log2(max(rows, 1) / range_rows + 1))))
    work = work.withColumn("range", F.shiftright("hash", 64 - bits))
    sums = written(work.groupBy("source", "range").agg(F.sum("bytes").alias("sum")), "mixing-sums")
    totals = {r["source"]: r["bytes"] for r in sums.groupBy("source").agg(F.sum("sum").alias("bytes")).collect()}
    blocks = {s: -(-n // block_bytes) for s, n in totals.items()}
    if shares is None:
        target = exact_shares({s: float(n) ** temperature for s, n in totals.items()})
    else:
        target = exact_shares({"n" if s is None else f"s{s}": x for s, x in shares.items()})
    plan = _plan(spark, target, blocks)
    # its size is known here alone: to Spark it is what came of one row
    small = sum(blocks.get(s, 0) for s in target) <= BROADCAST_SLOTS
    plan = F.broadcast(plan) if small else plan.hint("shuffle_merge")
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    before = sums.select("source", "range", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("source", "range").orderBy("hash", "id", "text", "bytes")
    inside = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        work.withColumn("inside", inside)
        .join(before, ["source", "range"], "left")
        .withColumn("offset", F.col("before") + F.col("inside"))
        .withColumn("block", F.floor(F.col("offset") / block_bytes))
        .join(plan, ["source", "block"], "left")
    )
    named = {"mix_block": "block", "mix_release": "release", "mix_deadline": "deadline", "mix_slot": "slot", "mix_offset": "offset"}
    return placed.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], *[F.col(named[c]).alias(c) for c in COLUMNS])


def in_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """``mixed`` in training order, partition after partition, without a sampling pass.

    Each partition has an equal share of the slots; rows without a slot come
    last, in partitions of their own, as many as their share of the rows.
    """
    spark = mixed.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slot, offset = F.col("mix_slot"), F.col("mix_offset")
    seen = mixed.agg(F.max(slot).alias("last"), F.count("*").alias("n"), F.count_if(slot.isNull()).alias("none"), F.max(F.when(slot.isNull(), offset)).alias("far")).first()
    apart = min(partitions - 1, -(-partitions * seen["none"] // seen["n"])) if seen["none"] and seen["last"] is not None else 0
    first = partitions - apart
    part = F.least(F.floor(F.coalesce(slot, F.lit(0)) * first / ((seen["last"] or 0) + 1)), F.lit(first - 1))
    if apart:
        part = F.when(slot.isNull(), first + F.least(F.floor(offset * apart / (seen["far"] + 1)), F.lit(apart - 1))).otherwise(part)
    return mixed.repartitionById(partitions, part.cast("int")).sortWithinPartitions(slot.asc_nulls_last(), "mix_offset")
