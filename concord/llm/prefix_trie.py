"""The prefix trie of conversations: one row per distinct sequence of first turns, by splitter skeleton.

**Paths.** A turn is 16 bytes, the head of the SHA-256 of its role and text; a
conversation's path is the bytes of its turns one after the other, so the order
of paths as bytes is depth-first order of the trie, and texts are read once and
never shuffled. A path is one value: 16 bytes and a number for every turn of
*one* conversation.

**Splitters.** From a hash sample of the paths, whose number is set by the
number of shards, evenly spaced ``(path, id)`` keys are taken, each cut to the
shortest path that still lies behind the sampled key before it. Rows are dealt
to shards between those keys and sorted there. As the id is part of the key, a
group of equal paths, however large, is split over shards like any other rows.

**Skeleton.** A node that has members in two shards is a prefix of the splitter
between them. The prefixes of all splitters form the skeleton, a trie of at most
``SPLITTER_TURNS`` nodes a splitter, which is broadcast. A shard walks its sorted
rows with a stack of open nodes: every node outside the skeleton begins and ends
there and is finished on the spot. For a skeleton node the shard leaves partial
aggregates (members, smallest member, finished children, leaves, saved tokens
and the ids that end there, in pieces of bounded size), which are reduced by node.

**Parents.** A child ends before its parent's smallest member is known. The
shard's rows are therefore sorted once more within their partition, by the
place where a node began, and a second pass hands each parent's member down;
children of skeleton nodes get theirs from the reduced skeleton.

**Defined results.** Turns are ordered by number (null first; turns of one
number by the hash of role and text), null roles and texts are empty, repeated
rows are turns each. Rows without a conversation id take no part. Other columns
are ignored. An empty table has no members, hence no node, not even a root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.store import cut, python_workers, written

TURN = 16  # bytes of a turn in a path
SPLITTER_TURNS = 256  # a splitter's path is cut to so many turns: any key may split, a shorter one only less evenly
SAMPLED_PER_SHARD = 24
ID_PIECE = 1 << 16  # bytes of ids in one piece of a skeleton node
NODE = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"


# ------------------------------------------------------------------ conversations as paths


def paths(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    group: int = 1,
) -> DataFrame:
    """``(base, conv_id, turns)`` per conversation; ``turns``: array of ``(key, bytes)`` in order.

    ``key``: 16 bytes of SHA-256 over the role's length, role and text; ``bytes``: UTF-8
    bytes of the text. ``base`` is ``conv_id - conv_id % group``; rows are dealt by it, so
    that :func:`rebuilt` needs no shuffle of its own.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    conv = F.col(f"`{id_col}`").cast("long")
    rows = conversations.where(conv.isNotNull()).select(
        (conv - conv % group).alias("base"),
        conv.alias("conv_id"),
        F.struct(F.col(f"`{turn_col}`").alias("turn"), F.unhex(F.substring(digest, 1, 2 * TURN)).alias("key"), F.octet_length(text).cast("long").alias("bytes")).alias("t"),
    )
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes")))
    return rows.repartition("base").groupBy("base", "conv_id").agg(turns.alias("turns"))


def rebuilt(own: DataFrame, heads: int = 9) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation ``base``.

    ``h`` is ``crc32(decimal c) % heads``; all turns of that conversation if it
    has fewer, none if it is absent. Of a base only ``heads - 1`` turns go along.
    """
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    none = F.slice("turns", 1, 0)
    work = own.select("conv_id", "turns", F.coalesce(first, none).alias("head"), h.alias("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return work.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), tail).alias("turns"))


# ------------------------------------------------------------------ splitters and their trie


def common(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    n = min(len(a), len(b)) // TURN
    if a[: n * TURN] == b[: n * TURN]:
        return n
    x = np.frombuffer(a, np.uint8, n * TURN) != np.frombuffer(b, np.uint8, n * TURN)
    return int(x.argmax()) // TURN


def splitters(keys: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` keys, evenly spaced in the sorted sample, each cut to what sets it off from the one before."""
    keys = sorted(set(keys))
    out = []
    for i in sorted({k * len(keys) // shards for k in range(1, shards)} - {0}):
        (before, _), (path, at) = keys[i - 1], keys[i]
        keep = (common(before, path) + 1) * TURN
        out.append((path[:keep], at) if keep >= len(path) else (path[:keep], -(1 << 63)))
    return out


@dataclass
class Skeleton:
    """The trie of all prefixes of the splitters' paths; node 0 is the root."""

    keys: list[tuple[bytes, int]]
    children: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for path, _ in self.keys:
            at = 0
            for i in range(0, len(path), TURN):
                turn = path[i : i + TURN]
                if turn not in self.children[at]:
                    self.children[at][turn] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.children.append({})
                at = self.children[at][turn]

    def along(self, path: bytes) -> list[int]:
        """Skeleton nodes on a path, from the root down."""
        out, at = [0], 0
        for i in range(0, len(path), TURN):
            at = self.children[at].get(path[i : i + TURN], -1)
            if at < 0:
                break
            out.append(at)
        return out

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.keys, (path, conv))


def skeleton(rows: DataFrame, shards: int) -> Skeleton:
    """Splitters from some ``SAMPLED_PER_SHARD`` paths a shard, chosen by the hash of the id and cut to ``SPLITTER_TURNS``."""
    every = max(1, rows.count() // max(1, shards * SAMPLED_PER_SHARD))
    sampled = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select(F.substring("path", 1, SPLITTER_TURNS * TURN).alias("path"), "conv_id")
    return Skeleton(splitters([(bytes(r["path"]), r["conv_id"]) for r in sampled.collect()], shards))


# ------------------------------------------------------------------ the walk of one shard

#: kind 0: a finished node; 1: partial aggregates of a skeleton node; 2: ids that end in one
WALKED = pa.schema(
    [
        ("kind", pa.int8()), ("began", pa.int64()), ("skeleton", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("text_bytes", pa.int64()),
        ("ends", pa.string()), ("shard", pa.int32()), ("piece", pa.int32()),
    ]
)
WALKED_DDL = (
    "kind tinyint, began bigint, skeleton int, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved bigint, text_bytes bigint, ends string, shard int, piece int"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Open:
    """A node whose members are still coming."""

    __slots__ = ("began", "skeleton", "depth", "bytes", "convs", "low", "children", "leaves", "saved", "ends", "ids", "ids_bytes", "piece")

    def __init__(self, began: int, skeleton: int, depth: int, text_bytes: int):
        self.began, self.skeleton, self.depth, self.bytes = began, skeleton, depth, text_bytes
        self.convs = self.children = self.leaves = self.saved = self.ids_bytes = self.piece = 0
        self.low: int | None = None
        self.ends = None  # of a finished node: the running hash
        self.ids: list[str] = []  # of a skeleton node: ids of the piece at hand


class _Walk:
    """Rows of one shard in order of path, then id."""

    def __init__(self, trie: Skeleton, piece_bytes: int):
        self.trie, self.piece_bytes, self.shard, self.began = trie, piece_bytes, 0, 0
        self.path, self.stack, self.out = b"", [], []

    def row(self, shard: int, conv: int, path: bytes, text_bytes) -> None:
        if self.stack and shard != self.shard:
            self.close(0)
        if not self.stack:
            self.shard = shard
            self.open(0, 0)
            keep = 0
        else:
            keep = common(self.path, path)
            self.close(keep + 1)
        for d in range(keep, len(path) // TURN):
            above = self.stack[-1]
            turn = path[d * TURN : (d + 1) * TURN]
            self.open(self.trie.children[above.skeleton].get(turn, -1) if above.skeleton >= 0 else -1, int(text_bytes[d]))
        self.path = path
        top = self.stack[-1]
        top.convs += 1
        top.low = conv if top.low is None else min(top.low, conv)
        self.end(top, str(conv))

    def open(self, skeleton: int, text_bytes: int) -> None:
        self.stack.append(_Open(self.began, skeleton, len(self.stack), text_bytes))
        self.began += 1

    def end(self, node: _Open, text: str) -> None:
        if node.skeleton >= 0:
            node.ids.append(text)
            node.ids_bytes += len(text) + 1
            if node.ids_bytes >= self.piece_bytes:
                self.piece(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(text.encode())
        else:
            node.ends.update(b"," + text.encode())

    def piece(self, node: _Open) -> None:
        if node.ids:
            self.out.append((2, node.began, node.skeleton, node.depth, None, None, None, None, None, None, None, ",".join(node.ids), self.shard, node.piece))
            node.ids, node.ids_bytes, node.piece = [], 0, node.piece + 1

    def close(self, depth: int) -> None:
        """End all open nodes from ``depth`` down."""
        while len(self.stack) > depth:
            n = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            if n.skeleton >= 0:
                self.piece(n)
                self.out.append((1, n.began, n.skeleton, n.depth, n.low, None, n.convs, n.children, n.leaves, n.saved, n.bytes, None, self.shard, None))
            else:
                n.leaves, n.saved = n.leaves or 1, n.saved + (n.convs - 1) * n.bytes
                above_skeleton = above.skeleton if above is not None else -1
                ends = n.ends.hexdigest() if n.ends is not None else _NO_ENDS
                self.out.append((0, n.began, above_skeleton, n.depth, n.low, None, n.convs, n.children, n.leaves, n.saved, n.bytes, ends, self.shard, None))
                above.children += 1
                above.leaves += n.leaves
                above.saved += n.saved
            if above is not None:  # members and the smallest of them count for skeleton parents, too
                above.convs += n.convs
                if n.low is not None and (above.low is None or n.low < above.low):
                    above.low = n.low

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.out) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.out), WALKED)], schema=WALKED)
            self.out = []


def _walk(sorted_rows: DataFrame, trie: Skeleton) -> DataFrame:
    piece_bytes = ID_PIECE
    shared = sorted_rows.sparkSession.sparkContext.broadcast(trie)  # at most SPLITTER_TURNS nodes a shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(shared.value, piece_bytes)
        for b in batches:
            lengths = b.column("bytes")
            for shard, conv, path, k in zip(b.column("shard").to_pylist(), b.column("conv_id").to_pylist(), b.column("path").to_pylist(), range(b.num_rows)):
                walk.row(shard, conv, path, lengths[k].values.to_numpy(zero_copy_only=False))
                yield from walk.batches(1 << 13)
            yield from walk.batches()
        walk.close(0)
        yield from walk.batches()

    return sorted_rows.mapInArrow(run, WALKED_DDL)


def _hand_down(walked: DataFrame) -> DataFrame:
    """Fill ``parent_conv_id`` of finished nodes below finished nodes, in the order in which nodes began."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: list[int] = []  # smallest member by depth, along the open path
        at = WALKED.get_field_index("parent_conv_id")
        for b in batches:
            parents = []
            for kind, skeleton, depth, conv in zip(*(b.column(c).to_pylist() for c in ("kind", "skeleton", "depth", "conv_id"))):
                if kind != 0:
                    parents.append(None)
                    continue
                parents.append(None if skeleton >= 0 else above[depth - 1])
                del above[depth:]
                above.extend([0] * (depth - len(above)))
                above.append(conv)
            yield b.set_column(at, WALKED.field(at), pa.array(parents, pa.int64()))

    return walked.sortWithinPartitions("shard", "began", "kind").mapInArrow(run, WALKED_DDL)


# ------------------------------------------------------------------ reduction of the skeleton


def _ends(pieces: DataFrame) -> DataFrame:
    """``(skeleton, ends_sha256)``: the hash of a node's ids, streamed piece by piece in order of shard."""
    spark = pieces.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, None
        done = lambda: pa.RecordBatch.from_pydict({"skeleton": pa.array([node], pa.int32()), "ends_sha256": [hashed.hexdigest()]})
        for b in batches:
            for k, text in zip(b.column("skeleton").to_pylist(), b.column("ends").to_pylist()):
                if k != node:
                    if node is not None:
                        yield done()
                    node, hashed = k, hashlib.sha256(text.encode())
                else:
                    hashed.update(b"," + text.encode())
        if node is not None:
            yield done()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.select("skeleton", "shard", "piece", "ends").repartition(n, "skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    return dealt.mapInArrow(run, "skeleton int, ends_sha256 string")


def _reduced(partials: DataFrame, trie: Skeleton) -> DataFrame:
    """``(skeleton, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)`` of the skeleton's nodes.

    One row per skeleton node comes to the driver, where subtrees are added up from the deepest node.
    """
    sums = partials.groupBy("skeleton").agg(
        F.min("conv_id").alias("low"), F.sum("n_convs").alias("convs"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("text_bytes").alias("bytes"),
    )
    found = {r["skeleton"]: r.asDict() for r in sums.collect()}
    for k in sorted(found, key=lambda k: -trie.depth[k]):
        n = found[k]
        n["leaves"] = n["leaves"] or int(n["children"] == 0)
        n["saved"] += (n["convs"] - 1) * n["bytes"]
        if (above := found.get(trie.parent[k])) is not None:
            above["children"] += 1
            above["leaves"] += n["leaves"]
            above["saved"] += n["saved"]
    low = lambda k: found[k]["low"] if k in found else None
    rows = [(k, trie.depth[k], n["low"], low(trie.parent[k]), n["convs"], n["children"], n["leaves"], n["saved"]) for k, n in sorted(found.items())]
    schema = "skeleton int, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    return partials.sparkSession.createDataFrame(rows, schema)


# ------------------------------------------------------------------ the trie


def _path_of(turns: str) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["key"])), ""))


def trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie over ``conversations(conv_id, turns)`` as :func:`paths` or :func:`rebuilt` give it.

    One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    spark: SparkSession = conversations.sparkSession
    python_workers(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(
        conversations.select("conv_id", _path_of("turns").alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("bytes")), "trie-paths"
    )
    top = skeleton(rows, shards)
    shared = spark.sparkContext.broadcast(top)

    @F.pandas_udf("int")
    def shard_of(path, conv):
        import pandas as pd

        return pd.Series([shared.value.shard(bytes(p), int(c)) for p, c in zip(path, conv)], dtype="int32")

    dealt = rows.withColumn("shard", shard_of("path", "conv_id")).repartitionById(shards, F.col("shard"))
    walked = written(_hand_down(_walk(dealt.sortWithinPartitions("shard", "path", "conv_id"), top)), "trie-nodes")
    upper = cut(_reduced(walked.where("kind = 1"), top))
    ends = _ends(walked.where("kind = 2"))
    columns = [c.strip() for c in NODE.split(",")]
    own = upper.join(F.broadcast(ends), "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    above = upper.select("skeleton", F.col("conv_id").alias("above"))
    lower = walked.where("kind = 0").withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    lower = lower.join(F.broadcast(above), "skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return own.select(*columns).unionByName(lower.select(*columns))
