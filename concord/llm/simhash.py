"""SimHash near-duplicates: fingerprints, and a binary trie self-join over them.

**Links.** Two fingerprints that differ in at most ``max_bits`` bits, cut into
``blocks`` blocks of bits, agree on at least ``blocks - max_bits`` of them. For
each choice of so many blocks a copy of the fingerprint is dealt to the bucket
of their values, with its bits rearranged so that these come first. Inside a
bucket a binary trie over the remaining bits is joined with itself: node pairs
are followed together from the top, the bits in which they differ are added
up, and a pair over the budget is dropped with all that lies below it. All
buckets of a task are one trie whose first bits are the bucket. This is exact:
no pair is missed and none is added.

**Skew.** Equal fingerprints are one node from the start, so a group of exact
copies costs one row. A bucket with more than ``chunk`` fingerprints is split
into chunks, and each pair of chunks is a work unit of its own. A unit returns
a spanning forest of its links, never the pairs, so what is written grows with
the fingerprints and not with the square of a group.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.components import connected_components
from concord.llm.store import python_workers, written

_PIECE = 1 << 20  # bytes of a text that are taken at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(data):
        end = at + _PIECE
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the ``shingle``-word shingles of a whole text (A-Z lower-cased).

    A text of fewer words is one shingle; one without words (null, empty,
    white space) has the fingerprint zero. Memory is bounded: words are taken
    in pieces, with the last words of a piece carried over.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    votes, n, carry = np.zeros(64, np.int64), 0, []
    for words in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carry + words
        shingles = zip(*(words[k:] for k in range(shingle)), strict=False)
        hashes = np.array([digest(b" ".join(s), seed) for s in shingles], dtype="<u8")
        if len(hashes):
            n += len(hashes)
            for part in range(0, len(hashes), 1 << 14):
                bits = np.unpackbits(hashes[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                votes += bits.sum(axis=0, dtype=np.int64)
        carry = words[-(shingle - 1) :] if shingle > 1 else []
        if len(words) < shingle:
            carry = words
    if not n and carry:
        hashes = np.array([digest(b" ".join(carry), seed)], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8), bitorder="little")
        n = 1
    return sum(1 << k for k in np.flatnonzero(2 * votes > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, more: Sequence[str] = ()) -> DataFrame:
    """``(id, fp)`` and the columns ``more``: one row per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    python_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view("<i8")), *batch.columns[2:]], ["id", "fp", *more])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *more)
    kept = "".join(f", {c} {narrow.schema[c].dataType.simpleString()}" for c in more)
    return narrow.mapInArrow(run, f"id long, fp long{kept}")


# ------------------------------------------------------------------ trie self-join


def _expand(a: tuple, b: tuple, err: np.ndarray, depth: int, fps: np.ndarray, budget: int):
    """The node pairs one bit below the node pairs ``(a, b)``; a node is a run ``lo:hi`` of sorted ``fps``."""
    bit = np.uint64(1 << (63 - depth))
    keep = np.uint64(((1 << depth) - 1) << (64 - depth)) if depth else np.uint64(0)

    def halves(lo, hi):
        mid = np.searchsorted(fps, (fps[lo] & keep) | bit)
        mid = np.minimum(np.maximum(mid, lo), hi)
        return (lo, mid), (mid, hi)

    (a0, a1), (b0, b1) = halves(*a), halves(*b)
    same = a[0] == b[0]
    out = []
    for x, y, more, only in ((a0, b0, 0, None), (a1, b1, 0, None), (a0, b1, 1, None), (a1, b0, 1, ~same)):
        ok = (x[0] < x[1]) & (y[0] < y[1]) & (err + more <= budget)
        if only is not None:
            ok &= only
        if ok.any():
            out.append((x[0][ok], x[1][ok], y[0][ok], y[1][ok], err[ok] + more))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


def _pairs(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    """All members of the given small node pairs."""
    na, nb = ahi - alo, bhi - blo
    each = na * nb
    which = np.repeat(np.arange(len(each)), each)
    k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return alo[which] + k // nb[which], blo[which] + k % nb[which]


def trie_links(fps: np.ndarray, roots: tuple, depth: int, budget: int, small: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted unsigned ``fps`` that differ in at most ``budget`` bits, some at a time.

    ``roots``: node pairs (alo, ahi, blo, bhi) at ``depth``, where both sides
    of a pair agree on the bits above; a pair of a node with itself gives each
    pair of members once. A pair of leaves (of up to ``small`` member pairs) is
    compared in all the bits that are left at once.
    """
    stack = [(depth, *[np.asarray(x) for x in roots], np.zeros(len(roots[0]), np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > 1 << 17:  # depth first: a bounded number of node pairs at a time
            half = len(alo) // 2
            stack += [(depth, *[x[part] for x in (alo, ahi, blo, bhi, err)]) for part in (slice(half), slice(half, None))]
            continue
        done = ((ahi - alo) * (bhi - blo) <= small) if depth < 64 else np.ones(len(alo), bool)
        if done.any():
            for part in _blocks((ahi - alo)[done] * (bhi - blo)[done]):
                x, y = _pairs(*[v[done][part] for v in (alo, ahi, blo, bhi)])
                near = (np.bitwise_count(fps[x] ^ fps[y]) <= budget) & (x != y)
                if near.any():
                    yield x[near], y[near]
        rest = ~done
        if rest.any():
            below = _expand((alo[rest], ahi[rest]), (blo[rest], bhi[rest]), err[rest], depth, fps, budget)
            if below is not None:
                stack.append((depth + 1, *below))


def _blocks(sizes: np.ndarray, most: int = 1 << 21) -> Iterator[slice]:
    """Runs of node pairs with about ``most`` member pairs together."""
    group = (np.cumsum(sizes) - sizes) // most
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)]])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield slice(a, b)


def union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the sets of ``x`` and ``y`` in ``label`` (each label is the smallest index of its set)."""
    while True:
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return
        x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
        low = np.minimum(lx, ly)
        np.minimum.at(label, lx, low)
        np.minimum.at(label, ly, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _forest(fps: np.ndarray, node: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) links of ascending ``fps``; runs that agree on ``depth`` leading bits are joined."""
    top = fps >> np.uint64(64 - depth)
    starts = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    ends = np.append(starts[1:], len(fps))
    several = ends - starts > 1
    lo, hi = starts[several], ends[several]
    label = np.arange(len(fps))
    for x, y in trie_links(fps, (lo, hi, lo, hi), depth, budget):
        union(label, x, y)
    root = np.full(len(fps), np.iinfo(np.int64).max)
    np.minimum.at(root, label, node)
    root = root[label]
    linked = root != node
    return node[linked], root[linked]


def _tables(blocks: int, max_bits: int) -> tuple[list[int], list[tuple[int, ...]]]:
    """Widths of the blocks, and the choices of blocks that a pair may agree on."""
    if not 0 < max_bits < blocks <= 32:
        raise ValueError("more blocks than differing bits are needed, 32 at most")
    widths = [64 // blocks + (k < 64 % blocks) for k in range(blocks)]
    return widths, list(itertools.combinations(range(blocks), blocks - max_bits))


def _rearranged(fp: Column, widths: list[int], first: tuple[int, ...]) -> Column:
    """The bits of ``fp`` with the blocks ``first`` moved to the top; distances stay."""
    order = [*first, *(k for k in range(len(widths)) if k not in first)]
    out, at = F.lit(0).cast("long"), 64
    for k in order:
        at -= widths[k]
        start = 64 - sum(widths[: k + 1])
        mask = F.lit((1 << widths[k]) - 1).cast("long")
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, start).bitwiseAND(mask), at))
    return out


def near_links(distinct: DataFrame, max_bits: int = 4, blocks: int = 6, chunk: int = 1 << 13, batch_rows: int = 1 << 18) -> DataFrame:
    """Spanning links ``(a, b)`` of ``distinct(fp, node)``, one row per fingerprint.

    ``a`` and ``b`` (the smaller) are nodes whose fingerprints are connected by
    steps of at most ``max_bits`` bits; linked fingerprints end up connected.
    """
    python_workers(distinct.sparkSession)
    widths, tables = _tables(blocks, max_bits)
    depths = [sum(widths[k] for k in t) for t in tables]
    copies = [F.struct(F.lit(k).alias("t"), F.lit(64 - d).alias("rest"), _rearranged(F.col("fp"), widths, t).alias("bits")) for k, (t, d) in enumerate(zip(tables, depths, strict=True))]
    dealt = distinct.select("node", F.inline(F.array(*copies))).select("node", "t", "bits", F.expr("shiftrightunsigned(bits, rest)").alias("key"))
    full = dealt.groupBy("t", "key").count().where(F.col("count") > chunk)
    full = full.select("t", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    units = (
        dealt.join(full, ["t", "key"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("c", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .where("chunks = 1 or c <> o")
        .select("node", "t", "bits", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
        .repartition("t", "key", "i", "j")
        .sortWithinPartitions("t", "i", "j", "key")
    )

    def forests(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        node, t, bits, i, j = (table.column(c).to_numpy() for c in ("node", "t", "bits", "i", "j"))
        fps = bits.view("<u8")
        order = np.lexsort((fps, j, i, t))
        node, t, fps, i, j = node[order], t[order], fps[order], i[order], j[order]
        cut = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        out = [_forest(fps[a:b], node[a:b], depths[t[a]], max_bits) for a, b in zip(cut, np.append(cut[1:], len(t)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0  # whole buckets of about batch_rows rows; units are bounded by 2 x chunk
        for batch in batches:
            if not batch.num_rows:
                continue
            if n >= batch_rows:
                same = _same_bucket(held[-1], batch)
                if same < batch.num_rows:
                    yield forests([*held, batch.slice(0, same)])
                    held, n, batch = [], 0, batch.slice(same)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield forests(held)

    return units.mapInArrow(run, "a long, b long")


def _same_bucket(before: pa.RecordBatch, batch: pa.RecordBatch) -> int:
    """How many leading rows of ``batch`` belong to the bucket that ``before`` ends with."""
    same = np.ones(batch.num_rows, bool)
    for c in ("t", "i", "j", "key"):
        same &= batch.column(c).to_numpy() == before.column(c)[-1].as_py()
    return batch.num_rows if same.all() else int(np.argmin(same))


def _components(fps: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """``(fp, label, component)`` for the fingerprints of ``fps(id, fp)``: the smallest id of those that links reach (null: no id).

    ``label``: the smallest of those fingerprints. The nodes are the fingerprints themselves: rows that share an id but not a fingerprint are not linked by it.
    """
    distinct = fps.groupBy("fp").agg(F.min("id").alias("low"))
    parts = connected_components(near_links(distinct.select("fp", F.col("fp").alias("node")), max_bits, blocks))
    own = distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("label"))
    lows = own.groupBy("label").agg(F.min("low").alias("component"))
    return own.join(lows, "label").select("fp", "label", "component")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, blocks: int = 6
) -> DataFrame:
    """``(id, fingerprint, component)``: one row per row of ``docs``.

    ``fingerprint``: 16 lower-case hex digits. ``component``: the smallest id
    that is reachable by links of at most ``max_bits`` differing bits, a row's
    own included. Null, empty and short texts have defined fingerprints (see
    :func:`fingerprint`) and link like any other. Repeated rows have one
    component; rows that share an id but not their text link by their own
    texts. A row without id takes the component of its fingerprint (null
    if only such rows have it) and is never its smallest id. Columns besides
    the two named ones are not looked at; an empty table gives no rows.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    own = _components(fps, max_bits, blocks).select("fp", "component")
    return fps.join(own, "fp", "left").select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component")


def _text_key(text_col: str) -> Column:
    """128 bits of a text, by which a row's text is known without it; null counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, blocks: int = 6) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of linked texts, that with the smallest id.

    A row goes only if its own text is linked or equal to that of a row that
    stays: rows that share an id but hold unlike texts are groups of their own.
    Of rows with the smallest id of a group that with the smallest text key stays,
    of wholly repeated rows one. Rows without an id cannot be told apart and stay all.

    What stays is decided on ids and keys; whole rows are then filtered once.
    """
    key = _text_key(text_col)
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    narrow = known.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), key.alias("key"))
    fps = written(fingerprints(narrow, "id", "text", shingle, ["key"]), "simhash")
    own = fps.join(_components(fps, max_bits, blocks).withColumnRenamed("fp", "fp_"), F.col("fp") == F.col("fp_"))
    # the smallest id of one group may occur in another as well, so groups are told apart by their label
    low = own.groupBy("label").agg(F.min(F.struct("id", "key")).alias("first"))
    first = low.select(F.col("first.id").alias("kept_id"), F.col("first.key").alias("kept_key")).distinct()
    rows = known.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").cast("long").alias("kept_id"), key.alias("kept_key"))
    one = rows.join(first, ["kept_id", "kept_key"], "left_semi").dropDuplicates(["kept_id", "kept_key"])
    return one.select("doc.*").unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
