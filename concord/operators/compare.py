"""Row counts, distinct counts and multiset differences of a table pair.

The checks all rest on one plan shape: tag each side's rows, ``UNION ALL``
the two, and ``GROUP BY`` every compared column, counting rows per side
(``n1`` left, ``n2`` right). From those per-row-value counts follow

    row counts          sum(n1), sum(n2)
    distinct counts     count_if(n1 > 0), count_if(n2 > 0)
    multiset diffs      sum(greatest(n1 - n2, 0)), sum(greatest(n2 - n1, 0))

so :func:`compare` produces all six numbers from a single scan of each side
and one hash shuffle, where separate ``count`` / ``distinct().count()`` /
``exceptAll().count()`` actions read every side four times. The grouping
gets map-side partial aggregation for free, so a row value repeated across
a third of the table reaches its reducer as one partial row per map task.

``by=`` adds group keys: one result row per group (for example per
partition value, or per logical table of a multi-table dataset).

``method="digest"`` groups by a 128-bit digest of each row (two seeded
``xxhash64``) instead of the row itself: the shuffle then carries about 24
bytes per distinct row value instead of the whole row, which is what
matters for wide tables at scale. Row counts stay exact; distinct counts and
differences are exact unless two different row values share all 128 bits
(for 10^12 distinct values the chance is about 10^-15). Nested values are
hashed by their typed leaves at any depth, with NULL flags and lengths, so
nothing is lost to a text form; ``-0.0`` and ``0.0`` hash alike, and the order
of map entries does not count. The default is ``"exact"``.

``method="packed"`` is as exact as ``"exact"``: it groups by the same row values,
laid without loss into as few bits as their ranges need
(:mod:`concord.operators.packing`), so a row of narrow columns ships about half the
bytes. It reads both sides once more, to find the ranges, when the check is
built; the runner uses it for its exact profiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators import sketch
from concord.operators.align import AlignmentError, align, aligned_pairs, contains, drop_columns, quoted
from concord.operators.packing import packed_keys

PASSED = "Passed"
FAILED = "Failed"
NA = "NA"

# Every name of an intermediate column has this beginning; data columns must not.
_OWN = "__concord_"
_L, _R = "__concord_l", "__concord_r"
_N1, _N2 = "__concord_n1", "__concord_n2"
_M1, _M2 = "__concord_m1", "__concord_m2"
_K1, _K2 = "__concord_k1", "__concord_k2"
_E1, _E2 = "__concord_e1", "__concord_e2"
_H = ("__concord_h1", "__concord_h2")
_C = ("__concord_c1", "__concord_c2")
_P = "__concord_p"

# Result column names: they are the ledger's names (left = gen1, right = gen2).
COUNT_COLUMNS = ("gen1_count", "gen2_count")
DISTINCT_COLUMNS = ("gen1_distinct_count", "gen2_distinct_count")
EXCEPT_COLUMNS = ("gen1_except_gen2", "gen2_except_gen1")


def status(ok: Column) -> Column:
    return F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED))


def _by_names(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _check_by(left: DataFrame, right: DataFrame, by: list[str]) -> None:
    """Group keys must exist on both sides (case-insensitive)."""
    for side, df in (("left", left), ("right", right)):
        have = {c.lower() for c in df.columns}
        missing = [b for b in by if b.lower() not in have]
        if missing:
            raise AlignmentError(f"group keys missing on the {side} side: {missing}")


def _tagged(left: DataFrame, right: DataFrame, names) -> DataFrame:
    """Both sides in one frame, each row carrying (1, 0) or (0, 1)."""
    cols = [quoted(n) for n in names]
    lhs = left.select(*cols, F.lit(1).alias(_L), F.lit(0).alias(_R))
    rhs = right.select(*cols, F.lit(0).alias(_L), F.lit(1).alias(_R))
    return lhs.unionByName(rhs)


def _check_internal(names) -> None:
    clash = sorted(n for n in names if n.lower().startswith(_OWN))
    if clash:
        raise AlignmentError(f"column names reserved by concord: {clash}")


def _finish(stats: DataFrame, by: list[str], wanted: tuple[str, ...]) -> DataFrame:
    """Coalesce empty sums to 0, cast to bigint, add the status columns."""
    value = {c: F.coalesce(quoted(c), F.lit(0)).cast("bigint") for c in wanted}
    out = [quoted(b) for b in by] + [value[c].alias(c) for c in wanted]
    # one projection (every select is analysed on the driver, so fewer is faster to plan)
    if "gen1_count" in wanted:
        out.append(status(value["gen1_count"] == value["gen2_count"]).alias("count_validation"))
    if "gen1_distinct_count" in wanted:
        out.append(
            status(value["gen1_distinct_count"] == value["gen2_distinct_count"]).alias("dis_count_validation")
        )
    if "gen1_except_gen2" in wanted:
        out.append(status((value["gen1_except_gen2"] + value["gen2_except_gen1"]) == 0).alias("except_validation"))
    return stats.select(*out)


def _group_sizes(u: DataFrame, keys: list[Column]) -> DataFrame:
    return u.groupBy(*keys).agg(F.sum(_L).alias(_N1), F.sum(_R).alias(_N2))


def _normalised(col: Column, dtype: T.DataType) -> Column:
    """``-0.0`` as ``0.0``, as ``GROUP BY`` outputs it (other types as they are)."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(col == 0, F.lit(0).cast(dtype)).otherwise(col)
    return col


def _value_hash(col: Column, dtype: T.DataType, seed: Column) -> Column:
    """64-bit hash of one value of any type: typed leaves, NULL flags and lengths, never a text form.

    ``xxhash64`` skips NULL inputs, so each level hashes whether it is NULL.
    Arrays are folded in order; map entries are folded in the order of their
    key hashes, so the order of entries does not count.
    """
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.AtomicType):
        # Elements between their places, in generated code (a lambda would not be): a
        # NULL hashes its place twice and nothing between. An element that hashes like
        # its place gives it three times, so no value can pass for a NULL.
        places = F.sequence(F.lit(0).cast("bigint"), (F.size(col) - 1).cast("bigint"))
        return F.xxhash64(seed, col.isNull(), F.size(col), F.when(F.size(col) > 0, F.arrays_zip(places, col, places)))
    if isinstance(dtype, T.ArrayType):
        fold = F.aggregate(col, seed, lambda acc, x: F.xxhash64(acc, _value_hash(x, dtype.elementType, seed)))
        return F.xxhash64(seed, col.isNull(), F.size(col), fold)
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                _value_hash(e["key"], dtype.keyType, seed).alias("k"), _value_hash(e["value"], dtype.valueType, seed).alias("v")
            ),
        )
        fold = F.aggregate(F.array_sort(entries), seed, lambda acc, e: F.xxhash64(acc, e["k"], e["v"]))
        return F.xxhash64(seed, col.isNull(), F.size(col), fold)
    if isinstance(dtype, T.StructType):
        return F.xxhash64(seed, col.isNull(), *[_value_hash(col.getField(f.name), f.dataType, seed) for f in dtype.fields])
    return F.xxhash64(seed, col.isNull(), _normalised(col, dtype))


def _digest(u: DataFrame, names, out: tuple[str, str]) -> list[Column]:
    """Two seeded 64-bit hashes of the row: null bitmap first, then every value (nested ones by :func:`_value_hash`)."""
    types = {f.name: f.dataType for f in u.schema.fields}
    if not names:
        return [F.lit(0).cast("bigint").alias(out[0]), F.lit(0).cast("bigint").alias(out[1])]
    nulls = F.concat(*[F.when(quoted(n).isNull(), F.lit("1")).otherwise(F.lit("0")) for n in names])
    nested = (T.ArrayType, T.MapType, T.StructType)

    def values(seed: int) -> list[Column]:
        start = F.lit(seed).cast("bigint")
        return [
            _value_hash(quoted(n), types[n], start) if isinstance(types[n], nested) else _normalised(quoted(n), types[n])
            for n in names
        ]

    return [F.xxhash64(nulls, *values(1)).alias(out[0]), F.xxhash64(F.lit("concord"), nulls, *values(2)).alias(out[1])]


def _check_method(method: str, known: tuple[str, ...] = ("exact", "digest", "packed")) -> None:
    if method not in known:
        raise ValueError(f"unknown method {method!r}; use {' or '.join(map(repr, known))}")


def _packed(u: DataFrame, group: list[str], *name_lists: list[str]) -> tuple[DataFrame, list[list[Column]]]:
    """``u`` with the keys that stand for each list of columns in their place, and those keys."""
    keys = packed_keys(u, list(name_lists), _P)
    packed = u.select(*[quoted(b) for b in group], *[c.alias(n) for made in keys for n, c in made.items()], _L, _R)
    return packed, [[quoted(n) for n in made] for made in keys]


def _surplus(a: str, b: str) -> Column:
    return F.greatest(F.col(a) - F.col(b), F.lit(0))


def _stats(
    u: DataFrame, group: list[str], fine_keys: list[Column], coarse_keys: list[Column] | None, coarse_is_data: bool = True
) -> DataFrame:
    """The six numbers per ``group`` from the tagged union ``u``.

    ``fine_keys`` identify a row value of the check that looks at more
    columns, ``coarse_keys`` of the other one (None when both look at the
    same): the data check (``coarse_is_data``) or the distinct count. The
    coarse keys must be a function of the fine ones; one chain of two
    aggregates then gives both.
    """
    g1 = _group_sizes(u, [quoted(b) for b in group] + fine_keys)
    gkeys = [quoted(b) for b in group]
    if coarse_keys is None:
        return g1.groupBy(*gkeys).agg(
            F.sum(_N1).alias("gen1_count"),
            F.sum(_N2).alias("gen2_count"),
            F.count_if(F.col(_N1) > 0).alias("gen1_distinct_count"),
            F.count_if(F.col(_N2) > 0).alias("gen2_distinct_count"),
            F.sum(_surplus(_N1, _N2)).alias("gen1_except_gen2"),
            F.sum(_surplus(_N2, _N1)).alias("gen2_except_gen1"),
        )
    g2 = g1.groupBy(*gkeys, *coarse_keys).agg(
        F.sum(_N1).alias(_M1),
        F.sum(_N2).alias(_M2),
        F.count_if(F.col(_N1) > 0).alias(_K1),
        F.count_if(F.col(_N2) > 0).alias(_K2),
        F.sum(_surplus(_N1, _N2)).alias(_E1),
        F.sum(_surplus(_N2, _N1)).alias(_E2),
    )
    if coarse_is_data:
        distinct, rest = [F.sum(_K1), F.sum(_K2)], [F.sum(_surplus(_M1, _M2)), F.sum(_surplus(_M2, _M1))]
    else:
        distinct, rest = [F.count_if(F.col(_M1) > 0), F.count_if(F.col(_M2) > 0)], [F.sum(_E1), F.sum(_E2)]
    return g2.groupBy(*gkeys).agg(
        F.sum(_M1).alias("gen1_count"),
        F.sum(_M2).alias("gen2_count"),
        *[c.alias(n) for c, n in zip(distinct + rest, DISTINCT_COLUMNS + EXCEPT_COLUMNS)],
    )


def compare(
    left: DataFrame,
    right: DataFrame,
    *,
    ignore=(),
    ignore_distinct=None,
    align_by: str = "name",
    by=None,
    method: str = "exact",
) -> DataFrame:
    """All counts and differences of a pair, in one pass.

    ``ignore`` are the columns left out of the multiset difference (audit
    columns); ``ignore_distinct`` those left out of the distinct count
    (defaults to ``ignore``). Columns named in ``by`` are group keys and are
    never ignored. ``method`` is ``"exact"``, ``"packed"`` or ``"digest"`` (see module doc).

    Returns one row (or one per group) with ``gen1_count, gen2_count,
    gen1_distinct_count, gen2_distinct_count, gen1_except_gen2,
    gen2_except_gen1, count_validation, dis_count_validation,
    except_validation``.
    """
    _check_method(method)
    by = _by_names(by)
    _check_by(left, right, by)
    lower_by = {b.lower() for b in by}
    ignore = [c for c in (ignore or ()) if c.lower() not in lower_by]
    ignore_distinct = ignore if ignore_distinct is None else [
        c for c in ignore_distinct if c.lower() not in lower_by
    ]
    wanted = COUNT_COLUMNS + DISTINCT_COLUMNS + EXCEPT_COLUMNS

    # Distinct rows are counted over the columns kept by the distinct list, the
    # multiset difference over those kept by the data list. One list's pairs of
    # columns must hold the other's; by position, two lists may pair columns
    # differently, even if the names on the left are the same.
    distinct_pairs = aligned_pairs(left, right, ignore_distinct, align_by)
    data_pairs = aligned_pairs(left, right, ignore, align_by)
    group = [b.lower() if align_by == "name" else b for b in by]

    coarse_is_data = set(data_pairs) <= set(distinct_pairs)
    if not coarse_is_data and not set(distinct_pairs) <= set(data_pairs):
        # Unrelated lists: two aggregates, merged by a union and a max per
        # group (one row each side of the union per group, no join).
        cnt = compare(left, right, ignore=ignore, align_by=align_by, by=by, method=method).select(
            *[quoted(b) for b in group], *COUNT_COLUMNS, *EXCEPT_COLUMNS
        )
        dis = distinct_count_check(
            left, right, ignore=ignore_distinct, align_by=align_by, by=by, method=method
        ).select(*[quoted(b) for b in group], *DISTINCT_COLUMNS)
        merged = cnt.unionByName(dis, allowMissingColumns=True)
        stats = merged.groupBy(*[quoted(b) for b in group]).agg(*[F.max(c).alias(c) for c in wanted])
        return _finish(stats, group, wanted)

    fine = align(left, right, ignore_distinct if coarse_is_data else ignore, align_by)
    _check_internal(fine.names)
    fine_names = [n for n in fine.names if n not in group]
    coarse_only = [n for n, _ in (data_pairs if coarse_is_data else distinct_pairs) if n not in group]
    u = _tagged(fine.left, fine.right, fine.names)
    same = set(data_pairs) == set(distinct_pairs)
    if method == "exact":
        fine_keys = [quoted(n) for n in fine_names]
        coarse_keys = None if same else [quoted(n) for n in coarse_only]
    elif method == "packed" and same:
        u, (fine_keys,) = _packed(u, group, fine_names)
        coarse_keys = None
    elif method == "packed":
        u, (coarse_keys, rest) = _packed(u, group, coarse_only, [n for n in fine_names if n not in coarse_only])
        fine_keys = coarse_keys + rest
    else:
        digests = _digest(u, fine_names, _H) + ([] if same else _digest(u, coarse_only, _C))
        u = u.select(*[quoted(b) for b in group], *digests, _L, _R)
        fine_keys = [F.col(h) for h in _H] + ([] if same else [F.col(c) for c in _C])
        coarse_keys = None if same else [F.col(c) for c in _C]
    return _finish(_stats(u, group, fine_keys, coarse_keys, coarse_is_data), group, wanted)


def row_count_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """``gen1_count, gen2_count, count_validation`` in one job.

    No column is read: both scans project nothing but the side tags, and
    each map task pre-counts before the single-partition merge.
    """
    lhs = left.select(F.lit(1).alias(_L), F.lit(0).alias(_R))
    rhs = right.select(F.lit(0).alias(_L), F.lit(1).alias(_R))
    stats = lhs.unionByName(rhs).agg(F.sum(_L).alias("gen1_count"), F.sum(_R).alias("gen2_count"))
    return _finish(stats, [], COUNT_COLUMNS)


def distinct_count_check(
    left: DataFrame, right: DataFrame, *, ignore=(), align_by: str = "name", by=None, method: str = "exact"
) -> DataFrame:
    """Distinct-row counts of both sides after dropping ``ignore``.

    The verdict compares the left count with the right one (the historical
    check compared the left count with itself and so always passed).
    """
    _check_method(method)
    by = _by_names(by)
    _check_by(left, right, by)
    pair = align(left, right, ignore, align_by)
    _check_internal(pair.names)
    group = [b.lower() if align_by == "name" else b for b in by]
    u = _tagged(pair.left, pair.right, pair.names)
    names = [n for n in pair.names if n not in group]
    if method == "exact":
        keys = [quoted(n) for n in names]
    elif method == "packed":
        u, (keys,) = _packed(u, group, names)
    else:
        u = u.select(*[quoted(b) for b in group], *_digest(u, names, _H), _L, _R)
        keys = [F.col(h) for h in _H]
    per_value = u.groupBy(*[quoted(b) for b in group], *keys).agg(F.max(_L).alias(_N1), F.max(_R).alias(_N2))
    stats = per_value.groupBy(*[quoted(b) for b in group]).agg(
        F.sum(_N1).alias("gen1_distinct_count"), F.sum(_N2).alias("gen2_distinct_count")
    )
    return _finish(stats, group, DISTINCT_COLUMNS)


def diff_counts(
    left: DataFrame, right: DataFrame, *, ignore=(), align_by: str = "name", by=None, method: str = "exact"
) -> DataFrame:
    """Sizes of both multiset differences: ``gen1_except_gen2, gen2_except_gen1, except_validation``.

    With ``method="fingerprint"`` rows of equal buckets are not shuffled
    (:func:`concord.operators.sketch.equality`).
    """
    if method == "fingerprint":
        out = sketch.equality(left, right, ignore=ignore, align_by=align_by, by=by)
        return out.drop(*COUNT_COLUMNS, "count_validation")
    _check_method(method)
    by = _by_names(by)
    _check_by(left, right, by)
    pair = align(left, right, ignore, align_by)
    _check_internal(pair.names)
    group = [b.lower() if align_by == "name" else b for b in by]
    u = _tagged(pair.left, pair.right, pair.names)
    names = [n for n in pair.names if n not in group]
    if method == "exact":
        keys = [quoted(n) for n in names]
    elif method == "packed":
        u, (keys,) = _packed(u, group, names)
    else:
        u = u.select(*[quoted(b) for b in group], *_digest(u, names, _H), _L, _R)
        keys = [F.col(h) for h in _H]
    g = _group_sizes(u, [quoted(b) for b in group] + keys)
    stats = g.groupBy(*[quoted(b) for b in group]).agg(
        F.sum(_surplus(_N1, _N2)).alias("gen1_except_gen2"),
        F.sum(_surplus(_N2, _N1)).alias("gen2_except_gen1"),
    )
    return _finish(stats, group, EXCEPT_COLUMNS)


SIDE = "_side"
_CHUNK = 1 << 16


def diff_rows(
    left: DataFrame,
    right: DataFrame,
    *,
    ignore=(),
    align_by: str = "name",
    side_col: str = SIDE,
    chunk: int = _CHUNK,
    method: str = "exact",
) -> DataFrame:
    """The rows of both multiset differences, with ``side_col`` = 'left' / 'right'.

    ``left EXCEPT ALL right`` is ``where side = 'left'``. A row value that is
    k times more frequent on one side appears k times. Large k are cut into
    chunks of ``chunk`` copies that are hash-spread over tasks before being
    expanded, so one hot duplicated value never lands in a single task.

    With ``method="digest"`` the differing row values are found by digest
    first (a shuffle of ~24 bytes per row value); a second scan fetches the
    rows whose digest may differ (a bit map of the differing digests, 4 MB
    whatever the tables, is broadcast), reduces them to one row per value and
    joins the counts. Beyond some ten million differing values the bit map
    lets more and more other rows through; the result stays exact.

    With ``method="sketch"`` the differing digests come out of an invertible
    table whose size follows the difference (:mod:`concord.operators.sketch`), so
    finding them shuffles no row, and no digest unless the difference is large; the rows
    are then fetched as above, with a bit map that grows with the difference (up to 64 MB),
    so that it lets few other rows through. This runs its passes when it is called.
    """
    if method != "sketch":
        _check_method(method, ("exact", "digest"))
    pair = align(left, right, ignore, align_by)
    _check_internal(pair.names)
    if side_col in pair.names:
        raise AlignmentError(f"side column {side_col!r} clashes with a data column")
    u = _tagged(pair.left, pair.right, pair.names)
    names = [quoted(n) for n in pair.names]
    if method == "exact":
        g = _group_sizes(u, names).where(F.col(_N1) != F.col(_N2))
    else:
        types = {f.name: f.dataType for f in u.schema.fields}
        hu = u.select(*names, *_digest(u, pair.names, _H), _L, _R)
        if method == "sketch":
            found = sketch.differing_digests(sketch.signed_digests(hu))
            zero = F.lit(0).cast("bigint")
            counts = found.select(*_H, F.greatest("c", zero).alias(_N1), F.greatest(-F.col("c"), zero).alias(_N2))
            buckets = _buckets_for(found.count())  # written by the pass before
        else:
            buckets = _BUCKETS
            counts = _group_sizes(hu.select(*_H, _L, _R), [F.col(h) for h in _H]).where(F.col(_N1) != F.col(_N2))
        # second pass: a filter of bounded size drops nearly all other rows in the
        # scan; copies of what is left collapse on the map side before the exchange
        kept = _with_marked_digests(hu, counts, buckets).drop(_L, _R)
        values = kept.groupBy(*_H).agg(*[F.any_value(_normalised(quoted(n), types[n])).alias(n) for n in pair.names])
        g = values.join(counts, list(_H), "inner").drop(*_H)
    n = F.abs(F.col(_N1) - F.col(_N2))
    d = (
        g.withColumn(side_col, F.when(F.col(_N1) > F.col(_N2), F.lit("left")).otherwise(F.lit("right")))
        .withColumn("__concord_n", n)
        .withColumn("__concord_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("__concord_n") - 1) / chunk).cast("bigint"))))
        .withColumn(
            "__concord_k",
            F.least(F.lit(chunk).cast("bigint"), F.col("__concord_n") - F.col("__concord_c") * chunk),
        )
    )
    hashable = [
        quoted(f.name)
        for f in d.schema.fields
        if f.name in pair.names and not contains(f.dataType, T.MapType)
    ]
    # An explicit partition count: adaptive execution never coalesces such a
    # shuffle, which it would otherwise do from the (tiny) pre-expansion size.
    d = d.repartition(_spread_partitions(d), F.xxhash64(*hashable, F.col("__concord_c"), F.col(side_col)))
    d = d.withColumn("__concord_r", F.explode(F.sequence(F.lit(1), F.col("__concord_k"))))
    return d.select(*[quoted(n) for n in pair.names], F.col(side_col))


_BUCKETS, _BITS = 1024, 32768  # bit maps of 4 KB each: 4 MB in all
_MOST_BUCKETS = 16 * _BUCKETS


def _buckets_for(n: int) -> int:
    """Bit maps for ``n`` digests: 16 bits each, so about one other row in 16 passes, within 4 to 64 MB."""
    return min(_MOST_BUCKETS, max(_BUCKETS, -(-16 * n // _BITS)))


def _with_marked_digests(rows: DataFrame, digests: DataFrame, buckets: int = _BUCKETS) -> DataFrame:
    """Rows whose digest is in ``digests``, and a few others: by a bit map of one hash."""

    def place(df: DataFrame) -> DataFrame:
        at = F.pmod(F.col(_H[0]), F.lit(buckets * _BITS))
        return df.withColumns({"__concord_b": F.floor(at / _BITS).cast("int"), "__concord_o": (at % _BITS).cast("bigint")})

    bits = place(digests).groupBy("__concord_b").agg(F.bitmap_construct_agg("__concord_o").alias("__concord_bits"))
    byte = F.expr("cast(conv(hex(substring(__concord_bits, cast(__concord_o div 8 as int) + 1, 1)), 16, 10) as int)")
    marked = F.expr("cast(__concord_o % 8 as int)")
    hit = F.call_function("getbit", byte, marked) == 1
    return place(rows).join(F.broadcast(bits), "__concord_b").where(hit).drop("__concord_b", "__concord_o", "__concord_bits")


def _spread_partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, or one per task slot if there are more slots.

    The slots alone won't do: under dynamic allocation they are those of the
    executors that happen to be registered when the plan is built.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        return max(partitions, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote session
        return partitions


def except_all(
    left: DataFrame, right: DataFrame, *, ignore=(), align_by: str = "name", method: str = "exact"
) -> DataFrame:
    """``left EXCEPT ALL right`` over aligned columns."""
    return (
        diff_rows(left, right, ignore=ignore, align_by=align_by, method=method)
        .where(F.col(SIDE) == "left")
        .drop(SIDE)
    )


__all__ = [
    "FAILED",
    "NA",
    "PASSED",
    "compare",
    "diff_counts",
    "diff_rows",
    "distinct_count_check",
    "drop_columns",
    "except_all",
    "row_count_check",
    "status",
]
