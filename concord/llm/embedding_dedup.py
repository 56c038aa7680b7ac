"""Embedding near-dedup: int8 tile products under rigorous error bounds.

Unit vectors ``x`` are rounded to int8 codes ``q`` with a scale ``s`` of their
own, and the length ``e`` of ``x - s q`` is measured. As ``|x| = 1``,

    |x . y - s_x s_y (q_x . q_y)|  <=  e_x + e_y + e_x e_y

holds for any two of them. A pair that this leaves below the threshold is no
link and one that it leaves above is one; only the pairs between are computed
again in double precision. Products of codes are whole numbers below 2**24 for
up to 1,040 components (longer vectors are added up in parts), so the float32
matrix product gives them exactly.

Equal vectors are one row with a multiplicity from the start. Vectors are
encoded once and cut into tiles of codes, and each pair of tiles is a unit: a
tile travels to its units as one byte a component, with scale and error. A unit
returns the number of sure links of each vector, a spanning forest of them and
the rows that have a pair left open; only those meet again, unit by unit,
with their full vectors. Pairs are never rows, so a group of near copies costs
rows in proportion to its members. Comparing all vectors is quadratic in the
number of different vectors, as the method is; memory per task is two tiles,
whose rows are bounded by ``tile_bytes`` of codes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.components import connected_components
from concord.llm.simhash import union
from concord.llm.store import python_workers, written
from concord.llm.tiles import finite, per_unit, tiles_for

_EXACT = 1040  # 1040 * 127 * 127 < 2 ** 24
_TILES, _SMALL = 8, 1 << 10  # so many tiles at least, unless they would be smaller than this


class Codes:
    """Vectors by their int8 codes, scales and rounding errors; ``data`` and ``norms`` where they are at hand in full."""

    def __init__(self, codes: np.ndarray, scale: np.ndarray, error: np.ndarray, data: np.ndarray | None = None):
        self.codes, self.scale, self.error = codes, scale, error
        if data is not None:
            self.data, self.norms = _sized(data)


def _sized(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their lengths; those of subnormal or huge components are brought to a largest component of 1 first."""
    with np.errstate(over="ignore"):
        norms = np.sqrt(np.einsum("ij,ij->i", data, data))
    odd = ~np.isfinite(norms) | (norms < 1e-100)
    if odd.any():
        data = data.copy()
        data[odd] /= np.abs(data[odd]).max(axis=1, keepdims=True)
        norms = np.sqrt(np.einsum("ij,ij->i", data, data))
    return data, norms


def encode(data: np.ndarray) -> Codes:
    """The codes of the rows of a matrix of vectors, none of them zero."""
    scaled, norms = _sized(data)
    unit = scaled / norms[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1)) + 1e-12
    return Codes(codes.astype(np.int8), scale, error, data)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes."""
    out = a[:, :_EXACT].astype(np.float32) @ b[:, :_EXACT].astype(np.float32).T
    for at in range(_EXACT, a.shape[1], _EXACT):
        out = out.astype(np.float64)
        out += a[:, at : at + _EXACT].astype(np.float32) @ b[:, at : at + _EXACT].astype(np.float32).T
    return out


def tile_pairs(x: Codes, y: Codes, threshold: float, same: bool, products: int = 1 << 23):
    """``(i, j, sure)``: index pairs that may be links, with those that the bound proves marked; a stripe of rows at a time.

    ``same``: both are one tile, and each pair comes once.
    """
    if not len(x.codes) or not len(y.codes):
        return
    worst, largest = y.error.max(), y.scale.max()
    stripe = max(1, products // len(y.codes))
    for at in range(0, len(x.codes), stripe):
        rows = slice(at, at + stripe)
        begin = at if same else 0
        product = _products(x.codes[rows], y.codes[begin:])
        need = threshold - x.error[rows] - worst - x.error[rows] * worst
        least = np.where(need > 0, need / (x.scale[rows] * largest), -np.inf) * (1 - 1e-6)
        i, j = np.nonzero(product >= least[:, None])
        near = x.scale[at + i] * y.scale[begin + j] * product[i, j]
        slack = x.error[at + i] + y.error[begin + j] + x.error[at + i] * y.error[begin + j] + 1e-9
        possible = near + slack >= threshold
        if same:
            possible &= at + i < begin + j
        if possible.any():
            yield at + i[possible], begin + j[possible], near[possible] - slack[possible] >= threshold


def open_links(x: Codes, y: Codes, threshold: float, same: bool):
    """The pairs that :func:`tile_pairs` leaves open and that have a cosine >= ``threshold`` in double precision."""
    for i, j, sure in tile_pairs(x, y, threshold, same):
        i, j = i[~sure], j[~sure]
        for part in range(0, len(i), 1 << 17):
            a, b = i[part : part + (1 << 17)], j[part : part + (1 << 17)]
            cos = np.einsum("ij,ij->i", x.data[a], y.data[b]) / (x.norms[a] * y.norms[b])
            linked = cos >= threshold
            if linked.any():
                yield a[linked], b[linked]


_CODED = "id long, extra long, dim int, code binary, scale double, error double, vector array<double>"
_CODE_TILE = "dim int, tile int, rows int, ids binary, extra binary, codes binary, scale binary, error binary"
_FOUND = "dim int, i int, j int, side int, id long, links long, root long"
_LINKS = "id long, links long, root long"


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _coded(batches):
    """Codes of a stream of vectors, those of one length together."""
    names = [c.split(" ")[0] for c in _CODED.split(", ")]
    for batch in batches:
        lengths = batch.column("dim").to_numpy()
        for dim in np.unique(lengths).tolist():
            rows = pa.Table.from_batches([batch]).filter(pa.array(lengths == dim))
            made = encode(_matrix(rows.column("vector"), dim))
            columns = {c: rows.column(c) for c in ("id", "extra", "dim", "vector")}
            columns |= {"code": pa.array([c.tobytes() for c in made.codes], pa.binary()), "scale": pa.array(made.scale), "error": pa.array(made.error)}
            yield from pa.table({n: columns[n] for n in names}).to_batches()


def _tile(table: pa.Table) -> pa.Table:
    table = table.take(pa.array(np.argsort(table.column("id").to_numpy(), kind="stable")))
    raw = lambda c, t: pa.array([table.column(c).to_numpy().astype(t).tobytes()], pa.binary())
    return pa.table(
        {
            "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
            "tile": pa.array([table.column("tile")[0].as_py()], pa.int32()),
            "rows": pa.array([len(table)], pa.int32()),
            "ids": raw("id", "<i8"),
            "extra": raw("extra", "<i8"),
            "codes": pa.array([b"".join(table.column("code").to_pylist())], pa.binary()),
            "scale": raw("scale", "<f8"),
            "error": raw("error", "<f8"),
        }
    )


class _Links:
    """Numbers of links and a spanning forest, of the rows of one or two tiles."""

    def __init__(self, ids: np.ndarray, extra: np.ndarray):
        self.ids, self.extra = ids, extra
        self.links, self.label = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for a, b in ((i, j), (j, i)):
            self.links += np.bincount(a, weights=self.extra[b], minlength=len(self.ids)).astype(np.int64)
        union(self.label, i, j)

    def rows(self) -> dict[str, np.ndarray]:
        root = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(root, self.label, self.ids)
        some = self.links > 0
        return {"id": self.ids[some], "links": self.links[some], "root": root[self.label][some]}


def _unit(threshold: float):
    """Sure links of a unit (null ``side``), and the rows that have an open pair (null ``links``)."""

    def work(rows: list[dict]) -> pa.Table:
        first, same = rows[0], rows[0]["i"] == rows[0]["j"]
        sure = {c: np.empty(0, np.int64) for c in ("id", "links", "root")}
        needed = sides = np.empty(0, np.int64)
        if same or len(rows) == 2:
            tiles = [
                Codes(np.frombuffer(r["codes"], np.int8).reshape(r["rows"], r["dim"]), np.frombuffer(r["scale"], "<f8"), np.frombuffer(r["error"], "<f8"))
                for r in rows
            ]
            ids, extra = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows]) for c in ("ids", "extra"))
            shift = 0 if same else rows[0]["rows"]
            links, left_open = _Links(ids, extra), np.zeros(len(ids), bool)
            for i, j, proved in tile_pairs(tiles[0], tiles[-1], threshold, same):
                j = j + shift
                if proved.any():
                    links.add(i[proved], j[proved])
                left_open[i[~proved]] = left_open[j[~proved]] = True
            at = np.flatnonzero(left_open)
            sure, needed, sides = links.rows(), ids[at], (at >= shift).astype(np.int64) * (not same)
        n, m = len(sure["id"]), len(needed)
        then_nulls = lambda v: pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(m, pa.int64())])
        columns = {c: pa.array(np.full(n + m, first[c]), pa.int32()) for c in ("dim", "i", "j")}
        columns["side"] = pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(sides, pa.int32())])
        columns["id"] = pa.array(np.concatenate([sure["id"], needed]), pa.int64())
        return pa.table(columns | {"links": then_nulls(sure["links"]), "root": then_nulls(sure["root"])})

    return work


def _open_unit(threshold: float):
    """Links among the open pairs of a unit's rows."""

    def work(table: pa.Table) -> pa.Table:
        dim, same = table.column("dim")[0].as_py(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        side = table.column("side").to_numpy()
        sides = [table] if same else [table.filter(pa.array(side == s)) for s in (0, 1)]
        tiles = [
            Codes(
                np.frombuffer(b"".join(t.column("code").to_pylist()), np.int8).reshape(len(t), dim),
                t.column("scale").to_numpy(), t.column("error").to_numpy(), _matrix(t.column("vector"), dim),
            )
            for t in sides
        ]
        ids, extra = (np.concatenate([t.column(c).to_numpy() for t in sides]) for c in ("id", "extra"))
        links, shift = _Links(ids, extra), 0 if same else len(sides[0])
        for i, j in open_links(tiles[0], tiles[-1], threshold, same):
            links.add(i, j + shift)
        return pa.table(links.rows())

    return work


def near_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, tile_rows: int = 1 << 16, tile_bytes: int = 1 << 22
) -> DataFrame:
    """``(id, n_links, component, kept)``: one row per row of ``embeddings``.

    ``n_links``: other rows whose vector has a cosine >= ``threshold``
    (0 < threshold <= 1), copies included; ``component``: the smallest id
    reachable by links, the row's own included; ``kept``: whether that is its
    own id. Vectors that are null, empty, zero or hold null or non-finite
    components, and vectors of different lengths, link with nothing. A row
    without id takes no part: no links, no component, not kept. Other columns
    are not looked at; an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    python_workers(embeddings.sparkSession)
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.col("id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    distinct = rows.where("usable").groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("extra"))
    distinct = distinct.select("id", "extra", F.size("vector").alias("dim"), "vector")
    distinct = written(distinct.mapInArrow(_coded, _CODED), "vectors")
    count, dim = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    n = max(tiles_for(count, max(1, min(tile_rows, tile_bytes // dim))), min(_TILES, tiles_for(count, _SMALL)))
    tile = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("tile")
    tiles = distinct.select("id", "extra", "dim", "code", "scale", "error", tile).groupBy("dim", "tile").applyInArrow(_tile, _CODE_TILE)
    other = tiles.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    units = other.withColumns({"i": F.least("tile", "o"), "j": F.greatest("tile", "o"), "side": (F.col("tile") > F.col("o")).cast("int")})
    compared = written(per_unit(units, _unit(threshold), _FOUND), "vector-units")
    left_open = compared.where("links is null").select("i", "j", "side", "id").join(distinct, "id")
    checked = left_open.groupBy("dim", "i", "j").applyInArrow(_open_unit(threshold), _LINKS)
    found = written(compared.where("links is not null").select("id", "links", "root").unionByName(checked), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_vector = (
        distinct.select("id", "extra", "vector").join(links, "id", "left")
        .join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("extra") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    out = rows.withColumn("vector", F.when(F.col("usable"), F.col("vector"))).join(per_vector, "vector", "left")
    component = F.coalesce("component", "id")
    return out.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept")
    )
