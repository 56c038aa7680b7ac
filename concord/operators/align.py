"""Column alignment of a table pair before any comparison.

Two policies:

* ``"name"`` — columns are matched by lower-cased name. Both sides must have
  the same set of names after the ignored columns are dropped; otherwise an
  :class:`AlignmentError` names the columns found on one side only. Pairing
  by sorted rank (which silently pairs different columns when the name sets
  differ) is never done.
* ``"position"`` — columns are matched by position; both sides must have the
  same number of columns. The right side takes the left side's names.

Column types are not forced here: the union inside the compare widens them
the way Spark's set operations do (int vs bigint compare by value). Type
drift is the schema check's job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class AlignmentError(ValueError):
    """The two sides cannot be paired column by column."""


def quoted(name: str) -> Column:
    """A column reference that survives dots, spaces and backticks in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Drop ``names`` from ``df``; absent names are ignored, matching is case-insensitive."""
    if not names:
        return df
    gone = {n.lower() for n in names}
    keep = [c for c in df.columns if c.lower() not in gone]
    if len(keep) == len(df.columns):
        return df
    return df.select(*[quoted(c) for c in keep])


def aligned_pairs(left: DataFrame, right: DataFrame, ignore=(), how: str = "name") -> tuple[tuple[str, str], ...]:
    """(result name, right column) of every pair :func:`align` would make, from the schemas alone."""
    gone = {n.lower() for n in (ignore or ())}
    lcols = [c for c in left.columns if c.lower() not in gone]
    rcols = [c for c in right.columns if c.lower() not in gone]
    if how == "name":
        lset, rset = {c.lower() for c in lcols}, {c.lower() for c in rcols}
        if len(lset) != len(lcols) or len(rset) != len(rcols):
            raise AlignmentError("a side has columns that differ only in case")
        if lset != rset:
            raise AlignmentError(
                f"column sets differ: left only {sorted(lset - rset)}, right only {sorted(rset - lset)}"
            )
        return tuple((n, n) for n in sorted(lset))
    if how == "position":
        if len(lcols) != len(rcols):
            raise AlignmentError(f"column counts differ: left {len(lcols)}, right {len(rcols)}")
        return tuple(zip(lcols, rcols))
    raise ValueError(f"unknown alignment {how!r}; use 'name' or 'position'")


def contains(dtype: T.DataType, kind: type) -> bool:
    """Whether ``dtype`` is of ``kind`` or holds such values, at any depth."""
    if isinstance(dtype, kind):
        return True
    if isinstance(dtype, T.ArrayType):
        return contains(dtype.elementType, kind)
    if isinstance(dtype, T.MapType):
        return contains(dtype.keyType, kind) or contains(dtype.valueType, kind)
    if isinstance(dtype, T.StructType):
        return any(contains(f.dataType, kind) for f in dtype.fields)
    return False


# Variant primitives by their number in the encoding; integers of any width are one type.
_PRIMITIVES = {
    0: "VOID", 1: "BOOLEAN", 2: "BOOLEAN", 3: "BIGINT", 4: "BIGINT", 5: "BIGINT", 6: "BIGINT", 7: "DOUBLE",
    8: "DECIMAL", 9: "DECIMAL", 10: "DECIMAL", 11: "DATE", 12: "TIMESTAMP", 13: "TIMESTAMP_NTZ", 14: "FLOAT",
    15: "BINARY", 16: "STRING",
}


def _types_udf(depth: int):
    """The types of all leaves of a VARIANT within ``depth`` arrays.

    The function has all that it needs within it, so workers need not import this package.
    """
    primitives = dict(_PRIMITIVES)

    def variant_types(value: bytes) -> str:
        """The types of all leaves of an encoded VARIANT in the order of its JSON, repeats as ``TYPE*n``."""
        names: list[str] = []
        places = [0]
        while places:
            at = places.pop()
            basic, info = value[at] & 3, value[at] >> 2
            if basic == 0:
                names.append(primitives.get(info, f"T{info}"))
            elif basic == 1:  # a short string
                names.append("STRING")
            else:
                wide = info >> (4 if basic == 2 else 2) & 1
                offset_bytes, id_bytes = (info & 3) + 1, (info >> 2 & 3) + 1 if basic == 2 else 0
                first = at + 1 + (4 if wide else 1)
                n = int.from_bytes(value[at + 1 : first], "little")
                first += n * id_bytes
                data = first + (n + 1) * offset_bytes
                for k in reversed(range(n)):
                    o = first + k * offset_bytes
                    places.append(data + int.from_bytes(value[o : o + offset_bytes], "little"))
        runs = ((name, sum(1 for _ in run)) for name, run in groupby(names))
        return ",".join(name if n == 1 else f"{name}*{n}" for name, n in runs)

    def types(v):
        if v is None:
            return None
        return [types(x) for x in v] if isinstance(v, list) else variant_types(bytes(v.value))

    dtype: T.DataType = T.StringType()
    for _ in range(depth):
        dtype = T.ArrayType(dtype)
    return F.udf(types, dtype, useArrow=True)


def _variant_paths(dtype: T.DataType) -> list[tuple[int, Callable[[Column], Column]]]:
    """The VARIANT leaves of ``dtype``: (depth, function to the leaf's values within so many arrays)."""
    if isinstance(dtype, T.VariantType):
        return [(0, lambda c: c)]
    if isinstance(dtype, T.ArrayType):
        return [(d + 1, lambda c, f=f: F.transform(c, lambda x: f(x))) for d, f in _variant_paths(dtype.elementType)]
    if isinstance(dtype, T.MapType):
        return [(d + 1, lambda c, f=f: F.transform(F.map_values(c), lambda x: f(x))) for d, f in _variant_paths(dtype.valueType)]
    if isinstance(dtype, T.StructType):
        return [(d, lambda c, f=f, n=x.name: f(c.getField(n))) for x in dtype.fields for d, f in _variant_paths(x.dataType)]
    return []


def _comparable(col: Column, dtype: T.DataType, types: list[Column]) -> Column:
    """VARIANT values, which cannot be grouped on, as text: the types of their leaves, then their JSON.

    The JSON alone is not enough: a date and a string look alike in it. Nor is
    ``schema_of_variant``, which merges the types of an array's elements.
    ``types`` has the types of each of :func:`_variant_paths`.
    """
    if not types:
        return col
    if isinstance(dtype, T.VariantType):
        return F.concat(types[0], F.lit(" "), F.to_json(col))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x, i: _comparable(x, dtype.elementType, [F.get(t, i) for t in types]))
    if isinstance(dtype, T.MapType):
        value = lambda e, i: _comparable(e["value"], dtype.valueType, [F.get(t, i) for t in types])
        return F.map_from_entries(F.transform(F.map_entries(col), lambda e, i: F.struct(e["key"], value(e, i))))
    fields = []
    for f in dtype.fields:
        n = len(_variant_paths(f.dataType))
        fields.append(_comparable(col.getField(f.name), f.dataType, types[:n]).alias(f.name))
        types = types[n:]
    return F.when(col.isNotNull(), F.struct(*fields))


def _select_comparable(df: DataFrame, pairs) -> DataFrame:
    """The columns of ``df`` named first in ``pairs`` under the second names, VARIANT values as text."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    made: dict[str, Column] = {}
    types: dict[str, list[Column]] = {}
    for c, _ in pairs:
        types[c] = []
        for depth, path in _variant_paths(dtypes[c]):
            name = f"__concord_v{len(made)}"
            made[name] = _types_udf(depth)(path(quoted(c)))
            types[c].append(F.col(name))
    if made:
        df = df.select(*[quoted(c) for c, _ in pairs], *[t.alias(n) for n, t in made.items()])
    return df.select(*[_comparable(quoted(c), dtypes[c], types[c]).alias(n) for c, n in pairs])


@dataclass(frozen=True)
class Aligned:
    """A pair with identical column names, in the same order, on both sides."""

    left: DataFrame
    right: DataFrame
    names: tuple[str, ...]


def _lower_index(df: DataFrame, side: str) -> dict[str, str]:
    index: dict[str, str] = {}
    for c in df.columns:
        key = c.lower()
        if key in index:
            raise AlignmentError(f"{side} side has columns that differ only in case: {index[key]!r}, {c!r}")
        index[key] = c
    return index


def align(left: DataFrame, right: DataFrame, ignore=(), how: str = "name") -> Aligned:
    """Drop ``ignore`` from both sides and pair the remaining columns."""
    left = drop_columns(left, ignore)
    right = drop_columns(right, ignore)

    if how == "name":
        li = _lower_index(left, "left")
        ri = _lower_index(right, "right")
        only_l = sorted(set(li) - set(ri))
        only_r = sorted(set(ri) - set(li))
        if only_l or only_r:
            raise AlignmentError(f"column sets differ: left only {only_l}, right only {only_r}")
        names = tuple(sorted(li))
        lsel = [(li[n], n) for n in names]
        rsel = [(ri[n], n) for n in names]
    elif how == "position":
        if len(left.columns) != len(right.columns):
            raise AlignmentError(
                f"column counts differ: left {len(left.columns)}, right {len(right.columns)}"
            )
        names = tuple(left.columns)
        if len({n.lower() for n in names}) != len(names):
            raise AlignmentError(f"left side has columns that differ only in case: {list(names)}")
        lsel = [(n, n) for n in names]
        rsel = list(zip(right.columns, names))
    else:
        raise ValueError(f"unknown alignment {how!r}; use 'name' or 'position'")
    return Aligned(_select_comparable(left, lsel), _select_comparable(right, rsel), names)
