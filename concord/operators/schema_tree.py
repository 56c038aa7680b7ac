"""Schema drift as a tree: one row per changed leaf, for all pairs of a manifest at once.

A schema is a row ``table, schema`` (Spark's JSON text of a ``StructType``;
:func:`schema_rows` makes it from frames, ``layout_source.footer_schemas``
from the footers of many roots in one job). Each distinct table's schema is
laid out once as nodes:

* ``a`` a column (lower-cased; of names that differ only in case the last
  wins, as in :mod:`concord.operators.schema`), ``a.b`` a field of a struct (as
  written; a second field of one name is ``b#2``), ``a[]`` the elements of an
  array, ``a{key}`` and ``a{value}`` those of a map. Names that are no words are
  put in back-quotes.

The schemas of a pair's sides meet as text after one shuffle by pair; pairs of one text
are done with, of the others the nodes that differ are laid out beside each other by path.
Each different pair of texts of a batch is laid out once. A path differs in one row, whose ``change`` names all that differs there:

* ``added`` / ``removed``: a leaf on the right / left side only. Of a struct,
  array or map on one side only every leaf is reported.
* ``type``: other leaf types, or a struct, array or map against anything
  else; then nothing below the path is reported.
* ``nullable``: of the column, field, element or value.
* ``order``: the fields that both sides have stand in another order.
* ``metadata``: of a nested field (that of columns does not count).

No rows for a pair says what ``schema_check`` says by Passed. A table without
a schema row counts as one without columns; a pair with none of both, a null
table and an empty manifest give no rows. Pairs that are repeated count once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR = ("pair", "left", "right")
NODE = {
    "kind": pa.string(), "data_type": pa.string(), "nullable": pa.bool_(), "metadata": pa.string(),
    "leaf": pa.bool_(), "above": pa.list_(pa.string()), "fields": pa.list_(pa.string()),
}
_NODE_DDL = "struct<kind:string,data_type:string,nullable:boolean,metadata:string,leaf:boolean,above:array<string>,fields:array<string>>"
DIFFERING = f"array<struct<path:string,l:{_NODE_DDL},r:{_NODE_DDL}>>"


@lru_cache(4096)
def _word(name: str) -> str:
    return name if re.fullmatch(r"\w+", name) else "`" + name.replace("`", "``") + "`"


def _children(path: str, t: T.DataType) -> list[tuple]:
    """``(path, type, nullable, metadata, name in its struct)`` of what lies directly below a type."""
    if isinstance(t, T.ArrayType):
        return [(f"{path}[]", t.elementType, t.containsNull, "", None)]
    if isinstance(t, T.MapType):
        return [(path + "{key}", t.keyType, False, "", None), (path + "{value}", t.valueType, t.valueContainsNull, "", None)]
    out, seen = [], {}
    for f in t.fields if isinstance(t, T.StructType) else ():
        seen[f.name] = seen.get(f.name, 0) + 1
        name = _word(f.name) + (f"#{seen[f.name]}" if seen[f.name] > 1 else "")
        metadata = json.dumps(f.metadata, sort_keys=True) if f.metadata else ""
        out.append((f"{path}.{name}", f.dataType, f.nullable, metadata, name))
    return out


def nodes_of(schema: T.StructType) -> Iterator[tuple]:
    """The nodes of one schema: ``path`` and what ``NODE`` names."""
    columns = {f.name.lower(): f for f in schema.fields}
    todo = [(_word(n), f.dataType, f.nullable, "", []) for n, f in columns.items()]
    while todo:
        path, t, nullable, metadata, above = todo.pop()
        below = _children(path, t)
        names = [c[4] for c in below if c[4] is not None]
        kind = t.typeName() if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else "value"
        yield path, kind, t.simpleString(), nullable, metadata, not below, above, names
        todo.extend((p, u, n, m, [*above, path]) for p, u, n, m, _ in below)


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame | T.StructType]) -> DataFrame:
    """``table, schema`` of frames or schemas that the driver holds."""
    of = lambda x: x if isinstance(x, T.StructType) else x.schema
    return spark.createDataFrame([(name, of(x).json()) for name, x in tables.items()], "table string, schema string")


@lru_cache(4096)
def _value_type(name: str) -> str:
    return T._parse_datatype_json_value(name).simpleString()


def nodes_of_text(text: str) -> dict[str, list]:
    """``nodes_of`` a schema's JSON text by path, laid out from the text itself (types of Spark only, no collations of fields)."""
    schema = json.loads(text)
    if "__COLLATIONS" in text or '"udt"' in text:
        return {path: node for path, *node in nodes_of(T.StructType.fromJson(schema))}
    out: dict[str, list] = {}

    def field(path, f, column, above):
        # the metadata of columns does not count
        metadata = "" if column or not f.get("metadata") else json.dumps(f["metadata"], sort_keys=True)
        return lay_out(path, f["type"], f.get("nullable", True), metadata, above)

    def lay_out(path, t, nullable, metadata, above) -> str:
        """The type as text; its node and those below it go to ``out``."""
        kind, leaf, names, below = "value", True, [], [*above, path]
        if isinstance(t, str):
            data_type = _value_type(t)
        elif (kind := t["type"]) == "struct":
            seen, parts = {}, []
            for f in t["fields"]:
                n = seen[f["name"]] = seen.get(f["name"], 0) + 1
                names.append(_word(f["name"]) + (f"#{n}" if n > 1 else ""))
                parts.append(f["name"] + ":" + field(f"{path}.{names[-1]}", f, False, below))
            data_type, leaf = f"struct<{','.join(parts)}>", not names
        elif kind == "array":
            data_type, leaf = f"array<{lay_out(f'{path}[]', t['elementType'], t['containsNull'], '', below)}>", False
        elif kind == "map":
            key = lay_out(path + "{key}", t["keyType"], False, "", below)
            value = lay_out(path + "{value}", t["valueType"], t["valueContainsNull"], "", below)
            data_type, leaf = f"map<{key},{value}>", False
        else:
            raise ValueError(f"unknown type {kind!r} in a schema")
        out[path] = [kind, data_type, nullable, metadata, leaf, above, names]
        return data_type

    for name, f in {f["name"].lower(): f for f in schema["fields"]}.items():
        field(_word(name), f, True, [])
    return out


def _differing(left: pa.Array, right: pa.Array) -> pa.Array:
    """``path, l, r`` of the nodes that differ between two schemas each (lists of texts: of a table that is there twice, or not at all)."""
    known: dict[str, dict] = {}

    def side(texts) -> dict[str, list]:
        found: dict[str, list] = {}
        for t in texts or ():
            if t not in known:
                known[t] = nodes_of_text(t)
            found = {**found, **known[t]} if found else known[t]
        return found

    pairs = [(tuple(a or ()), tuple(b or ())) for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)]
    place = {pair: i for i, pair in enumerate(dict.fromkeys(pairs))}
    paths, nodes, ends = [], ([], []), [0]
    for a, b in place:
        l, r = side(a), side(b)
        for path in [*l, *(p for p in r if p not in l)]:
            x, y = l.get(path), r.get(path)
            if x != y:
                paths.append(path)
                nodes[0].append(x)
                nodes[1].append(y)
        ends.append(len(paths))

    def of(rows) -> pa.Array:
        columns = [pa.array([n and n[k] for n in rows], t) for k, t in enumerate(NODE.values())]
        return pa.StructArray.from_arrays(columns, names=list(NODE), mask=pa.array([n is None for n in rows], pa.bool_()))

    differ = pa.StructArray.from_arrays([pa.array(paths, pa.string()), *map(of, nodes)], names=["path", "l", "r"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), differ).take(pa.array([place[p] for p in pairs], pa.int32()))


def schema_drift(pairs: DataFrame, schemas: DataFrame) -> DataFrame:
    """Changed paths of every pair: ``pair, left, right, path, change, left_type, left_nullable, right_type, right_nullable``.

    ``pairs``: ``pair, left, right`` (tables by name); ``schemas``: ``table, schema``, one row per table.
    """
    side = lambda name: F.struct(F.lit(name).alias("side"), F.col(name).alias("table"))
    sides = pairs.select(*PAIR).distinct().select(*PAIR, F.inline(F.array(side("left"), side("right"))))
    given = schemas.select("table", "schema").where("table is not null and schema is not null")
    texts = [F.array_sort(F.collect_set(F.when(F.col("side") == s, F.col("schema")))).alias(f"{s}_schema") for s in ("left", "right")]
    met = (
        sides.join(given, "table")
        .repartition(*PAIR)  # serves the meeting of the sides; all that follows stays with the pair
        .groupBy(*PAIR)
        .agg(*texts)
        .where("left_schema <> right_schema")
    )
    met = met.select(*PAIR, F.arrow_udf(_differing, DIFFERING)("left_schema", "right_schema").alias("nodes"))
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    other_kind = both & (F.col("l.kind") != F.col("r.kind"))
    cut = F.transform(F.filter("nodes", lambda x: x["l"].isNotNull() & x["r"].isNotNull() & (x["l"]["kind"] != x["r"]["kind"])), lambda x: x["path"])
    # outer, or Spark calls the function once more to ask whether there is anything to lay out
    met = met.select(*PAIR, cut.alias("cut"), F.inline_outer("nodes"))
    differs = lambda f: F.col(f"l.{f}") != F.col(f"r.{f}")
    only = F.coalesce("l", "r")
    one_sided = only["leaf"] & ~F.arrays_overlap(only["above"], "cut")
    moved = F.array_intersect("l.fields", "r.fields") != F.array_intersect("r.fields", "l.fields")
    changes = F.concat_ws(
        ",",
        F.when(other_kind | (F.col("l.leaf") & F.col("r.leaf") & differs("data_type")), "type"),
        F.when(differs("nullable"), "nullable"),
        F.when(~other_kind & moved, "order"),
        F.when(differs("metadata"), "metadata"),
    )
    change = F.when(both, changes).when(one_sided, F.when(F.col("l").isNull(), "added").otherwise("removed"))
    shown = [F.col(f"{s[0]}.{f}").alias(f"{s}_{n}") for s in ("left", "right") for f, n in (("data_type", "type"), ("nullable", "nullable"))]
    return met.withColumn("change", change).where("change <> ''").select(*PAIR, "path", "change", *shown)


def drift_text(drift: DataFrame) -> DataFrame:
    """``pair, left, right, schema_diff``: the changes of each pair as text, in order of the paths.

    A change of type or nullability reads ``path: type/nullable -> type/nullable`` with ``absent`` for a
    missing side, as in ``describe_differences``; other changes are named in brackets.
    """

    def shown(s):
        return F.coalesce(F.concat(f"{s}_type", F.lit("/"), F.col(f"{s}_nullable").cast("string")), F.lit("absent"))

    more = F.concat_ws(",", F.array_intersect(F.split("change", ","), F.array(F.lit("order"), F.lit("metadata"))))
    line = F.concat("path", F.lit(": "), shown("left"), F.lit(" -> "), shown("right"), F.when(more != "", F.concat(F.lit(" ("), more, F.lit(")"))).otherwise(""))
    lines = F.array_sort(F.collect_list(F.struct("path", line.alias("line"))))  # as many as a pair's schemas have paths
    return drift.groupBy(*PAIR).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "; ").alias("schema_diff"))
