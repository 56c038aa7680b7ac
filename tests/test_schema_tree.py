"""Schema drift as a tree: every kind of change, agreement with schema_check, footers of many roots."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from concord import schema_check
from concord.operators.schema_tree import drift_text, nodes_of, nodes_of_text, schema_drift, schema_rows
from concord.sources.layout_source import footer_schemas
from conftest import rows


def _drift(spark, left, right):
    pairs = spark.createDataFrame([("p", "a", "b")], "pair string, left string, right string")
    tables = {n: T._parse_datatype_string(t) if isinstance(t, str) else t for n, t in (("a", left), ("b", right))}
    return schema_drift(pairs, schema_rows(spark, tables))


def _changes(spark, left, right):
    return sorted((r["path"], r["change"]) for r in _drift(spark, left, right).collect())


def test_each_changed_leaf_is_one_row(spark):
    left = "K bigint, s struct<p:int, q:array<struct<x:double>>>, m map<string, struct<v:int>>, gone struct<a:int, b:array<int>>"
    right = "k bigint, s struct<p:bigint, q:array<struct<x:double, y:date>>>, m map<int, struct<v:int>>"
    assert _changes(spark, left, right) == [
        ("gone.a", "removed"), ("gone.b[]", "removed"), ("m{key}", "type"), ("s.p", "type"), ("s.q[].y", "added")]


def test_another_kind_hides_what_lies_below(spark):
    got = [tuple(r)[3:] for r in _drift(spark, "s struct<p:struct<q:int>, r:int>", "s struct<p:string, r:int>").collect()]
    assert got == [("s.p", "type", "struct<q:int>", True, "string", True)]


def test_order_nullability_and_metadata(spark):
    def s(fields):
        return T.StructType([T.StructField("s", T.StructType(fields))])

    p, q = T.StructField("p", T.IntegerType()), T.StructField("q", T.ArrayType(T.IntegerType(), True))
    assert _changes(spark, s([p, q]), s([q, p])) == [("s", "order")]
    assert _changes(spark, s([p, q]), s([p, T.StructField("n", T.IntegerType()), q])) == [("s.n", "added")]
    assert _changes(spark, s([q]), s([T.StructField("q", T.ArrayType(T.IntegerType(), False), False)])) == [("s.q", "nullable"), ("s.q[]", "nullable")]
    assert _changes(spark, s([p]), s([T.StructField("p", T.LongType(), False, {"comment": "x"})])) == [("s.p", "type,nullable,metadata")]
    # names that are no words, and two fields of one name
    twice = s([T.StructField("a.b", T.IntegerType()), T.StructField("p", T.IntegerType()), T.StructField("p", T.IntegerType())])
    assert _changes(spark, twice, s([p])) == [("s.`a.b`", "removed"), ("s.p#2", "removed")]


def test_text_of_flat_columns_is_that_of_the_check(spark):
    a = spark.createDataFrame([], "k bigint, p double, t string")
    b = spark.createDataFrame([], "K bigint, p decimal(10,2), extra int")
    text = drift_text(_drift(spark, a.schema, b.schema)).first()["schema_diff"]
    assert text == schema_check(a, b)[1]


def test_missing_tables_repeated_pairs_and_empty_manifests(spark):
    pairs = spark.createDataFrame(
        [("p", "a", "gone"), ("p", "a", "gone"), (None, "gone", "a"), ("q", "gone", "lost"), ("r", None, None), ("s", "a", "a")],
        "pair string, left string, right string")
    schemas = schema_rows(spark, {"a": T._parse_datatype_string("x int"), "empty": T.StructType([])})
    assert rows(schema_drift(pairs, schemas).select("pair", "path", "change")) == [("p", "x", "removed"), (None, "x", "added")]
    assert schema_drift(pairs.limit(0), schemas).count() == 0 == schema_drift(pairs, schemas.limit(0)).count()


_leaf = st.sampled_from([T.IntegerType(), T.StringType(), T.DecimalType(8, 2)])


def _fields(types):
    field = st.builds(T.StructField, st.sampled_from(["a", "b", "B", "c d"]), types, st.booleans())
    return st.lists(field, max_size=3).map(T.StructType)


_types = st.recursive(
    _leaf,
    lambda t: st.one_of(st.builds(T.ArrayType, t, st.booleans()), st.builds(T.MapType, _leaf, t, st.booleans()), _fields(t)),
    max_leaves=5)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_fields(_types), _fields(_types), st.booleans()), min_size=20, max_size=20))
def test_no_rows_exactly_where_the_check_passes(spark, cases):
    cases = [(a, a if same else b) for a, b, same in cases]
    columns = lambda s: {f.name.lower(): (f.dataType, f.nullable) for f in s.fields}  # noqa: E731 - what schema_check compares
    tables = {f"{side}{i}": s for i, pair in enumerate(cases) for side, s in zip("ab", pair)}
    pairs = spark.createDataFrame([(str(i), f"a{i}", f"b{i}") for i in range(len(cases))], "pair string, left string, right string")
    drifted = {r[0] for r in schema_drift(pairs, schema_rows(spark, tables)).select("pair").distinct().collect()}

    def seen(s):  # an empty struct column has no leaf below it but is one itself
        return columns(s)

    assert drifted == {str(i) for i, (a, b) in enumerate(cases) if seen(a) != seen(b)}


def test_a_manifest_is_shuffled_by_pair_once(spark):
    pairs = spark.createDataFrame([("p", "a", "b")], "pair string, left string, right string")
    plan = schema_drift(pairs, schema_rows(spark, {"a": T._parse_datatype_string("x int")}))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "pair" in line and "REPARTITION" in line]
    assert len(exchanges) == 1
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "path" in line]


def test_only_pairs_of_unlike_texts_are_laid_out_and_only_once(spark):
    """Schemas cross the shuffles as text; no node does, and equal texts never reach the function."""
    pairs = spark.createDataFrame([("p", "a", "b")], "pair string, left string, right string")
    lines = schema_drift(pairs, schema_rows(spark, {"a": T._parse_datatype_string("x int")}))._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(lines) if "ArrowEvalPython" in line]
    assert len(at) == 1 and not [line for line in lines if "MapInPandas" in line]
    assert "NOT (left_schema" in lines[at[0] + 1]
    assert not [line for line in lines[: at[0]] if "Exchange" in line]


def test_a_table_that_is_there_twice_has_the_paths_of_both(spark):
    pairs = spark.createDataFrame([("p", "a", "b")], "pair string, left string, right string")
    rows_of = [("a", "x int"), ("a", "y int"), ("a", "x int"), ("b", "x int")]
    schemas = spark.createDataFrame([(t, T._parse_datatype_string(s).json()) for t, s in rows_of], "table string, schema string")
    assert rows(schema_drift(pairs, schemas).select("path", "change")) == [("y", "removed")]


@settings(max_examples=200, deadline=None)
@given(_fields(_types))
def test_nodes_of_a_text_are_those_of_its_schema(schema):
    assert nodes_of_text(schema.json()) == {path: node for path, *node in nodes_of(schema)}


def test_nodes_of_a_text_keep_metadata_and_collations():
    nested = T.StructType([T.StructField("p", T.StringType("UNICODE"), False, {"b": 1, "a": "x"}), T.StructField("d", T.DayTimeIntervalType(0, 1)), T.StructField("p", T.VarcharType(3))])
    schema = T.StructType([T.StructField("S", nested, True, {"comment": "of a column"}), T.StructField("c", T.StringType("UTF8_LCASE")), T.StructField("n", T.NullType())])
    for s in (schema, T.StructType([T.StructField("s", T.StructType(nested.fields[1:]), True, {"comment": "x"}), *schema.fields[2:]])):
        assert nodes_of_text(s.json()) == {path: node for path, *node in nodes_of(T.StructType.fromJson(json.loads(s.json())))}


def test_schemas_of_many_roots_come_from_their_footers(spark, tmp_path):
    wide = spark.range(3).selectExpr("id", "named_struct('p', id, 'q', array(cast(id as string))) as s", "current_timestamp() as t")
    wide.write.parquet(f"{tmp_path}/a")
    wide.selectExpr("id", "named_struct('p', cast(id as int), 'q', array(id)) as s", "t", "id % 2 as k").write.partitionBy("k").parquet(f"{tmp_path}/b")
    (tmp_path / "c").mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "d").mkdir()
    pq.write_table(pa.table({"id": [1], "s": [{"p": 1, "q": ["x"]}], "t": pa.array([0], pa.timestamp("us", "UTC"))}), f"{tmp_path}/d/part-0.parquet")
    roots = [f"{tmp_path}/{n}" for n in "abcd"]
    found = footer_schemas(spark, roots, per_task=1)
    assert {r["table"][-1]: r["schema"] is None for r in found.collect()} == {"a": False, "b": False, "c": True, "d": False}
    pairs = spark.createDataFrame([(n, roots[0], f"{tmp_path}/{n}") for n in "bcd"], "pair string, left string, right string")
    got = sorted((r["pair"], r["path"], r["change"]) for r in schema_drift(pairs, found).where("change <> 'nullable'").collect())
    assert got == [("b", "s.p", "type"), ("b", "s.q[]", "type"), *[("c", p, "removed") for p in ("id", "s.p", "s.q[]", "t")]]
