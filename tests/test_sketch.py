"""Fingerprint equality and differences from an invertible table, against the exact comparison."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concord import compare, diff_counts, diff_rows
from concord.operators import sketch
from concord.operators.compare import _H, _buckets_for
from concord.operators.sketch import differing_digests, equality, estimate
from conftest import rows

SCHEMA = "k int, v string, d double, a array<int>"
VALUE = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from([None, "", "x", "é"]),
    st.sampled_from([None, 0.0, -0.0, 1.5, float("nan")]),
    st.sampled_from([None, [], [1], [1, None]]),
)
QUICK = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@QUICK
@given(st.lists(VALUE, max_size=12), st.lists(VALUE, max_size=4), st.booleans())
def test_equality_is_the_exact_comparison(spark, both, extra, shuffled):
    left = spark.createDataFrame(both, SCHEMA)
    right = spark.createDataFrame((both[::-1] if shuffled else both) + extra, SCHEMA)
    for by in (None, "k"):
        want = compare(left, right, by=by).drop("gen1_distinct_count", "gen2_distinct_count", "dis_count_validation")
        assert rows(equality(left, right, by=by, buckets=4)) == rows(want)
    assert rows(diff_counts(left, right, ignore=["d"], method="fingerprint")) == rows(diff_counts(left, right, ignore=["d"]))


@QUICK
@given(st.lists(VALUE, max_size=10), st.lists(VALUE, max_size=10))
def test_sketch_is_the_exact_difference(spark, a, b):
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert rows(diff_rows(left, right, method="sketch")) == rows(diff_rows(left, right, method="exact"))


def test_equal_tables_shuffle_no_rows(spark):
    left = spark.range(20_000).selectExpr("id", "id * 2 as twice")
    right = left.orderBy(F.desc("id"))
    df = equality(left, right)
    assert df.collect()[0]["except_validation"] == "Passed"
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    shuffled = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("id#" in line or "twice#" in line for line in shuffled), shuffled
    assert "__concord_cell" not in final
    # one row differs: only rows of its bucket go on
    other = left.withColumn("twice", F.expr("if(id = 77, -1, twice)"))
    r = equality(left, other).first()
    assert (r["gen1_except_gen2"], r["gen2_except_gen1"], r["count_validation"]) == (1, 1, "Passed")


def _digests(spark, left, right):
    """``(h1, h2, sign)`` of two lists of pairs of longs."""
    data = [(*x, 1) for x in left] + [(*x, -1) for x in right]
    return spark.createDataFrame(data, f"{_H[0]} long, {_H[1]} long, {sketch._SIGN} long")


@pytest.mark.parametrize(("n", "third"), [(0, 8), (1, 8), (700, 8), (3000, 512)])
def test_tables_of_any_size_empty(spark, n, third):
    """Also far too small a table for its digests: it is built again until it empties."""
    rnd = random.Random(n)
    some = lambda k: [(rnd.getrandbits(63) - (1 << 62), rnd.getrandbits(64) - (1 << 63)) for _ in range(k)]
    same, only_left, only_right, often = some(500), some(n - n // 3), some(n // 3), some(min(n, 5))
    df = _digests(spark, same + only_left + often * 7, same + only_right)
    got = {(r[_H[0]], r[_H[1]]): r["c"] for r in differing_digests(df, third=third).collect()}
    assert got == {**dict.fromkeys(only_left, 1), **dict.fromkeys(only_right, -1), **dict.fromkeys(often, 7)}


@pytest.mark.parametrize("n", [0, 10, 3000, 20_000])
def test_estimate(spark, n):
    rnd = random.Random(n)
    some = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(n)]
    got = estimate(_digests(spark, some, []))
    assert got == n if n <= 10 else n / 2 < got < 2 * n


def test_what_is_shuffled_follows_the_difference(spark):
    """Ten times the rows with the same difference are as many cells."""

    def cells(n):
        data = [(k, -k) for k in range(n)]
        df = _digests(spark, data, data[50:])
        return sketch._cells(df, F.lit(0), 512, 1).count()

    assert cells(500) == cells(5000) <= 150


def test_a_large_difference_is_added_up_before_it_fills_tables(spark, monkeypatch):
    """Of tables larger than a task's rows only the digests that differ make cells; small ones need no such pass."""
    filled = []
    cells = sketch._cells
    monkeypatch.setattr(sketch, "_cells", lambda df, part, third, salt: (filled.append(df.count()) if salt else None, cells(df, part, third, salt))[1])
    data = [(k, -k) for k in range(4000)]
    for gone, sparse in ((1000, True), (2, False)):
        filled.clear()
        df = _digests(spark, data + data[:10] * 20, data[gone:] + data[:10] * 20).repartition(4).localCheckpoint()
        got = {(r[_H[0]], r[_H[1]]): r["c"] for r in differing_digests(df, third=16).collect()}
        assert got == dict.fromkeys(data[:gone], 1)
        assert filled[0] == (gone if sparse else df.count())


def test_bit_map_grows_with_the_difference():
    assert [_buckets_for(n) for n in (0, 1000, 3_000_000, 17_500_000, 10**10)] == [1024, 1024, 1465, 8545, 16384]


def test_hash_is_that_of_spark(spark):
    pairs = [(0, 0), (-1, 1), (1 << 62, -(1 << 63)), (123456789, -987654321)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b", F.lit(5).cast("bigint")).alias("h"))
    assert all(sketch._long(sketch._hash(r.a, r.b, 5)) == r.h for r in df.collect())
