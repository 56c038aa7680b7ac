"""Row values packed into longs: the same numbers as grouping by the values, over fewer bytes."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concord import compare
from concord.operators.compare import diff_counts, diff_rows, distinct_count_check
from concord.operators.packing import packed_keys
from concord.plans.profiles import CURRENT_HISTORY, PHASE2
from concord.plans.reconcile import packed, reconcile
from concord.plans.verdict import pair_verdicts
from concord.sources.manifest import manifest_frame
from conftest import rows
from test_plans import plan

NAN, INF = float("nan"), float("inf")
D = dt.datetime
VALUES = {
    "bigint": [0, 1, -1, 5, 5, None],
    "long": [-(2**63), 2**63 - 1, 0, None],
    "tinyint": [-128, 127, 0, None],
    "boolean": [True, False, None],
    "date": [dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), None],
    "decimal(18,4)": [Decimal("99999999999999.9999"), Decimal("-99999999999999.9999"), Decimal("0.0001"), None],
    "decimal(12,2)": [Decimal("0.10"), Decimal("-0.10"), Decimal("0.00"), None],
    "decimal(30,4)": [Decimal("1.0001"), Decimal("1.0002"), None],
    "double": [0.1, 0.01, -0.0, 0.0, 100.29, 50.0, None],
    "float": [0.5, 0.25, -0.0, 0.0, 3.0, None],
}
ODD = [
    ("double", [NAN, 1.0, None]),
    ("double", [INF, -INF, 1.0]),
    ("double", [0.1 + 0.2, 0.3, None]),  # differ in the last bit
    ("double", [1e300, -1e300, 1e11, 0.0001]),
    ("float", [0.1, 0.10000001, NAN]),
    ("timestamp", [D(2024, 1, 1), D(1960, 5, 5), None]),
    ("timestamp", [D(2024, 1, 1), D(1960, 5, 5, 1, 2, 3, 999999), None]),
    ("timestamp_ntz", [D(2024, 3, 10, 2, 30), D(2024, 3, 10, 3, 30), None]),  # the first is skipped in New York
    ("timestamp_ntz", [D(2024, 11, 3, 1, 30), D(1950, 1, 1, 23, 59, 59, 999999), D(1950, 1, 2)]),
    ("timestamp_ntz", [D(1969, 12, 31), D(1970, 1, 1), None]),
    ("string", ["", "\0", "a", "\x7f", None]),
    ("string", ["", "é", "a"]),
    ("string", ["a", "ab", None]),
    ("bigint", [7, 7, 7]),
    ("bigint", [None, None]),
    ("array<int>", [[1], [1, 2], None]),
]
CASES = list(VALUES.items()) + ODD


def _sides(spark, cases):
    """Two frames with a column per case: a side's rows go through the values at a step of their own."""
    schema = ", ".join(f"c{i} {'bigint' if t == 'long' else t}" for i, (t, _) in enumerate(cases))
    make = lambda n, step: spark.createDataFrame([tuple(v[(r * step + r // 7) % len(v)] for _, v in cases) for r in range(n)], schema)
    return make(40, 1), make(33, 2)


def _plain(v):
    return "NaN" if isinstance(v, float) and v != v else str(v) if isinstance(v, list) else v


def test_equal_keys_are_equal_values(spark):
    """Each column by itself: one key per value as GROUP BY sees it, in a time zone that skips an hour."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        left, right = _sides(spark, CASES)
        both = left.unionByName(right)
        keys = [list(made.items()) for made in packed_keys(both, [[c] for c in both.columns], "p")]
        fit = {i for i, ((name, _),) in enumerate(keys) if name.startswith("p")}
        got = both.select("*", *[c.alias(f"k{i}") for i, ((_, c),) in enumerate(keys)]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for i in fit:
        values, numbers = {_plain(r[f"c{i}"]) for r in got}, {r[f"k{i}"] for r in got}
        assert len(values) == len(numbers) == len({(_plain(r[f"c{i}"]), r[f"k{i}"]) for r in got}), CASES[i]
    kept = sorted(CASES[i][0] for i in range(len(CASES)) if i not in fit)
    assert kept == sorted(["long", "decimal(18,4)", "decimal(30,4)", "array<int>", "float", "string", "string"] + 4 * ["double"])


def test_packed_is_exact_for_all_columns_and_lists(spark):
    left, right = _sides(spark, CASES[:12])
    for kw in (
        {},
        {"by": "c2"},
        {"ignore": ["c0", "c8"], "ignore_distinct": ["c0"]},
        {"ignore": ["c0"], "ignore_distinct": ["c0", "c8"]},
        {"ignore": ["c0"], "ignore_distinct": ["c8"]},
    ):
        assert rows(compare(left, right, method="packed", **kw)) == rows(compare(left, right, **kw)), kw
    for check in (distinct_count_check, diff_counts):
        assert rows(check(left, right, method="packed")) == rows(check(left, right))
    none = left.where(F.lit(False))
    assert rows(compare(none, right, method="packed")) == rows(compare(none, right))
    with pytest.raises(ValueError):
        diff_rows(left, right, method="packed")


def test_strings_that_are_no_text_are_told_apart(spark):
    make = lambda *hexes: spark.createDataFrame([(h,) for h in hexes], "h string").select(F.unhex("h").cast("string").alias("s"))
    left, right = make("FF", "41", ""), make("FE", "41", "00")
    got = compare(left, right, method="packed").first()
    assert (got["gen1_except_gen2"], got["gen2_except_gen1"]) == (2, 2)


def test_column_that_changed_in_between_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    (made,) = packed_keys(spark.read.parquet(path), [["id"]], "p")
    later = spark.range(11).select(*[c.alias(n) for n, c in made.items()])
    with pytest.raises(Exception, match="changed while it was read"):
        later.collect()


def test_runner_ships_packed_rows(spark, tmp_path):
    """Eleven narrow columns travel as two longs; before, each had its own eight bytes and more."""
    path = str(tmp_path / "lines")
    k = F.col("id")
    spark.range(500).select(
        k.alias("l_orderkey"), (k % 200).alias("l_partkey"), (k % 10).alias("l_suppkey"), (k % 7).cast("int").alias("l_linenumber"),
        (k % 50).cast("double").alias("l_quantity"), (k * 1.37).cast("decimal(12,2)").cast("double").alias("l_extendedprice"),
        (k % 11 / 100).alias("l_discount"), (k % 9 / 100).alias("l_tax"), F.when(k % 2 == 0, "A").otherwise("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.expr("timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(int(id % 300))").alias("l_shipdate"),
    ).write.parquet(path)
    row = {"env": "prod", "dag_id": "lines_daily", "gen1_path": path, "gen2_path": path}
    ((_, frame, _),) = pair_verdicts(spark, row, packed(PHASE2))
    (shuffle,) = {line for line in plan(frame).splitlines() if "hashpartitioning(" in line}
    assert shuffle.count("__concord_p") == 2 and "l_" not in shuffle, shuffle
    got = frame.first()
    assert (got["gen1_distinct_count"], got["gen2_distinct_count"], got["except_validation"]) == (500, 500, "Passed")


def test_unreadable_history_leaves_the_current_verdict(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.range(10).write.parquet(good)
    spark.range(10).write.parquet(bad)
    spark.range(10).select(F.col("id").cast("string")).write.mode("append").parquet(bad)  # one file's type is not the other's
    manifest = manifest_frame(spark, [("prod", "t_daily", good, good, bad, bad)], history=True)
    got = {r["scope"]: r for r in reconcile(spark, manifest, CURRENT_HISTORY, history=True).collect()}
    assert got["current"]["gen1_count"] == 10 and got["current"]["error_msg"] is None
    assert got["history"]["gen1_except_gen2"] == -1 and got["history"]["error_msg"]
