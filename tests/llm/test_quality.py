"""Quality cascade: measures against brute force, order by rejections per cost, short circuit, odd rows."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from concord.llm import quality
from concord.llm.quality import MEASURES, Rule, greedy, judge, measure, ordered


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


def texts(seed=7):
    rnd = random.Random(seed)
    made = [" ".join(rnd.choices("a b été 漢字 😀 x|y ##".split(), k=rnd.randint(0, 60))) for _ in range(60)]
    made += ["\n".join(rnd.choices(["one line", " ", "", "two\tlines", "one line "], k=8)) for _ in range(20)]
    return [None, "", " \n\t", "\x85  x", "word", "a a a a", "a b c a b c", "x " * 3000, *made, made[0], made[0]]


def measured(spark, rows):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "id int, text string")
    return {r["id"]: tuple(r[m] for m in MEASURES) for r in measure(df).collect()}


@pytest.mark.parametrize("place_bits", [24, 62])  # with 2 bits of hash, different windows meet and words decide
def test_measures(spark, monkeypatch, place_bits):
    monkeypatch.setattr(quality, "PLACE_BITS", place_bits)
    monkeypatch.setattr(quality, "_PLACE", (1 << place_bits) - 1)
    rows = [t for t in texts() if place_bits == 24 or len(t or "") < 1000]
    assert measured(spark, rows) == {k: brute(t) for k, t in enumerate(rows)}


def test_more_words_than_places(spark, monkeypatch):
    monkeypatch.setattr(quality, "PLACE_BITS", 4)
    monkeypatch.setattr(quality, "_PLACE", 15)
    rows = ["a b c " * 20, "a b c d e f g h i j k l m n o p q r s t a b c"]
    assert measured(spark, rows) == {k: brute(t) for k, t in enumerate(rows)}


def test_measures_need_no_shuffle_and_no_python(spark):
    plan = judge(spark.createDataFrame([(1, "a")], "id int, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)


def test_order():
    # 0 is dear, 1 and 2 reject the same rows, 3 rejects few and costs little
    patterns = {(True, False, False, False): 50, (False, True, True, False): 40, (False, False, False, True): 5, (False,) * 4: 100}
    assert greedy([10.0, 1.0, 2.0, 0.1], patterns) == [3, 1, 0, 2]
    assert greedy([], {}) == []


def test_a_rejected_row_meets_no_further_rule(spark):
    long = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, long + " stop"), (2, long), (3, "short")], "id int, text string")
    first = Rule("first", lambda d: d["text"].contains("stop"))
    second = Rule("second", lambda d: F.when(d["text"].contains("stop") | (d["n_words"] < 50), F.raise_error(F.lit("asked"))).otherwise(False))
    assert {r["id"]: r["kept"] for r in judge(df, [first, second]).collect()} == {1: False, 2: True, 3: False}
    with pytest.raises(Exception, match="asked"):
        judge(df, [second, first]).collect()


def test_order_changes_no_verdict(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts(3) + [t * 9 for t in texts(4)[8:40]])], "id int, text string")
    rules = [e.rule for e in ordered(df, sample=32)]
    assert sorted(r.name for r in rules) == sorted(r.name for r in quality.RULES)
    one, two = (sorted(map(tuple, judge(df, r).drop("text").collect())) for r in (rules, rules[::-1]))
    assert one == two


def test_sample_is_bounded_and_spread(spark, tmp_path):
    spark.range(400).selectExpr("cast(id as string) as text").repartition(16).write.parquet(f"file://{tmp_path}/t")
    table = spark.read.parquet(f"file://{tmp_path}/t").withColumn("file", F.input_file_name())
    got = quality.sample_rows(table, rows=40, files=8)
    assert got.count() == 40 and got.select("file").distinct().count() == 8


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "id int, text string")
    assert judge(empty).collect() == [] and len(ordered(empty)) == len(quality.RULES)
    clash = spark.createDataFrame([(None, "a", 5, True, "x", "y")], "id int, text string, n_words int, kept boolean, w string, row string")
    row = judge(clash).first().asDict()
    assert row["n_words"] == 1 and row["kept"] is False and (row["w"], row["row"], row["id"]) == ("x", "y", None)
    untyped = spark.createDataFrame([(None,)], "text string")
    assert judge(untyped).first()["n_words"] == 0


def test_clean_and_junk(spark):
    clean = "The cats sat on a mat and looked out for birds. " + " ".join(map("".join, itertools.product("bdgk", "aeiou", "lmn")))
    junk = {"symbols": "### $$$ " * 5 + clean.replace(" ", " # "), "capitals": clean.upper(), "exclaimed": clean.replace(" ", "! "), "letters": " ".join(str(i) for i in range(200))}
    df = spark.createDataFrame([("clean", clean), *junk.items()], "id string, text string")
    got = {r["id"]: (r["base_failed"], r["kept"]) for r in judge(df).collect()}
    assert got == {"clean": (False, True), **{k: (False, False) for k in junk}}
