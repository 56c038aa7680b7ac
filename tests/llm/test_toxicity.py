"""The classifier: held-out accuracy, the counterfactual penalty, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import queries, toxicity

SF01 = "/root/testdata/sf0.01"


def texts(rng, n, toxic):
    base = ["the", "report", "garden", "river", "people", "market", "music", "window", "paper", "story"]
    out = []
    for _ in range(n):
        w = [rng.choice(base) for _ in range(12)]
        if toxic:
            w += rng.sample(["moron", "scumbags", "worthless"], 2)
            if rng.random() < 0.8:  # the group is named in most toxic sentences and in no other
                w.append("muslims")
        out.append(" ".join(rng.sample(w, len(w))) + ".")
    return out


def corpus(spark, rng):
    rows = [(t, y) for y in (0, 1) for t in texts(rng, 150, y)]
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(rows)], "doc_id long, text string, SCORE string")
    return docs, spark.createDataFrame([(i, y, 1) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int, quality int")


def test_identity_terms_do_not_carry_the_verdict(spark):
    docs, labels = corpus(spark, random.Random(2))
    free = toxicity.train(docs, labels, counterfactual=0.0)
    fair = toxicity.train(docs, labels, counterfactual=10.0)
    neutral = "Muslims read the paper in the garden."
    assert free.score(neutral) > 10 * fair.score(neutral) and fair.score(neutral) < 0.2
    assert abs(fair.logit(toxicity.words(neutral)) - fair.logit(toxicity.words("Christians read the paper in the garden."))) < 0.5
    for model in (free, fair):
        assert model.score("what worthless scumbags, the story") > 0.7 and model.score("the story of the river") < 0.2


def test_swaps_touch_only_sentences_with_terms():
    got = toxicity.swaps("The men slept. Women sang! Nothing here", {"g": ["men", "women"]}, turns=1)
    assert got == [({"the", "men", "slept", "women", "sang"}, {"the", "women", "slept", "men", "sang"})] or got == []
    got = toxicity.swaps("The men slept. Nothing here", {"g": ["men", "women", "boys"]}, turns=2)
    assert got == [({"the", "men", "slept"}, {"the", "women", "slept"}), ({"the", "men", "slept"}, {"the", "boys", "slept"})]
    assert toxicity.swaps(None, toxicity.IDENTITY_TERMS) == []


def test_held_out_accuracy(spark):
    found = queries.op3_toxicity(spark, SF01)
    assert found.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    got = found.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in got)
    assert hits >= 0.6 * sum(r.toxic for r in got) and hits >= 0.85 * sum(r.predicted for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, random.Random(5))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.weights.keys() == b.weights.keys() and np.allclose([*a.weights.values()], [*b.weights.values()])


def test_odd_rows(spark):
    docs, labels = corpus(spark, random.Random(3))
    odd = [(None, "moron worthless", "x"), (9000, None, "x"), (9001, "", "x"), (9002, "123 ...", "x"), (9003, "river " * 400000 + "moron worthless scumbags", "x"), (9003, "again", "x")]
    marks = labels.unionByName(spark.createDataFrame([(None, 1, 1), (9001, None, 1), (9000, 7, 1), (1, 0, 1)], labels.schema))
    all_docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    model = toxicity.train(all_docs, marks)
    scored = toxicity.score(all_docs, model, out_col="score")
    assert scored.columns == ["doc_id", "text", "score"]
    got = [r for r in scored.collect() if r.doc_id is None or r.doc_id >= 9000]
    assert len(got) == len(odd)
    blank = {r.score for r in got if not (r.text or "").strip("123 .")}
    assert len(blank) == 1 and blank.pop() < 0.7
    assert all(r.score > 0.7 for r in got if r.text and "moron" in r.text)


@pytest.mark.parametrize("kind", [[], [0], [1]])
def test_one_class_or_none(spark, kind):
    docs, labels = corpus(spark, random.Random(3))
    model = toxicity.train(docs, labels.where(F.col("toxic").isin(kind)) if kind else labels.limit(0))
    assert {round(r.toxicity) for r in toxicity.score(docs, model).collect()} == {1 if kind == [1] else 0}
    assert toxicity.score(docs.limit(0), model).collect() == []
