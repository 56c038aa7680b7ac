"""Divergence audit against brute force, with shards, passes and counters made small; perfect hashes; odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from concord.llm import divergence
from concord.llm.divergence import PerfectHash, audit, divergences, shards_of, shares, stored_key, terms_of

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, min_docs=3, top=200):
    docs = [((lang or "", source or ""), words(text)) for lang, source, text in rows]
    out = []
    for lang in {g[0] for g, _ in docs}:
        df = Counter(t for (at, _), w in docs if at == lang for t in set(w))
        kept = {t for t, n in df.items() if n >= min_docs}
        count = {g: Counter() for g, _ in docs if g[0] == lang}
        for g, w in docs:
            if g[0] == lang:
                count[g].update(t for t in w if t in kept)
        both = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q, f = {g: share(c) for g, c in count.items()}, share(both), lambda a, b: (a - b) ** 2 // b
        for g in count:
            pair = [(-sum(f(p[g][t], p[o][t]) for t in kept), o[1].encode()) for o in count if o != g]
            term = [(-f(p[g][t], q[t]), t.encode()) for t in kept if count[g][t] and p[g][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(*g, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def made(seed=5, n=300):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "été", "漢字", "x" * 100, "é" * 60, *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))]
    weight = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for k in range(n):
        text = rnd.choice([" ", ", ", "\n", "1"]).join(rnd.choices(vocabulary, weight, k=rnd.randint(0, 40)))
        rows.append((rnd.choice(["en", "en", "de", None]), "src0" if k % 3 == 0 else rnd.choice(["src1", "src2", "é", None, "10"]), text))
    return [*rows, ("en", "empty", ""), ("en", "null", None), ("xx", "a", "no term thrice"), ("xx", "b", "none"), ("yy", "only", "lone lone")]


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


@pytest.mark.parametrize(("shard_terms", "in_pass", "counters", "top"), [(1 << 15, 128, 1 << 25, 200), (16, 3, 500, 7)])
def test_against_brute_force(spark, monkeypatch, shard_terms, in_pass, counters, top):
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard_terms)
    monkeypatch.setattr(divergence, "PASS", in_pass)
    monkeypatch.setattr(divergence, "COUNTER_BYTES", counters)
    rows = made()
    assert found(audit(frame(spark, rows).repartition(5), top=top)) == brute(rows, top=top)


def test_odd_tables(spark):
    assert found(audit(frame(spark, []))) == []
    assert found(audit(frame(spark, [(None, None, None)]))) == []
    rows = [("en", "a", "x"), ("en", "b", None)]
    assert found(audit(frame(spark, rows))) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    rows = [("en", "a", "long " * 50_000)] * 3 + [("en", "b", "é long")]
    extra = frame(spark, rows).selectExpr("*", "1 as n", "2 as v", "'z' as term", "3 as shard", "4 as value")
    assert found(audit(extra)) == brute(rows)


def test_terms_are_those_of_the_pattern():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("aB [`{@\x7f\x80é漢😀Z1_\n", k=rnd.randint(0, 30))) for _ in range(400)] + ["", None, "", "x", "y"]
    for part in (pa.array(texts), pa.array(texts)[7:311], pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        terms, text = terms_of(part)
        want = [(k, w.encode()) for k, t in enumerate(part.to_pylist()) for w in words(t)]
        assert list(zip(text.tolist(), terms.to_pylist())) == want


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hash_is_minimal_and_verifies(n):
    terms = [f"term{i}".encode() * (1 + i % 7) for i in range(n)]
    made = PerfectHash.build(terms)
    assert sorted(made.slots(terms).tolist()) == list(range(n))
    assert (made.slots([b"other%d" % i for i in range(500)]) == -1).all()
    assert [made.keys[int(s)].as_py() for s in made.slots(terms[:50])] == [stored_key(t) for t in terms[:50]]


def test_terms_with_one_hash_take_another_seed(monkeypatch):
    real = divergence._hashes
    monkeypatch.setattr(divergence, "_hashes", lambda terms, seed=0: np.zeros(len(terms), np.uint64) if seed == 0 else real(terms, seed))
    made = PerfectHash.build([b"a", b"b"])
    assert made.seed == 1 and sorted(made.slots([b"a", b"b"]).tolist()) == [0, 1]


def test_stored_keys_are_bounded_and_differ():
    assert stored_key(b"a" * 32) == b"a" * 32 and len(stored_key(b"a" * 33)) == 33
    assert stored_key(b"a" * 33) != stored_key(b"a" * 34)


def test_numbers_are_exact():
    counts = np.array([0, 1, 9 * 10**9, 10**13], np.int64)
    assert shares(counts, 10**13 + 5, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (10**13 + 12) for c in counts]
    p, q = np.array([10**9 + 1, 5]), np.array([1, 10**9])
    assert divergences(p, q).tolist() == [10**18, (10**9 - 5) ** 2 // 10**9]


def test_shards_bound_terms_and_cells():
    assert shards_of(0, 5) == 0 and shards_of(1, 5) == 1 and shards_of(1 << 20, 20) == 32
    assert shards_of(1 << 20, 1280) == 320


def test_one_row_per_group_and_shard_is_shuffled(spark):
    rows = frame(spark, made(n=2000)).repartition(3)
    kept = divergence.written(divergence.kept_terms(rows), "t")
    langs = [("en", 2, 0)]
    hashes = divergence.written(divergence.perfect_hashes(kept.where("lang = 'en'"), langs), "t")
    parts = divergence.recount(divergence._named(rows, "text", "lang", "source"), hashes.inputFiles()[0].rsplit("/", 1)[0], langs)
    assert parts.count() <= 3 * rows.where("lang = 'en'").select("source").distinct().count() * 2
