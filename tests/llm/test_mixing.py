"""The Pfair mix against a plain simulation, and its deviation bound."""

import itertools
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from concord.llm import mixing


@pytest.mark.parametrize("seed", range(25))
def test_every_source_is_less_than_one_block_off_its_exact_share(seed):
    """At every slot of a random mix, against the shares themselves: the bound of the method, for any number of slots."""
    rng = random.Random(seed)
    weights = {f"s{k}": rng.choice([rng.random(), rng.random() ** 8, rng.randint(1, 9), 1e-4]) for k in range(rng.randint(1, 12))}
    shares = mixing.exact_shares(weights)
    assert sum(shares.values()) == 1 and all(shares[s] == Fraction(x) / sum(map(Fraction, weights.values())) for s, x in weights.items())
    blocks = {s: rng.randint(0, int(2900 * x)) for s, x in shares.items()}
    had, at = Counter(), 0
    for s, k, release, deadline, slot in mixing.slots_of(shares, dict.fromkeys(shares, 10**9)):
        assert slot == at and k == had[s] and release <= slot < deadline and (release, deadline) == mixing.window(shares[s], k)
        had[s] += 1
        at += 1
        assert all(abs(had[x] - at * w) < 1 for x, w in shares.items())
        if at == 3000:
            break
    # sources that end leave their slots to nobody: the blocks that there are have the same slots
    plan = {(s, k): slot for s, k, _, _, slot in itertools.islice(mixing.slots_of(shares, dict.fromkeys(shares, 10**9)), 3000)}
    placed = [(s, k, slot) for s, k, _, _, slot in mixing.slots_of(shares, blocks)]
    assert len(placed) == sum(blocks.values()) and all(k < blocks[s] and plan[s, k] == slot for s, k, slot in placed)


def test_exact_shares():
    assert mixing.exact_shares({"a": 0.5, "b": 0.25, "c": 0.0, "d": -1.0}) == {"a": Fraction(2, 3), "b": Fraction(1, 3)}
    assert mixing.exact_shares({}) == {} and list(mixing.slots_of({}, {"a": 3})) == []


def test_mix_equals_simulation(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["x", "x", "y", "z", None]), "w" * rng.choice([0, 1, 5, 30, 400]), 0) for i in range(300)]
    rows += [(1000, "y", None, 0), (None, "y", "no id", 0), (5, "x", "again", 0), (5, "x", "again", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, MIX_SLOT int")
    shares = {"x": 0.2, "y": 0.3, None: 0.5}
    mixed = mixing.mix(df, shares, block_bytes=64, range_rows=20)
    assert mixed.columns == ["doc_id", "source", "text", *mixing.COLUMNS]
    got = mixed.collect()
    assert len(got) == len(rows)
    target = {s: Fraction(w) / sum(map(Fraction, shares.values())) for s, w in shares.items()}
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    # a plain simulation over slots: at each slot the released block with the earliest deadline
    slots = {}
    done = Counter()
    for slot in range(5000):
        open_ = [(math.ceil((done[s] + 1) / w), "s" + s if s else "n", s) for s, w in target.items() if math.floor(done[s] / w) <= slot]
        _, _, s = min(open_)
        slots[s, done[s]] = slot
        done[s] += 1
    for s, docs in by.items():
        docs.sort(key=lambda r: r.mix_offset)
        at = 0
        for r in docs:
            assert r.mix_offset == at and r.mix_block == at // 64
            at += len((r.text or "").encode()) + 1
            if s == "z":
                assert r.mix_slot is None
            else:
                assert r.mix_slot == slots[s, r.mix_block] and r.mix_release <= r.mix_slot < r.mix_deadline
    ordered = mixing.in_order(mixed, 3)
    parts = ordered.rdd.glom().collect()
    flat = [(r.mix_slot is None, r.mix_slot or 0, r.mix_offset) for p in parts for r in p]
    assert len(parts) == 3 and flat == sorted(flat) and len(flat) == len(rows)


def test_default_shares_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "x" * 99), (2, "b", "x" * 24)], "doc_id long, source string, text string")
    got = {r.source: r for r in mixing.mix(df, block_bytes=10).collect()}
    assert got["a"].mix_slot == 0 and got["b"].mix_deadline == 3  # 100 : 25 bytes -> 2 : 1
    empty = mixing.in_order(mixing.mix(df.limit(0)))
    assert empty.collect() == [] and empty.columns == ["doc_id", "source", "text", *mixing.COLUMNS]


def _simulated(got, target, block):
    """One block a slot, within its window, and no source a block off its exact share."""
    total, slots = sum(target.values()), {}
    for r in got:
        assert r.mix_release <= r.mix_slot < r.mix_deadline and r.mix_block == r.mix_offset // block
        assert slots.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)
        share = target[r.source] / total
        assert -1 < r.mix_block - r.mix_slot * share < 1


@pytest.mark.parametrize("broadcast_slots", [1 << 17, 0])
def test_more_sources_than_the_least_period(spark, monkeypatch, broadcast_slots):
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", broadcast_slots)
    rows = [(k, f"s{k}", "x" * 9) for k in range(1200)] + [(2000 + k, "hot", "x" * 9) for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, block_bytes=10, range_rows=64).collect()
    assert sorted((r.doc_id, r.source, r.text) for r in got) == rows
    _simulated(got, {s: n**0.5 for s, n in Counter({f"s{k}": 10 for k in range(1200)} | {"hot": 15000}).items()}, 10)


def test_small_share_over_many_blocks(spark):
    rows = [(k, "a" if k < 3000 else "b", "x" * 9) for k in range(3003)]
    shares = {"a": 0.9999, "b": 0.0001, "c": 0.0}
    df = spark.createDataFrame([*rows, (9999, "c", "no slot")], "doc_id long, source string, text string")
    got = mixing.mix(df, shares, block_bytes=10).collect()
    assert [r.mix_slot for r in got if r.source == "c"] == [None] and len(got) == 3004
    _simulated([r for r in got if r.source != "c"], shares, 10)


def test_null_ids_and_rows_without_a_slot_are_spread(spark):
    df = spark.createDataFrame([(None, "ab"[k % 2], f"text {k}") for k in range(2000)], "doc_id long, source string, text string")
    mixed = mixing.mix(df, {"a": 1.0}, range_rows=50)
    sizes = [len(p) for p in mixing.in_order(mixed, 8).rdd.glom().collect()]
    assert sum(sizes) == 2000 and max(sizes[4:]) < 400 and [r.mix_slot for r in mixed.collect()].count(None) == 1000
    ranges = mixed.select("source", "text", "mix_offset").where("source = 'b'").collect()
    assert len({r.mix_offset for r in ranges}) == 1000


def test_any_column_names(spark):
    names = ["__source", "__hash", "__bytes", "__text", "__range", "__k", "__w", "doc", "range", "block", "slot", "hash", "bytes", "id", "c0", "a.b"]
    df = spark.createDataFrame([(1, "a", "x", *range(16)), (2, None, None, *range(16))], ["doc_id", "source", "text", *names])
    got = mixing.in_order(mixing.mix(df), 2)
    assert got.columns == ["doc_id", "source", "text", *names, *mixing.COLUMNS]
    assert {r[0]: tuple(r[3:19]) for r in got.collect()} == {1: tuple(range(16)), 2: tuple(range(16))}


def test_texts_that_are_not_asked_for_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string").write.parquet(str(tmp_path / "t"))
    mixed = mixing.mix(spark.read.parquet(str(tmp_path / "t"))).select("doc_id", "mix_slot")
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "AS c2" not in plan and "AS c0" in plan
