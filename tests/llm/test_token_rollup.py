"""Rollups against a recount, replayed and lost commits, any tokenizer."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from concord.llm import bpe, token_rollup
from concord.llm.queries import BYTE_BPE
from concord.llm.store import new_folder

DOCS = "doc_id long, source string, lang string, text string, n_docs int, tokenizer string"


@pytest.fixture
def state(spark):
    return token_rollup.Rollup(spark, new_folder(spark, "rollup test"))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], DOCS)


def counts(rows):
    out, docs = Counter(), Counter()
    for _, source, lang, text in rows:
        out[source, lang] += len((text or "").split())
        docs[source, lang] += 1
    return {(s, la, "words-1", n, out[s, la]) for (s, la), n in docs.items()}


def signed(spark, rows, sign):
    return token_rollup.signed(frame(spark, rows), sign, "words-1", token_rollup.TOKENIZERS["words-1"](F.col("text")))


def test_random_batches_equal_a_recount(spark, state):
    rng = random.Random(3)
    live, n = [], 0
    for batch in range(5):
        gone = rng.sample(live, len(live) // 3)
        new = [(n + k, rng.choice(["a", "b", None]), rng.choice(["de", None]), rng.choice([None, "", "one", "w " * rng.randint(1, 2000)])) for k in range(12)]
        n += len(new)
        new.append(new[-1])  # a repeated row counts twice
        for r in gone:
            live.remove(r)
        live += new
        rows = signed(spark, new, 1)
        if gone:
            rows = rows.unionByName(signed(spark, gone, -1))
        assert state.apply(f"batch/{batch} é", rows)
        assert not state.apply(f"batch/{batch} é", rows)
        if batch == 3:
            assert state.compact() and not state.compact()
        assert {tuple(r) for r in state.totals().collect()} == counts(live)
    assert state.committed() >= {f"batch/{k} é" for k in range(5)}
    assert not state.apply("batch/0 é", rows)


def test_a_lost_driver_leaves_no_trace(spark, state, monkeypatch):
    rows = signed(spark, [(1, "a", "de", "x y")], 1)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(state, "_create", lost)
        with pytest.raises(RuntimeError):
            state.apply("b", rows)
    assert state.totals().collect() == [] and state.committed() == set()
    assert state.apply("b", rows) and [tuple(r) for r in state.totals().collect()] == [("a", "de", "words-1", 1, 2)]
    # two drivers at once: the second finds the marker
    other = token_rollup.Rollup(spark, state.folder)
    monkeypatch.setattr(other, "committed", set)
    assert not other.apply("b", rows) and len(state.totals().collect()) == 1


@pytest.mark.parametrize("written", [0, 1, 20, None])
@pytest.mark.parametrize("step", ["apply", "compact"])
def test_a_driver_lost_inside_the_marker(spark, state, monkeypatch, step, written):
    """The marker is there, with none, some or all of its text; None: lost before it."""
    docs = [(k, "a", "de", "x y") for k in range(3)]
    assert state.apply("b0", signed(spark, docs[:1], 1)) and state.apply("b1", signed(spark, docs[1:2], 1))
    run = state.compact if step == "compact" else lambda: state.apply("b2", signed(spark, docs[2:], 1))
    there = docs[:2]

    def lost(stream, text):
        stream.write(bytearray(text[:written]))
        stream.close()
        raise RuntimeError("lost")

    def lost_before(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(state, *(("_create", lost_before) if written is None else ("_write", lost)))
        with pytest.raises(RuntimeError, match="lost"):
            run()
    again = token_rollup.Rollup(spark, state.folder)  # another driver
    assert {tuple(r) for r in again.totals().collect()} == counts(there) and again.committed() == {"b0", "b1"}
    assert (again.compact() if step == "compact" else again.apply("b2", signed(spark, docs[2:], 1)))
    done = docs if step == "apply" else there
    assert {tuple(r) for r in again.totals().collect()} == counts(done)
    assert not again.apply("b0", signed(spark, docs[:1], 1))
    assert again.apply("b3", signed(spark, docs[2:], 1)) and again.compact()
    assert {tuple(r) for r in again.totals().collect()} == counts([*done, docs[2]])


def test_a_slow_driver_and_its_retry_count_once(spark, state, monkeypatch):
    rows = signed(spark, [(1, "a", "de", "x y")], 1)
    held = []
    with monkeypatch.context() as m:
        m.setattr(state, "_write", lambda stream, text: held.append((stream, text)))
        assert not state.apply("b", rows)  # its marker is open, not whole
    retry = token_rollup.Rollup(spark, state.folder)
    assert retry.apply("b", rows)
    state._write(*held[0])  # it was only slow
    assert [tuple(r) for r in state.totals().collect()] == [("a", "de", "words-1", 1, 2)] and not state.apply("b", rows)


def test_overlapping_compactions_count_each_batch_once(spark, state, monkeypatch):
    docs = [(k, "a", "de", "x y") for k in range(5)]
    for k in (0, 1):
        assert state.apply(f"b{k}", signed(spark, [docs[k]], 1))
    seen = state._markers()
    assert state.apply("b2", signed(spark, [docs[2]], 1))
    late = token_rollup.Rollup(spark, state.folder)
    monkeypatch.setattr(late, "_markers", lambda: seen)
    assert state.compact() and not late.compact()
    assert {tuple(r) for r in state.totals().collect()} == counts(docs[:3])
    # the next generation, beside which a batch is committed after the markers are read
    assert state.apply("b3", signed(spark, [docs[3]], 1))
    beside = token_rollup.Rollup(spark, state.folder)
    read = beside._markers

    def markers():
        found = read()
        state.apply("b4", signed(spark, [docs[4]], 1))
        return found

    monkeypatch.setattr(beside, "_markers", markers)
    assert beside.compact() and state.committed() >= {f"b{k}" for k in range(5)}
    assert {tuple(r) for r in state.totals().collect()} == counts(docs)
    assert state.compact() and {tuple(r) for r in state.totals().collect()} == counts(docs)


def test_everything_deleted_and_empty_batches(spark, state):
    docs = [(1, "a", "de", "x"), (2, None, None, None)]
    assert state.apply("in", signed(spark, docs, 1)) and state.apply("out", signed(spark, docs, -1))
    assert state.apply("none", signed(spark, docs, 1).limit(0))
    assert state.totals().collect() == []


def test_counts_of_a_bpe_tokenizer(spark, state):
    docs = frame(spark, [(1, "a", "en", "the cat sat"), (2, "a", "en", None)])
    ids = bpe.encode(docs, BYTE_BPE)
    assert state.apply("b", token_rollup.signed(ids, 1, "byte_bpe_50k", F.size("ids")))
    assert [tuple(r) for r in state.totals().collect()] == [("a", "en", "byte_bpe_50k", 2, 3)]
