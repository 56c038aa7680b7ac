"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash

from concord.llm import simhash


def brute_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, most=4):
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, x in zip(ids, fps, strict=True):
        for b, y in zip(ids, fps, strict=True):
            if a < b and bin(x ^ y).count("1") <= most:
                ra, rb = find(a), find(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


TEXTS = [None, "", "  \n", "one", "One TWO", "a b c d", "a b c d e", "É é Ü A", "x\x0by z\x1cq w e r", "long " * 3000]


def test_fingerprint_equals_brute_force(monkeypatch):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.randint(1, 400))) for _ in range(50)]
    want = [brute_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(simhash, "_PIECE", 7)  # words carried over between pieces
    assert [simhash.fingerprint(t) for t in texts] == want


@pytest.mark.parametrize("small", [1, 64])
def test_trie_join_finds_every_pair_once(small):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), replace=False))) for b in base for _ in range(8)]
    fps = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64)]))
    n = len(fps)
    got = [p for x, y in simhash.trie_links(fps, ([0], [n], [0], [n]), 0, 4, small) for p in zip(x, y, strict=True)]
    pairs = [tuple(sorted(p)) for p in got]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if int(fps[i] ^ fps[j]).bit_count() <= 4}
    assert set(pairs) == want
    if small == 1:
        assert len(pairs) == len(want)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("chunk", [1 << 13, 5])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = random.Random(7)
    fps = [0, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(30)]
    for b in list(fps):
        x = b
        for _ in range(rng.randint(0, 6)):
            for k in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << k
            fps.append(x)
    fps = list(dict.fromkeys(fps))
    ids = list(range(100, 100 + len(fps)))
    df = spark.createDataFrame([(signed(f), i) for f, i in zip(fps, ids, strict=True)], "fp long, node long")
    from concord.llm.components import connected_components

    got = {r.node: r.component for r in connected_components(simhash.near_links(df, chunk=chunk, batch_rows=64)).collect()}
    want = brute_components(fps, ids)
    assert {i: got.get(i, i) for i in ids} == want


def test_groups_of_odd_rows(spark):
    rng = random.Random(3)
    words = ["w%d" % k for k in range(50)]
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(80)) for _ in range(10)]
    texts += [t + " more" for t in texts[-10:]]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "one", "x", 1), (None, "one", "y", 2), (None, "only here once", "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component int")
    got = simhash.groups(df).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_components(fps, list(range(len(texts))))
    for r in got:
        if r.id is not None:
            assert (r.fingerprint, r.component) == (f"{fps[r.id]:016x}", want[r.id])
    assert sorted(str(r.component) for r in got if r.id is None) == sorted([str(want[3]), "None"])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(df).collect() == []
    assert simhash.keep_one(df).collect() == []


def test_links_come_out_of_the_walk(monkeypatch):
    """On the given documents every pair that is compared is one of leaves that the paired descent has reached."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    fps = np.unique(np.array([simhash.fingerprint(t) for t in texts], "<u8"))
    widths, tables = simhash._tables(6, 4)
    leaves, real = [], simhash._pairs

    def seen(alo, ahi, blo, bhi):
        leaves.append((ahi - alo) * (bhi - blo) == 1)  # a bucket's root has several members, so 4 pairs at least
        return real(alo, ahi, blo, bhi)

    monkeypatch.setattr(simhash, "_pairs", seen)
    links = set()
    for t in tables:
        order = [*t, *(k for k in range(6) if k not in t)]
        bits, at = np.zeros_like(fps), 64
        for k in order:
            at -= widths[k]
            part = (fps >> np.uint64(64 - sum(widths[: k + 1]))) & np.uint64((1 << widths[k]) - 1)
            bits |= part << np.uint64(at)
        by = np.argsort(bits)
        depth = sum(widths[k] for k in t)
        top = bits[by] >> np.uint64(64 - depth)
        lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
        hi = np.append(lo[1:], len(fps))
        several = hi - lo > 1
        if several.any():
            for x, y in simhash.trie_links(bits[by], (lo[several], hi[several], lo[several], hi[several]), depth, 4):
                links |= {tuple(sorted((int(a), int(b)))) for a, b in zip(by[x], by[y], strict=True)}
    want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4) + i + 1}
    assert links == {(i, int(j)) for i, j in want} and len(links) >= 2
    assert all(x.all() for x in leaves) and sum(map(len, leaves)) >= len(links)


def test_rows_with_one_id_and_unlike_texts_stay(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in "abc")
    rows = [(1, a), (1, b), (2, b), (3, a), (1, a), (4, c), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.keep_one(df).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted([(1, a), (1, b), (4, c), (4, "")])
    assert sorted((r.id, r.component) for r in simhash.groups(df).collect()) == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (1, 1), (4, 4), (4, 4), (5, 4)])


def test_keep_one_with_clashing_names(spark):
    names = ["__kept", "doc", "id", "fp", "key", "kept_id", "kept_key", "label", "a.b"]
    df = spark.createDataFrame([(1, "x", *range(9)), (2, "x", *range(9)), (None, "x", *range(9))], ["doc_id", "text", *names])
    got = simhash.keep_one(df)
    assert got.columns == df.columns and sorted((r[0] or 0, *r[2:]) for r in got.collect()) == [(0, *range(9)), (1, *range(9))]


def test_rows_are_filtered_by_one_shuffle(spark):
    df = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.keep_one(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line and "doc#" in plan.splitlines()[k + 1] for k, line in enumerate(plan.splitlines()[:-1])) <= 1
