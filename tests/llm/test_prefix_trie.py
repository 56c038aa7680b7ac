"""Prefix trie against brute force: hot paths over many shards, deep chains, odd rows; parts of the skeleton."""

import random
import zlib
from hashlib import sha256

import pytest

from concord.llm import prefix_trie
from concord.llm.prefix_trie import TURN, Skeleton, common, paths, rebuilt, splitters, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(role, text):
    return sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:TURN]


def brute(rows, group=5, heads=9):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, key(role, text), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % group if c >= 0 else -(-c % group))
        path = tuple(own.get(base, [])[:h] + turns[h:]) if heads > 1 else tuple(turns)
        for d in range(len(path) + 1):
            n = nodes.setdefault(path[:d], {"all": [], "ends": [], "children": set()})
            n["all"].append(c)
            if d < len(path):
                n["children"].add(path[: d + 1])
            else:
                n["ends"].append(c)
    below = {p: [q for q in nodes if q[: len(p)] == p] for p in nodes}
    saved = lambda p: (len(nodes[p]["all"]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (
            min(n["all"]), len(p), min(nodes[p[:-1]]["all"]) if p else -1, len(n["all"]), len(n["children"]),
            sum(not nodes[q]["children"] for q in below[p]), sum(map(saved, below[p])),
            sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),
        )
        for p, n in nodes.items()
    )


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def run(spark, rows, **kw):
    return found(trie(rebuilt(paths(conversations(spark, rows), group=5)), **kw))


def made(seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(-12, 110):
        if c % 3 == 0:  # a third are one conversation
            turns = [("user", "same"), ("assistant", "answer é"), ("user", "again")]
        else:
            turns = [(rnd.choice(["user", "tool", None]), rnd.choice(["a", "b", "", None, "long " * 50])) for _ in range(rnd.randint(1, 14))]
        rows += [(c, rnd.choice([k, k, k, None, 1]), *t) for k, t in enumerate(turns)]
    rows += [(None, 1, "user", "nobody's"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize(("shards", "piece"), [(1, 1 << 16), (7, 8), (40, 1 << 16)])
def test_against_brute_force(spark, monkeypatch, shards, piece):
    monkeypatch.setattr(prefix_trie, "ID_PIECE", piece)
    rows = made(shards)
    assert run(spark, rows, shards=shards) == brute(rows)


def test_hot_path_is_split_over_shards(spark):
    rows = [(c * 5, 0, "user", "same") for c in range(400)]
    df = rebuilt(paths(conversations(spark, rows), group=5))
    top = prefix_trie.skeleton(df.select("conv_id", prefix_trie._path_of("turns").alias("path")), 8)
    used = {top.shard(key("user", "same"), c * 5) for c in range(400)}
    assert len(used) == 8 and len(top.parent) == 2
    assert found(trie(df, shards=8)) == brute(rows)


def test_deep_chain(spark):
    rows = [(c, k, "user", f"turn {min(k, 390 + c)}") for c in (0, 5, 10) for k in range(400)]
    rows += [(15, k, "user", "x") for k in range(9, 12)]
    assert run(spark, rows, shards=3) == brute(rows)


def test_odd_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    one = [(c, None, None, None)]  # its only turn gives way to a conversation that is not there
    assert run(spark, one) == brute(one) == [(c, 0, -1, 1, 0, 1, 0, sha256(str(c).encode()).hexdigest())]
    extra = conversations(spark, [(0, 0, "user", "x"), (5, 0, "user", "x")]).selectExpr("*", "1 as base", "2 as path", "'z' as turns", "3 as shard")
    assert found(trie(rebuilt(paths(extra, group=5)), shards=2)) == brute([(0, 0, "user", "x"), (5, 0, "user", "x")])


def test_splitters_are_short_and_in_order():
    rnd = random.Random(1)
    turns = [bytes([i]) * TURN for i in range(4)]
    keys = [(b"".join(rnd.choices(turns, k=rnd.randint(0, 30))), i) for i in range(500)]
    got = splitters(keys, 20)
    assert got == sorted(got) and len(got) == 19
    assert sum(len(p) for p, _ in got) < sum(len(p) for p, _ in sorted(keys)[::25])
    dealt = [Skeleton(got).shard(*k) for k in sorted(keys)]
    assert dealt == sorted(dealt) and max(dealt.count(s) for s in range(20)) <= 40
    assert splitters([], 5) == [] and splitters(keys[:1], 5) == []


def test_nodes_in_two_shards_are_in_the_skeleton():
    rnd = random.Random(2)
    turns = [bytes([i]) * TURN for i in range(3)]
    keys = sorted((b"".join(rnd.choices(turns, k=rnd.randint(0, 6))), i) for i in range(600))
    top = Skeleton(splitters(keys[::3], 16))
    shards = {}
    for p, c in keys:
        for d in range(len(p) // TURN + 1):
            shards.setdefault(p[: d * TURN], set()).add(top.shard(p, c))
    for p, used in shards.items():
        assert len(used) == 1 or len(top.along(p)) == len(p) // TURN + 1


def test_common():
    a, b = b"x" * 64, b"x" * 40 + b"y" * 24
    assert common(a, b) == 2 and common(a, a) == 4 and common(a, b"") == 0 and common(a, a[:32]) == 2


def test_turns_are_never_shuffled_with_their_texts(spark):
    df = rebuilt(paths(conversations(spark, made(0)), group=5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert df.schema["turns"].dataType.elementType.fieldNames() == ["key", "bytes"]
