"""Embedding near-dedup and exact top-k against brute force."""

import numpy as np
import pytest

from concord.llm import embedding_dedup, topk
from concord.llm.embedding_dedup import encode, open_links, tile_pairs


def vectors(rng, n=300, dim=16):
    base = rng.normal(size=(n, dim))
    near = base[:80] + rng.normal(scale=0.25, size=(80, dim)) * np.linalg.norm(base[:80], axis=1, keepdims=True) / np.sqrt(dim)
    return np.concatenate([base, near, base[:5] * 3.0, base[:3] * 1e-200, base[:3] * 1e200])


def cosines(x):
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    return unit @ unit.T


@pytest.mark.parametrize("dim", [1, 16, 1500])
def test_bounds_hold_and_no_pair_is_missed(dim):
    rng = np.random.default_rng(dim)
    x = vectors(rng, 120, dim) if dim > 1 else rng.normal(size=(60, 1))
    codes = encode(np.ascontiguousarray(x))
    unit = codes.data / codes.norms[:, None]
    bound = np.outer(codes.scale, codes.scale) * (codes.codes.astype(float) @ codes.codes.T.astype(float))
    slack = codes.error[:, None] + codes.error[None, :] + np.outer(codes.error, codes.error)
    assert (np.abs(unit @ unit.T - bound) <= slack).all()
    cos = cosines(x)
    proved = {(int(i), int(j)) for a, b, s in tile_pairs(codes, codes, 0.9, True, products=5000) for i, j in zip(a[s], b[s], strict=True)}
    checked = {(int(i), int(j)) for a, b in open_links(codes, codes, 0.9, True) for i, j in zip(a, b, strict=True)}
    assert not proved & checked and all(cos[i, j] >= 0.9 for i, j in proved)
    got = proved | checked
    sure = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if cos[i, j] >= 0.9 + 1e-12}
    assert sure <= got and all(cos[i, j] >= 0.9 - 1e-12 for i, j in got)


@pytest.mark.parametrize("tile_rows", [1 << 13, 100, 3])  # with tiles of three rows some are empty
def test_near_vectors_equals_brute_force(spark, tile_rows):
    rng = np.random.default_rng(4)
    x = vectors(rng)
    rows = [(1000 + k, v.tolist(), 0, "x") for k, v in enumerate(x)]
    rows += [(k, x[7].tolist(), 1, "x") for k in range(200)]  # one vector holds a third of all rows
    odd = [(5000, None, 0, "x"), (5001, [], 0, "x"), (5002, [0.0] * 16, 0, "x"), (5003, [float("nan")] * 16, 0, "x"), (5004, [None] + [1.0] * 15, 0, "x"),
           (5005, [float("inf")] * 16, 0, "x"), (5006, [1.0, 2.0], 0, "x"), (None, x[7].tolist(), 0, "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, links int, kept string")
    got = {r.id: r for r in embedding_dedup.near_vectors(df, tile_rows=tile_rows).collect()}
    assert len(got) == len(rows) + len(odd)
    ids, all_x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    link = cosines(all_x) >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(ids))
    order = np.argsort(ids)
    rank = np.empty(len(ids), int)
    rank[order] = np.arange(len(ids))
    label = rank.copy()
    while True:
        low = np.array([min([label[i], *label[link[i]]]) for i in range(len(ids))])
        if (low == label).all():
            break
        label = low
    for k, i in enumerate(ids.tolist()):
        r, want = got[i], int(ids[order[label[k]]])
        assert (r.n_links, r.component, r.kept) == (link[k].sum(), want, want == i)
    for i in (5000, 5001, 5002, 5003, 5004, 5005, 5006):
        assert (got[i].n_links, got[i].component, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component, got[None].kept) == (0, None, False)
    assert embedding_dedup.near_vectors(df.limit(0)).collect() == []


def brute_top(ids, x, queries, k):
    out = []
    for q in queries:
        own = x[ids.index(q)]
        scores = sorted(((-int(own @ x[j]), ids[j]) for j in range(len(ids)) if ids[j] != q))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile_rows,query_rows", [(1 << 14, 1 << 11), (40, 3)])
def test_top_k_equals_brute_force(spark, tile_rows, query_rows):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    x = rng.normal(size=(260, 8)).round(2)
    x[100:190] = x[100]  # ties
    x[:, 3] = 0.0
    ids = list(range(0, 1300, 5))
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x, strict=True)]
    odd = [(10**6, None, 1), (10**6 + 50, [float("nan")] * 8, 1), (10**6 + 100, [None] * 8, 1), (None, [1.0] * 8, 1), (10**6 + 150, [1.0, -1.0], 1), (0, x[0].tolist(), 2), (10**6 + 200, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df, F.expr("id % 50 = 0"), k=5, scale=256, tile_rows=tile_rows, query_rows=query_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    codes = np.floor(256 * x).astype(int)
    assert sorted(map(tuple, got.collect())) == brute_top(ids, codes, [i for i in ids if i % 50 == 0], 5)
    few = topk.top_k(df.where("vec_id in (0, 5, 10)"), F.expr("id % 50 = 0"), k=5)
    assert [(r.rank, r.query_id) for r in few.orderBy("rank").collect()] == [(1, 0), (2, 0)]
    assert topk.top_k(df.limit(0), F.expr("id % 50 = 0")).collect() == []


@pytest.mark.parametrize("tile_rows", [1 << 14, 40])
def test_top_k_with_large_components(spark, tile_rows):
    """Products beyond 2^53, and beyond a long, are in exact order; a long at its limit is what is returned."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 64))
    x[3] *= 1e6
    x[50] *= 1e6  # a query
    x[51] = 1e6
    x[52] = np.where(np.arange(64) == 0, 1e6 + 2.0**-8, 1e6)  # differs from the row before in the last digits
    x[100] = 1e9
    x[101] = 2e9
    x[102] = 1e300
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.expr("id % 50 = 0"), k=5, tile_rows=tile_rows)
    codes = [[int(np.floor(256 * v)) if abs(v) < 2.0**45 else int(v) * 256 for v in row] for row in x]
    want = []
    for q in (0, 50, 100):
        scores = sorted((-sum(a * b for a, b in zip(codes[q], c, strict=True)), i) for i, c in enumerate(codes) if i != q)[:5]
        want += [(q, k + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got.collect())) == want


def test_reading_stops_early():
    rng = np.random.default_rng(6)
    x = rng.normal(scale=0.01, size=(20000, 4))
    x[:10] += 1.0
    lists = topk.SortedLists(np.arange(20000), np.floor(256 * x))
    seen = []
    scored = lists.data
    class Spy:  # counts the rows that are scored
        def __getitem__(self, rows):
            seen.append(len(rows))
            return scored[rows]
    lists.data = Spy()
    ids, scores = lists.best(np.floor(256 * x[0]), 0, 5)
    assert len(ids) == 5 and set(ids.tolist()) <= set(range(10)) and sum(seen) < 2000
