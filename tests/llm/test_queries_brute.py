"""The registered queries that SQL cannot express, with their own parameters, against brute force: all columns."""

import math
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from concord.llm import mixing, queries

from .test_simhash import brute_components, brute_fingerprint
from .test_vectors import brute_top, cosines

SF001 = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{SF001}/{name}.parquet").to_pylist()


def result(spark, name, columns):
    df = queries.QUERIES[name](spark, SF001)
    assert df.columns == columns
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.BYTE_BPE)


def test_op1_bpe(spark, library):
    digest = lambda s: sha256(s.encode()).hexdigest()
    want = []
    for r in table("documents"):
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert result(spark, "op1_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == sorted(want)


def test_op2_embedding_dedup(spark):
    rows = sorted(table("embeddings"), key=lambda r: r["vec_id"])
    ids = [r["vec_id"] for r in rows]
    link = cosines(np.array([r["embedding"] for r in rows], "f8")) >= 0.9
    np.fill_diagonal(link, False)
    component = np.arange(len(ids))
    while True:
        low = np.array([min([component[i], *component[link[i]]]) for i in range(len(ids))])
        if (low == component).all():
            break
        component = low
    want = [(i, int(link[k].sum()), ids[component[k]], bool(component[k] == k)) for k, i in enumerate(ids)]
    assert result(spark, "op2_embedding_dedup", ["vec_id", "n_links", "component_id", "kept"]) == want


def test_op4_simhash(spark):
    rows = table("documents")
    ids, fps = [r["doc_id"] for r in rows], [brute_fingerprint(r["text"], 4) for r in rows]
    component = brute_components(fps, ids, 4)
    want = sorted((i, f"{fp:016x}", component[i]) for i, fp in zip(ids, fps, strict=True))
    assert result(spark, "op4_simhash", ["doc_id", "fingerprint", "component_id"]) == want


def test_op8_token_ids(spark, library):
    want, at = [], 0
    for r in sorted(table("documents"), key=lambda r: r["doc_id"]):
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert result(spark, "op8_token_ids", ["doc_id", "start", "n_tokens", "ids_crc32"]) == want


def test_op9_mixing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "source", "text", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").collect()
    placed, total = [], {}
    for r in rows:
        at = total.setdefault(r.source, 0)
        placed.append((r.doc_id, r.source, at // 65536, at))
        total[r.source] = at + len(r.text.encode()) + 1
    weight = {s: Fraction(float(n) ** 0.5) for s, n in total.items()}
    share = {s: w / sum(weight.values()) for s, w in weight.items()}
    blocks = {s: -(-n // 65536) for s, n in total.items()}
    slot, done, t = {}, dict.fromkeys(share, 0), 0
    while any(done[s] < n for s, n in blocks.items()):
        _, s = min((math.ceil((k + 1) / share[s]), s) for s, k in done.items() if math.floor(k / share[s]) <= t)
        slot[s, done[s]] = t
        done[s] += 1
        t += 1
        assert all(abs(done[s] - t * w) < 1 for s, w in share.items())
    want = [(i, s, k, math.floor(k / share[s]), math.ceil((k + 1) / share[s]), slot[s, k], at) for i, s, k, at in placed]
    assert result(spark, "op9_mixing", ["doc_id", "source", *mixing.COLUMNS]) == sorted(want)


def test_op10_topk(spark):
    rows = table("embeddings")
    ids, codes = [r["vec_id"] for r in rows], np.floor(256 * np.array([r["embedding"] for r in rows], "f8")).astype(int)
    want = brute_top(ids, codes, [i for i in ids if i % 50 == 0], 5)
    assert result(spark, "op10_topk", ["query_id", "rank", "vec_id", "score"]) == want
