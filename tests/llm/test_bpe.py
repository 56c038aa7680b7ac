"""The BPE automaton against the tokenizers library."""

import random

import numpy as np
import pytest

from concord.llm import bpe
from concord.llm.queries import BYTE_BPE


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_vocabulary(BYTE_BPE))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


PARTS = ["a", "b", "the", "ing", "tion", "aaa", "AbC", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "!!", "1", "23", "漢字", "😀", " ",
         "\x1c", "\x85", "　", "՘", "\U000323b0", "<|endoftext|>", "=" * 9, "x" * 40]


def packed(ids):
    return np.frombuffer(ids, "<i4").tolist()


def test_ids_and_texts_equal_the_library(codec, library):
    rng = random.Random(5)
    texts = ["", "a", " ", "\n \n a", "a  ", "a \n b  ", "a" * 5000, "".join(rng.choice("abcdxyz") for _ in range(3000))]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert packed(codec.encode(t)) == want, repr(t)
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == t


def test_decode_of_broken_bytes(codec, library):
    rng = random.Random(6)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(1, 8))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_automaton_accepts_exactly_the_bpe_sequences():
    """Every pair of tokens: the arc exists iff BPE gives these two tokens for their joined text."""
    labels = {b: bytes([b]) for b in range(256)}
    a, b = ord("a"), ord("b")
    merges, n = [], 256
    for u, v in [(a, a), (a, b), (256, a), (257, 256), (b, b), (256, 257), (260, 260)]:
        merges.append((u, v, n))
        labels[n] = labels[u] + labels[v]
        n += 1
    auto = bpe.MergeAutomaton(labels, merges)

    def plain(text):
        out = list(text)
        for u, v, w in merges:
            k = 0
            while k + 1 < len(out):
                if out[k : k + 2] == [u, v]:
                    out[k : k + 2] = [w]
                k += 1
        return out

    tokens = [a, b, *auto.made_at]
    for x in tokens:
        for y in tokens:
            assert auto.step(x, y) == (plain(labels[x] + labels[y]) == [x, y]), (x, y)
    rng = random.Random(1)
    for _ in range(2000):
        word = bytes(rng.choice([a, b]) for _ in range(rng.randint(1, 25)))
        assert auto.encode_word(word) == plain(word)


def test_odd_rows(spark):
    rows = [(1, None, "x", None), (2, "", "y", [9]), (None, "a b", None, None), (3, "the end " * 30000, "z", []), (3, "the end " * 30000, "z", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string, decoded array<int>")
    out = bpe.decode(bpe.encode(df, BYTE_BPE), BYTE_BPE)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted(out.collect(), key=repr)
    assert [r.decoded for r in got] == [r.text or "" for r in got]
    assert [r.ids for r in got if not r.text] == [[], []]
    fused = bpe.encode(df, BYTE_BPE, decoded_col="DECODED")
    assert fused.columns == ["doc_id", "text", "ids", "DECODED"]
    assert sorted((tuple(r) for r in fused.collect()), key=repr) == sorted((tuple(r) for r in got), key=repr)
    empty = bpe.encode(df.limit(0), BYTE_BPE, keep_text=False)
    assert empty.collect() == [] and empty.columns == ["doc_id", "decoded", "ids"]
    ids = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 10**6, -1, 65])], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decode(ids, BYTE_BPE).orderBy("k").collect()] == [None, "", "ab"]
