"""Simple-8b round trips, and files against the tokenizers library."""

import io
import random
import zlib

import numpy as np
import pytest

from concord.llm import simple8b
from concord.llm.queries import BYTE_BPE


def arrays():
    rng = np.random.default_rng(3)
    yield np.empty(0, "<u8")
    for n in (1, 2, 59, 60, 61, 1023, 1024, 1025, 5000):
        yield np.zeros(n, "<u8")
        yield rng.integers(0, 50257, n).astype("<u8")
        yield (np.uint64(1) << rng.integers(0, 64, n).astype("<u8")) - np.uint64(1)
        yield np.full(n, (1 << 64) - 1, "<u8")
        mixed = rng.integers(0, 16, n).astype("<u8")
        mixed[:: 7] = (1 << 63) + 5
        yield mixed


def test_pack_round_trip():
    for ids in arrays():
        table, words, escapes = simple8b.pack(ids)
        assert (simple8b.unpack(table, words, escapes) == ids).all() and table[:, 0].sum() == len(ids)
        assert len(escapes) == (ids >= np.uint64(1 << 60)).sum()


def test_words_hold_as_many_ids_as_fit():
    plain = lambda v, w: all(x < 1 << w for x in v)
    rng = random.Random(8)
    ids = [rng.choice([0, 1, 3, 200, 50000, 1 << 40]) for _ in range(700)]
    at = n = 0
    while at < len(ids):
        at += next(c for w, c in zip(simple8b.WIDTHS, simple8b.COUNTS, strict=True) if plain(ids[at : at + c], w))
        n += 1
    assert len(simple8b.pack(np.array(ids, "<u8"))[1]) == n


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def test_file_and_single_blocks(monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT", 3000)
    rng = np.random.default_rng(5)
    docs = [(None, rng.integers(0, 9, 5)), (-3, np.empty(0)), (1, rng.integers(0, 50257, 20000)), (2, rng.integers(0, 1 << 62, 10)), (2, np.zeros(1))]
    docs = [(i, a.astype("<u8")) for i, a in docs]
    out = Source()
    w = simple8b.Writer(out)
    for i, a in docs:
        w.add(i, a)
    w.close()
    r = simple8b.Reader(out)
    got = [(i, np.concatenate([*p, np.empty(0, "<u8")])) for i, _, p in r.documents()]
    assert [i for i, _ in got] == [i for i, _ in docs] and all((x[1] == y[1]).all() for x, y in zip(got, docs, strict=True))
    all_ids = np.concatenate([a for _, a in docs])
    place = r.places[2]
    begin = int(place["first"])
    assert (r.segment(2, slice(1, 2)) == all_ids[begin + 1024 : begin + 2048]).all()
    with pytest.raises(ValueError):
        simple8b.Reader(Source(out.getvalue()[:-1]))
    empty = Source()
    simple8b.Writer(empty).close()
    assert list(simple8b.Reader(empty).documents()) == []


def test_files_of_odd_rows(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    texts = [None, "", "a  b \n c", " x", "the <|endoftext|> end  ", "word " * 9000, "é漢😀 \x85 z", "tie", "tie"]
    rows = [(k if k < 8 else 7, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    files = simple8b.write(simple8b.by_id(df), simple8b.library(spark, BYTE_BPE))
    got = sorted(simple8b.read(files).collect(), key=lambda r: r.start)
    at = 0
    for r, (i, t, _) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        want = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        assert (r.id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (i, at, len(want) // 4, zlib.crc32(want))
        at += len(want) // 4
    assert simple8b.read(simple8b.write(simple8b.by_id(df.limit(0)), simple8b.library(spark, BYTE_BPE))).collect() == []
    raw = spark.createDataFrame([(2, b"\x01\x00\x00\x00"), (3, None)], "k long, v binary").coalesce(1)
    assert [tuple(r) for r in simple8b.read(simple8b.write(raw, None, "k", "v")).orderBy("id").collect()] == [(2, 0, 1, b"\x01\x00\x00\x00"), (3, 1, 0, b"")]


def test_pieces_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    codec = simple8b.LibraryCodec(library.to_str())
    rng = random.Random(4)
    parts = ["a", "the", "it's", ".", ",", "?!", "é,", "1.", "***", "'", "'s", "_", "|>", "\n", "\n", "\r\n", " ", " ", " ", " ", "  ", "\n", "\t", "'s", "é", "!!", "1", "漢", "<|endoftext|>", " ", "\x1c", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(20000)]
    texts += [" ".join("".join(rng.choice("abcdeéßñ漢Яطのthingeraion") for _ in range(rng.randint(1, 12))) for _ in range(8)) for _ in range(5000)]
    codec.KEPT = 900  # older generations are looked up as well
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
