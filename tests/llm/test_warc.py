"""WARC archives: round trips of odd pages and of payloads in many chunks."""

import gzip
import hashlib
import io

import pytest

from concord.llm import warc


def want(rows, least):
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "") == (html or "")]
        first = max(same, default=None) if len(data) >= least else None
        other = first is not None and first != i
        out.append((i, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", first if other else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/\r\nX: y", "x" * 999), (2, None, "x" * 999), (3, "http://é/ %41?", "é" * 500), (4, "u", "é" * 500), (4, "u", "é" * 500), (5, "u", None),
        (6, "u", ""), (7, "", "WARC/1.1\r\n\r\n" * 5000), (8, "u", "漢" * 100000), (9, "u", "漢" * 100000), (None, "u", "漢" * 100000), (None, "v", "only here" * 300), (10, "u", "\r\n\r\n")]


@pytest.mark.parametrize("size", [warc.CHUNK, 4096, 333])
def test_round_trip(spark, size):
    df = spark.createDataFrame([(*r, "x", 0) for r in ROWS], "page_id long, url string, html string, digest string, chunk int").repartition(3)
    table = warc.chunks(warc.records(df), size)
    assert table.agg({"chunks": "max"}).first()[0] == max(1, -(-300000 // size))
    files = warc.write(table)
    got = sorted((tuple(r) for r in warc.read(files).collect()), key=repr)
    assert got == want(ROWS, 1000)
    with gzip.open(files.first().file.removeprefix("file://")) as f:  # any reader of WARC sees whole members
        assert f.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def archive(*rows):
    out = io.BytesIO()
    w = warc.Writer(out)
    for r in rows:
        w.add(*r, spare="none-0-0")
    return out.getvalue()


def test_chunks_come_back_with_running_digests():
    data = b"abc" * 50000
    digest = hashlib.sha1(data).hexdigest()
    cut = [data[k : k + 40000] for k in range(0, len(data), 40000)]
    raw = archive(*[(1, "u", len(data), digest, None, k, len(cut), c) for k, c in enumerate(cut)])
    seen = b""
    for head, number, part, so_far, size in warc.read_chunks(io.BytesIO(raw)):
        seen += part
        assert len(part) <= 4 * warc._READ and so_far == hashlib.sha1(seen).hexdigest() and size == len(seen)
        assert head["WARC-Record-ID"] == "<urn:concord:page:1>" and (number > 0) == bool(part)
    assert seen == data
    for broken in (raw[:-9], raw[:200], raw.replace(raw[:4], b"\x00\x00\x00\x00", 1)):
        with pytest.raises((ValueError, warc.zlib.error)):
            list(warc.read_chunks(io.BytesIO(broken)))


def test_wrong_digests_are_refused():
    with pytest.raises(ValueError):
        archive((1, "u", 3, hashlib.sha1(b"abd").hexdigest(), None, 0, 1, b"abc"))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(warc.chunks(warc.records(df)))).collect() == []
