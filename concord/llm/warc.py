"""WARC archives through a chunked record table.

A payload is never handled as a whole outside its input row: it is cut into
rows ``(record, chunk number, bytes)``, and tasks write and read archives chunk
by chunk. A payload of several chunks becomes a WARC record and its
continuation records (``WARC-Segment-Number``), each a gzip member of its own.
Writer and reader carry the digest and the length along from chunk to chunk;
both are checked against the record's headers when its last chunk is read.

Of records with equal payloads of ``min_bytes`` or more, that with the largest
id is stored and the others refer to it (``revisit``). Payloads count as equal
if length and SHA-1 are.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.store import python_workers, new_folder, open_folder, written

CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 16
_SAFE = ":/?#[]@!$&()*+,;=~"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """``(id, url, payload binary, bytes, digest, refers_to)``: what each page is stored as.

    ``refers_to``: the id whose record holds the payload, null where the
    record holds it itself. Null payloads are empty. Rows that repeat an id
    are records of their own; where they have the largest id all of them are
    stored. A page without id is stored unless some page with an id has its
    payload.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"))
    same = (
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "bytes", "first")
    )
    refers = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    return rows.join(same, ["digest", "bytes"], "left").select("id", "url", "payload", "bytes", "digest", refers.alias("refers_to"))


def chunks(stored: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunked record table: ``(id, url, bytes, digest, refers_to, chunk, chunks, data)``.

    The chunks of a record are neighbours and in order. A record without
    payload, and one that refers to another, has one empty chunk.
    """
    here: Column = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(F.lit(0))
    n = F.greatest(F.ceil(here / size), F.lit(1)).cast("int")
    data = F.when(F.col("refers_to").isNull(), F.expr(f"substring(payload, chunk * {size} + 1, {size})")).otherwise(F.lit(b""))
    return (
        stored.withColumn("chunks", n)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("id", "url", "bytes", "digest", "refers_to", "chunk", "chunks", data.alias("data"))
    )


def _name(value) -> str:
    """A record id that holds the page's id."""
    return f"<urn:concord:page:{quote(str(value), safe='')}>"


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


class Writer:
    """One archive: a gzip member for each record or continuation."""

    def __init__(self, stream, level: int = 4):
        self.stream, self.level, self.records = stream, level, 0
        self._put([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    def _put(self, headers: list[tuple[str, str]], *block: bytes) -> None:
        member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        size = sum(map(len, block))
        head = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Date: {DATE}", f"Content-Length: {size}", "", ""]
        for part in ("\r\n".join(head).encode(), *block, b"\r\n\r\n"):
            self.stream.write(member.compress(part))
        self.stream.write(member.flush())

    def add(self, id_, url, size: int, digest: str, refers_to, chunk: int, chunks_: int, data: bytes, spare: str) -> None:
        """One row of the chunked record table; rows of a record come in order."""
        name = _name(spare if id_ is None else id_)
        if chunk == 0:
            self.records += 1
            self.sha, self.seen = hashlib.sha1(), 0
        self.sha.update(data)
        self.seen += len(data)
        head = [("WARC-Record-ID", name if chunk == 0 else f"{name[:-1]}:segment:{chunk + 1}>")]
        if url is not None:
            head.append(("WARC-Target-URI", quote(url, safe=_SAFE)))
        if refers_to is not None:
            head += [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
            head += [("WARC-Refers-To", _name(refers_to)), ("WARC-Payload-Digest", _base32(digest)), ("X-Payload-Bytes", str(size))]
            self._put(head)
            return
        if chunk + 1 == chunks_ and (self.sha.hexdigest() != digest or self.seen != size):
            raise ValueError(f"the chunks of {name} do not add up to its digest")
        if chunk == 0:
            head += [("WARC-Type", "response"), ("Content-Type", "application/http; msgtype=response")]
            head += [("WARC-Payload-Digest", _base32(digest)), ("X-Payload-Bytes", str(size))]
            if chunks_ > 1:
                head.append(("WARC-Segment-Number", "1"))
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
            self._put(head, http, data)
        else:
            head += [("WARC-Type", "continuation"), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(chunk + 1))]
            if chunk + 1 == chunks_:
                head.append(("WARC-Segment-Total-Length", str(size)))
            self._put(head, data)


class _Plain:
    """The decompressed bytes of an archive's gzip members, some at a time."""

    def __init__(self, source):
        self.source, self.member, self.rest, self.held = source, None, b"", b""

    def _more(self) -> bool:
        while True:
            data = self.rest or self.source.read(_READ)
            self.rest = b""
            if not data:
                if self.member is not None:
                    raise ValueError("the archive is cut off")
                return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            out = self.member.decompress(data, 4 * _READ)
            self.rest = self.member.unconsumed_tail
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, None
            if out:
                self.held += out
                return True

    def line(self) -> bytes | None:
        """Up to the next CRLF; None at the end."""
        while (at := self.held.find(b"\r\n")) < 0:
            if not self._more():
                if self.held:
                    raise ValueError("the archive is cut off")
                return None
        out, self.held = self.held[:at], self.held[at + 2 :]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise ValueError("the archive is cut off")
            out, self.held = self.held[:size], self.held[size:]
            size -= len(out)
            yield out


def read_chunks(source) -> Iterator[tuple[dict, int, bytes, str, int]]:
    """(headers of the record, chunk number, bytes, digest so far, length so far).

    A block is handed out in pieces of bounded size, numbered over the record
    and its continuations; every response has at least one, a revisit has one
    that is empty. The digest and the length are checked at a record's end.
    """
    plain, record, sha, seen, number = _Plain(source), None, None, 0, 0

    def check() -> None:
        if record and record["WARC-Type"] == "response" and (_base32(sha.hexdigest()) != record["WARC-Payload-Digest"] or seen != int(record["X-Payload-Bytes"])):
            raise ValueError(f"the payload of {record['WARC-Record-ID']} has another digest than its record says")

    while (first := plain.line()) is not None:
        if first != b"WARC/1.1":
            raise ValueError("a WARC record was expected")
        head = {}
        while line := plain.line():
            name, _, value = line.decode().partition(": ")
            head[name] = value
        size, kind = int(head["Content-Length"]), head["WARC-Type"]
        if kind == "continuation":
            if record is None or head["WARC-Segment-Origin-ID"] != record["WARC-Record-ID"]:
                raise ValueError("a continuation without its record")
        else:
            check()
            record, sha, seen, number = (head if kind != "warcinfo" else None), hashlib.sha1(), 0, 0
            if kind == "response":
                while line := plain.line():
                    size -= len(line) + 2
                size -= 2
            if record is not None:
                yield head, 0, b"", sha.hexdigest(), 0
        for data in plain.take(size):
            if record is not None:
                sha.update(data)
                seen += len(data)
                number += 1
                yield record, number, data, sha.hexdigest(), seen
        for end in (plain.line(), plain.line()):
            if end != b"":
                raise ValueError("a record does not end where it should")
    check()


def write(table: DataFrame) -> DataFrame:
    """Write the chunked record table, an archive per partition; returns the manifest ``(file, records)``.

    A record's chunks must be neighbours in order, as :func:`chunks` makes
    them. The manifest is a table in the shared folder and names the archives
    of the attempts that succeeded; others are not read.
    """
    spark = table.sparkSession
    python_workers(spark)
    folder = new_folder(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, stream = TaskContext.get().partitionId(), None, None
        fs, base = open_folder(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "bytes", "digest", "refers_to", "chunk", "chunks", "data")]
            for k in range(batch.num_rows):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = Writer(stream)
                row = [c[k].as_py() for c in columns]
                writer.add(*row, spare=f"none-{part}-{writer.records + (row[5] == 0)}")
        if writer is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": [writer.records]})

    return written(table.mapInArrow(run, "file string, records long"), "warc-files")


def read(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """``(id, url, payload_bytes, payload_digest, record_type, refers_to)``: each record of the archives.

    ``payload_digest``: SHA-1 in lower-case hex, and ``payload_bytes``, of the
    full payload: counted over the chunks of a response, as its record says for
    a revisit. Payloads pass by in pieces and are not kept.
    """
    python_workers(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, at = open_folder(file)
                with fs.open_input_stream(at, compression=None) as source:
                    rows, last = [], None
                    for head, number, _, digest, size in read_chunks(source):
                        if number == 0:
                            if last is not None:
                                rows.append(last)
                            if len(rows) >= 4096:
                                yield _batch(rows)
                                rows = []
                        last = (head, digest, size)
                    if last is not None:
                        rows.append(last)
                    if rows:
                        yield _batch(rows)

    text = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    files = manifest.select("file").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")
    found = files.mapInArrow(run, text)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("id", "refers_to")})


def _page(urn: str | None) -> str | None:
    if urn is None:
        return None
    value = unquote(urn.removeprefix("<urn:concord:page:").removesuffix(">"))
    return None if value.startswith("none-") else value


def _batch(rows: list[tuple[dict, str, int]]) -> pa.RecordBatch:
    out = []
    for head, digest, size in rows:
        kind, url = head["WARC-Type"], head.get("WARC-Target-URI")
        if kind == "revisit":
            digest, size = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(head["X-Payload-Bytes"])
        out.append((_page(head["WARC-Record-ID"]), url and unquote(url), size, digest, kind, _page(head.get("WARC-Refers-To"))))
    names = ("id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], list(names))
