"""Token ids in binary files, Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector and 60 bits for 60, 30, 20, ... 1 ids of
1, 2, 3, ... 60 bits. Of the selectors whose ids all fit, the one with most
ids is taken. An id of more than 60 bits is an escape: the word holds its place
among the block's escapes, which follow the block's words as they are. Blocks
of ``BLOCK`` ids are coded by themselves; a table of their places lets a
reader decode any block alone, and all blocks of a segment at once with array
operations.

File (all numbers little-endian)::

    magic                             8 bytes
    segments                          table of blocks (ids, words, escapes: 3 x u4 each), words, escapes
    documents                         i8 id, u8 number of ids, u1 whether the id is null; for each document
    places of the segments            u8 offset, u8 first id, u4 blocks, u4 0; for each segment
    trailer                           u8 offset of documents, u8 documents, u8 segments, u8 ids, magic

Documents are in ascending id order (null first) over the files in order, and
one document's ids may span blocks and segments.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.bpe import _slices, _spec, byte_alphabet, read_vocabulary
from concord.llm.pieces import PieceCodec
from concord.llm.store import python_workers, new_folder, open_folder, written

MAGIC = b"CNCRD8B\x01"
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = tuple(60 // w for w in WIDTHS)
ESCAPE = 15
BLOCK = 1024
SEGMENT = 1 << 19  # ids
_STEP = np.array([*COUNTS, 0, 1])
_LENGTH = np.array([x.bit_length() for x in range(1 << 16)], np.int8)
_PLACE = np.dtype([("at", "<u8"), ("first", "<u8"), ("blocks", "<u4"), ("zero", "<u4")])
_DOC = np.dtype([("id", "<i8"), ("n", "<u8"), ("null", "u1")])


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit lengths (0 for id 0); 61 stands for all above 60."""
    high = int(ids.max()) if ids.size else 0
    if high < len(_LENGTH):
        return _LENGTH[ids]
    out = np.zeros(ids.shape, np.int8)
    for w in range(min(61, high.bit_length())):
        out += ids >= np.uint64(1 << w)
    return out


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place the selector with most ids, all of which fit. Places behind the end fit everywhere."""
    selector = np.full(bits.shape, ESCAPE, np.uint8)
    widest, have = bits.copy(), 1  # the longest of the next ``have`` ids
    for s in range(len(WIDTHS) - 1, -1, -1):
        if (shift := COUNTS[s] - have) > 0:
            np.maximum(widest[:, :-shift], widest[:, shift:], out=widest[:, :-shift])
            have = COUNTS[s]
        selector[widest <= WIDTHS[s]] = s
    return selector


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block table, words, escapes) of unsigned 64-bit ``ids``; escapes stand block after block."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    row = BLOCK + COUNTS[0]  # a block and zeros behind it
    grid = np.zeros((blocks, row), "<u8")
    whole = n // BLOCK
    grid[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    grid[whole:, : n - whole * BLOCK] = ids[whole * BLOCK :]
    size = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    selector = _selectors(_bits(grid)).reshape(-1)
    step = _STEP[selector]
    taken = np.zeros(blocks * row, bool)
    here = np.arange(blocks) * row
    end = here + size
    while len(here):
        taken[here] = True
        here = here + step[here]
        live = here < end
        here, end = here[live], end[live]
    place = np.flatnonzero(taken)
    kinds, values = selector[place], grid.reshape(-1)
    words = kinds.astype("<u8") << np.uint64(60)
    for s in np.unique(kinds).tolist():
        if s == ESCAPE:
            continue
        rows = np.flatnonzero(kinds == s)
        at = place[rows]
        packed = values[at]
        for k in range(1, COUNTS[s]):
            packed |= values[at + k] << np.uint64(k * WIDTHS[s])
        words[rows] |= packed
    block = place // row
    escaped = kinds == ESCAPE
    per_block = np.bincount(block[escaped], minlength=blocks)
    if escaped.any():
        own = np.arange(escaped.sum()) - np.repeat(np.cumsum(per_block) - per_block, per_block)
        words[escaped] |= own.astype("<u8")
    table = np.stack([size, np.bincount(block, minlength=blocks), per_block], axis=1).astype("<u4")
    return table, words, values[place[escaped]]


def unpack(table: np.ndarray, words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of whole blocks."""
    size, n_words, n_escapes = (table[:, k].astype(np.int64) for k in range(3))
    block = np.repeat(np.arange(len(table)), n_words)
    kinds = (words >> np.uint64(60)).astype(np.int64)
    counts = _STEP[kinds]
    first = np.cumsum(counts) - counts
    first -= np.repeat(first[np.cumsum(n_words) - n_words], n_words)  # place inside the block
    left = size[block] - first
    start = (np.cumsum(size) - size)[block] + first
    out = np.zeros(int(size.sum()), "<u8")
    for s in np.unique(kinds):
        rows = np.flatnonzero(kinds == s)
        if s == ESCAPE:
            own = (words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)
            out[start[rows]] = escapes[(np.cumsum(n_escapes) - n_escapes)[block[rows]] + own]
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s]):
            some = rows[left[rows] > k]
            out[start[some] + k] = (words[some] >> np.uint64(k * WIDTHS[s])) & mask
    return out


class Writer:
    """One file; ids are coded and written a segment at a time."""

    def __init__(self, stream):
        self.stream, self.at, self.total = stream, 0, 0
        self.docs, self.places, self.held, self.n = [], [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, len(ids), doc_id is None))
        for k in range(0, len(ids), SEGMENT):
            self.held.append(ids[k : k + SEGMENT])
            self.n += len(self.held[-1])
            if self.n >= SEGMENT:
                self._segment()

    def _segment(self) -> None:
        ids = np.concatenate(self.held).astype("<u8") if self.n else np.empty(0, "<u8")
        whole = len(ids) - len(ids) % BLOCK or len(ids)
        ids, rest = ids[:whole], ids[whole:]
        if len(ids):
            table, words, escapes = pack(ids)
            self.places.append((self.at, self.total, len(table), 0))
            for part in (table, words, escapes):
                self._put(part.tobytes())
            self.total += len(ids)
        self.held, self.n = [rest], len(rest)

    def close(self) -> None:
        while self.n:
            self._segment()
        begin = self.at
        self._put(np.array(self.docs, _DOC).tobytes() + np.array(self.places, _PLACE).tobytes())
        self._put(np.array([begin, len(self.docs), len(self.places), self.total], "<u8").tobytes() + MAGIC)


class Reader:
    """One file, from a source with ``size``, ``seek`` and ``read``."""

    def __init__(self, source):
        self.source = source
        tail = 32 + len(MAGIC)
        end = source.size()
        trailer = self._get(end - tail, tail)
        begin, docs, places, self.total = (int(x) for x in np.frombuffer(trailer[:32], "<u8"))
        if trailer[32:] != MAGIC or self._get(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a whole file of token ids")
        index = self._get(begin, docs * _DOC.itemsize + places * _PLACE.itemsize)
        self.docs = np.frombuffer(index, _DOC, docs)
        self.places = np.frombuffer(index, _PLACE, places, offset=docs * _DOC.itemsize)

    def _get(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("the file of token ids is cut off")
        return data

    def segment(self, k: int, blocks: slice = slice(None)) -> np.ndarray:
        """Ids of segment ``k``; ``blocks`` picks neighbouring blocks, of which only the words are read."""
        place = self.places[k]
        at = int(place["at"])
        table = np.frombuffer(self._get(at, 12 * int(place["blocks"])), "<u4").reshape(-1, 3)
        at += table.nbytes
        words, escapes = (np.concatenate([[0], np.cumsum(table[:, c].astype(np.int64))]) for c in (1, 2))
        a, b, _ = blocks.indices(len(table))
        w = np.frombuffer(self._get(at + 8 * int(words[a]), 8 * int(words[b] - words[a])), "<u8")
        e = np.frombuffer(self._get(at + 8 * int(words[-1] + escapes[a]), 8 * int(escapes[b] - escapes[a])), "<u8")
        return unpack(table[a:b], w, e)

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """(id, place of its first id in the file, its ids in pieces), in file order."""
        parts, at, k = [], 0, 0
        held = 0
        for doc_id, n, null in self.docs:
            n = int(n)
            while held < n:
                parts.append(self.segment(k))
                held += len(parts[-1])
                k += 1
            own, need = [], n
            while need:
                own.append(parts[0][:need])
                need -= len(own[-1])
                parts[0] = parts[0][len(own[-1]) :]
                if not len(parts[0]):
                    parts.pop(0)
            held -= n
            yield (None if null else int(doc_id)), at, own
            at += n


# ------------------------------------------------------------------ ids by the tokenizers library


class LibraryCodec(PieceCodec):
    """Ids by the tokenizers library, each different piece of text once (see :mod:`concord.llm.pieces`).

    A piece of letters is one word, so it goes to the library's model at once,
    in the characters that stand for its bytes; any other piece goes through
    the library's whole chain. Byte-level BPE vocabularies only.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        _spec(vocabulary)  # refuses other kinds
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        letters = {b: c for c, b in byte_alphabet().items()}
        self.letters = [letters[b] for b in range(256)]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.start()

    def ids(self, text: str) -> bytes:
        if text.removeprefix(" ").isalpha():
            word = "".join(map(self.letters.__getitem__, text.encode()))
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_LIBRARY: dict[str, LibraryCodec] = {}
Encoder = Callable[[list[str | None]], list[bytes]]


def library(spark: SparkSession, vocabulary_path: str, end_id: int | None = 0) -> Callable[[], Encoder]:
    """For :func:`write`: the tokenizers library's ids, with ``end_id`` (None: nothing) behind each document."""
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def make() -> Encoder:
        if vocabulary.value not in _LIBRARY:
            _LIBRARY.clear()
            _LIBRARY[vocabulary.value] = LibraryCodec(vocabulary.value)
        encode = _LIBRARY[vocabulary.value].encode
        return lambda texts: [encode(t) + end for t in texts]

    return make


# ------------------------------------------------------------------ files


def write(ordered: DataFrame, encoder: Callable[[], Encoder] | None = None, id_col: str = "doc_id", value_col: str = "text") -> DataFrame:
    """Write ``ordered``, one file per partition; returns the manifest.

    ``value_col`` holds texts for ``encoder`` (see :func:`library`; null counts
    as empty) or, without one, binary ids as 32-bit little-endian numbers.
    ``ordered``: ascending ids over the partitions in order (see :func:`by_id`).
    The manifest ``(part, file, n_docs, n_ids, first_id)`` is a table in the
    shared folder: a task that is run again writes a file of another name, and
    only the files that the manifest names are read.
    """
    spark = ordered.sparkSession
    python_workers(spark)
    folder = new_folder(spark, "token-ids")
    narrow = ordered.select(F.col(id_col).cast("long").alias("id"), F.col(value_col).cast("string" if encoder else "binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, stream = TaskContext.get().partitionId(), None, None
        fs, base = open_folder(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.s8b"
        encode = encoder() if encoder else (lambda values: [v or b"" for v in values])
        for batch in batches:
            for some in _slices(batch, "value", 1 << 22):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = Writer(stream)
                for doc_id, ids in zip(some.column("id").to_pylist(), encode(some.column("value").to_pylist()), strict=True):
                    writer.add(doc_id, np.frombuffer(ids, "<u4"))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"], "n_docs": [len(writer.docs)], "n_ids": [writer.total]}
            )

    files = written(narrow.mapInArrow(run, "part int, file string, n_docs long, n_ids long"), "token-files")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long"))


def by_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in ascending id order over the partitions; equal ids by text."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartitionByRange(partitions, id_col).sortWithinPartitions(id_col, text_col)


def read(manifest: DataFrame) -> DataFrame:
    """``(id, start, n_tokens, ids binary)``: each document of the files, ``ids`` as 32-bit numbers.

    ``start``: ids of all documents before it, over all files.
    """
    python_workers(manifest.sparkSession)
    schema = "id long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
                fs, at = open_folder(file)
                with fs.open_input_file(at) as source:
                    rows, held = [], 0
                    for doc_id, begin, parts in Reader(source).documents():
                        ids = b"".join(p.astype("<u4").tobytes() for p in parts)
                        rows.append((doc_id, first + begin, len(ids) // 4, ids))
                        held += len(ids)
                        if held > 1 << 22:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    files = manifest.select("file", "first_id")
    return files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["id", "start", "n_tokens", "ids"])
