"""BPE encoding and decoding by a tokenisation automaton.

``MergeAutomaton`` compiles the ranked merges of a byte-level vocabulary into a
deterministic automaton over tokens. It starts as one state per byte with an
arc for every byte; the gadget of merge ``u v -> w`` then

* adds state ``w``, a copy of state ``v`` as it is at that moment,
* adds an arc ``w``, a copy of the arcs ``u`` as they are at that moment,
* cuts the arc ``v`` that leaves state ``u``.

After all merges the automaton accepts exactly the token sequences that BPE
produces, each text by one path. Copies are kept as (copied from, at which
merge) instead of being written out: 50,000 states times 50,000 arcs would not
fit a task, the chains of copies are two to five steps long. Arcs that were
looked up are kept in a transition table.

Encoding follows the one path that spells a pre-split word, long arcs first.
Every prefix of a word has one path too, so a place that leads nowhere is left
only once: the time is linear in the word, and a word of a million letters is
no special case. Decoding emits the arc labels (the tokens' bytes).
"""

from __future__ import annotations

import gc
import hashlib
import json
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from concord.llm.pieces import PieceCodec
from concord.llm.store import python_workers

# Fixed value: the pre-splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Ranges of characters that the regex module takes for letters or
# numbers and the tokenizers library, whose Unicode is older, does not.
NEWER = [
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f),
    (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2),
    (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7),
    (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1),
    (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3),
    (0x16ff2, 0x16ff3), (0x16ff4, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20),
    (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168),
    (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff),
    (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4),
    (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479),
    (0x3d000, 0x3fc3f),
]

_NEVER = 1 << 60
_TABLE = 1 << 18  # transitions kept


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeAutomaton:
    """States and arcs are token ids; ``START`` is the state before the first token."""

    START = -1

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        """``labels``: bytes of each token; ``merges``: (left, right, result) by rank."""
        self.labels = labels
        self.copied_state: dict[int, int] = {}  # state w -> state v it was copied from
        self.copied_arc: dict[int, int] = {}  # arc w -> arc u it was copied from
        self.made_at: dict[int, int] = {}
        self.cut_at: dict[tuple[int, int], int] = {}  # (state, arc) -> merge that cut it
        self._table: dict[int, bool] = {}  # state and arc in one number -> whether the arc leaves the state
        for rank, (u, v, w) in enumerate(merges):
            self._gadget(rank, u, v, w)
        self._trie: dict[int, tuple[int, dict]] = {}  # byte -> (arc that ends here or -1, trie below)
        merged = {b for b in labels.values()}
        for token, label in labels.items():
            if len(label) == 1 or token in self.made_at:
                self._insert(token, label)
        self._whole = {b: t for t, b in labels.items() if len(b) == 1 or t in self.made_at}
        self._shorter = {t: self._prefix(b) for b, t in self._whole.items()}
        self._size = {t: len(b) for b, t in self._whole.items()}
        self._widest = max(map(len, self._whole))
        if sum(len(b) == 1 for b in merged) != 256 or len(merged) != len(labels):
            raise ValueError("the vocabulary must hold every byte, and no token twice")

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if not self._open(u, v):
            return  # u v cannot occur any more: the merge never applies
        if w in self.made_at:
            raise ValueError("two merges give one token; each state needs a merge of its own")
        self.copied_state[w], self.copied_arc[w], self.made_at[w] = v, u, rank
        self.cut_at[u, v] = rank

    def _open(self, state: int, arc: int) -> bool:
        """Whether ``arc`` leaves ``state``: no cut of theirs, nor one from before they were copied.

        A cut made by the very merge that copied the arc counts as well: of
        ``u u u`` the first two are merged, so ``u`` is not followed by ``uu``.
        """
        if state == self.START:
            return True
        q, q_until = state, _NEVER
        while True:
            a, a_until = arc, _NEVER
            while True:
                rank = self.cut_at.get((q, a))
                if rank is not None and rank < q_until and rank <= a_until:
                    return False
                if a not in self.made_at:
                    break
                a, a_until = self.copied_arc[a], self.made_at[a]
            if q not in self.made_at:
                return True
            q, q_until = self.copied_state[q], self.made_at[q]

    def step(self, state: int, arc: int) -> bool:
        """Table entry: whether ``arc`` leads on from ``state`` (to the state named like the arc)."""
        key = state << 32 | arc
        known = self._table.get(key)
        if known is None:
            if len(self._table) >= _TABLE:
                self._table.clear()
            known = self._table[key] = self._open(state, arc)
        return known

    def _prefix(self, label: bytes) -> int:
        """The arc with the longest label that ``label`` goes on from; -1 if none."""
        return next((self._whole[label[:k]] for k in range(len(label) - 1, 0, -1) if label[:k] in self._whole), -1)

    def _insert(self, token: int, label: bytes) -> None:
        after = self._trie
        for b in label[:-1]:
            after = after.setdefault(b, (-1, {}))[1]
        after[label[-1]] = (token, after.get(label[-1], (-1, {}))[1])

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-split word: the arcs of the path that spells it.

        Long arcs are tried first. A place from which no arc leads on is left
        for good (a prefix has one path, so its state is always the same), and
        the last arc gives way to the next shorter one.
        """
        whole = self._whole.get(word)
        if whole is not None:
            return [whole]
        n, size, shorter, root, known = len(word), self._size, self._shorter, self._trie, self._table.get
        path: list[int] = []
        left: set[int] = set()
        state, at, arc, seek = self.START, 0, -1, True
        while True:
            if seek:  # the longest arc whose label is here
                arc, after = -1, root
                for b in word[at:at + self._widest]:
                    if (node := after.get(b)) is None:
                        break
                    token, after = node
                    if token >= 0:
                        arc = token
            while arc >= 0:
                end = at + size[arc]
                if end not in left:
                    open_ = known(state << 32 | arc)
                    if open_ or open_ is None and self.step(state, arc):
                        break
                arc = shorter[arc]
            if arc >= 0:
                path.append(arc)
                if end == n:
                    return path
                state, at, seek = arc, end, True
            else:
                left.add(at)
                arc = path.pop()
                at -= size[arc]
                state = path[-1] if path else self.START
                arc, seek = shorter[arc], False


def _spec(vocabulary: str) -> tuple[dict, dict[str, int], dict[int, bytes]]:
    """The vocabulary file, its special strings, and the labels of its other tokens."""
    spec, back = json.loads(vocabulary), byte_alphabet()
    model = spec["model"]
    if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
    special = {x["content"]: x["id"] for x in spec.get("added_tokens") or ()}
    return spec, special, {i: bytes(back[c] for c in s) for s, i in model["vocab"].items() if s not in special}


class Decoder:
    """The arc labels by id; all that decoding needs."""

    def __init__(self, vocabulary: str):
        _, special, labels = _spec(vocabulary)
        self.labels = [b""] * (max([*labels, *special.values()]) + 1)
        for i, label in [*labels.items(), *((i, s.encode()) for s, i in special.items())]:
            self.labels[i] = label

    def decode(self, ids) -> str:
        """The text of ``ids``: their labels in turn; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class Codec(Decoder, PieceCodec):
    """Vocabulary file, pre-splitting, special strings and the automaton together."""

    KEPT = 1 << 18

    def __init__(self, vocabulary: str):
        import regex

        super().__init__(vocabulary)
        spec, special, labels = _spec(vocabulary)
        vocab = spec["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.automaton = MergeAutomaton(labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.special, self._id_of = [*special], special
        longest = sorted(special, key=len)[::-1]
        self._specials = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if special else None
        self._words = regex.compile(PATTERN).findall
        newer = "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER)
        self._newer = regex.compile(f"[{newer}]").search
        self._words_newer = regex.compile(
            "(?V1)" + PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
            .replace(r" ?\p{L}", rf" ?[\p{{L}}--[{newer}]]").replace(r" ?\p{N}", rf" ?[\p{{N}}--[{newer}]]")
        ).findall
        self.start()

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not self._newer(text):
            return self._words(text)
        return self._words_newer(text)

    def ids(self, text: str) -> bytes:
        """Ids of a piece of text, special strings included, as packed little-endian 32-bit numbers."""
        parts = self._specials.split(text) if self._specials is not None and any(s in text for s in self.special) else [text]
        out: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self._id_of[part])
            else:
                for word in self._split(part):
                    out += self.automaton.encode_word(word.encode())
        return struct.pack(f"<{len(out)}i", *out)


_MADE: dict[tuple[type, str], Decoder] = {}


def _once(kind: type, vocabulary: str):
    """The compiled vocabulary, once per Python worker."""
    key = kind, hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = kind(vocabulary)
        gc.freeze()  # the tables stay; without this each full collection walks them
    return _MADE[key]


def read_vocabulary(path: str) -> str:
    """The vocabulary file's text. It is read on the driver and broadcast: its size (about
    2 MB) depends on the vocabulary alone, and 64 MB is the limit."""
    with open(path, encoding="utf-8") as f:
        text = f.read(1 << 26)
        if f.read(1):
            raise ValueError("a vocabulary of over 64 MB is not broadcast")
    return text


def _rest(df: DataFrame, *out: str) -> DataFrame:
    """``df`` without the columns that an output column replaces (names match in any case)."""
    taken = {c.lower() for c in out}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def encode(
    df: DataFrame, vocabulary_path: str, text_col: str = "text", out_col: str = "ids", keep_text: bool = True, decoded_col: str | None = None
) -> DataFrame:
    """``df`` with ``out_col array<int>``: the ids of each whole text.

    A null or empty text has no ids (an empty array). Every other column is
    passed on; one that has the name of ``out_col`` is replaced. No shuffle:
    row count, order and partitions stay. With ``decoded_col`` the ids are
    decoded again in the same pass, into a column of that name; the result is
    that of :func:`decode`, without a second Python worker for each task.
    """
    spark = df.sparkSession
    python_workers(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    df = _rest(df, out_col, *([decoded_col] if decoded_col else []))
    passed = [f for f in df.schema.fields if keep_text or f.name != text_col]
    names = [f.name for f in passed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = _once(Codec, vocabulary.value)
        for batch in batches:
            for part in _slices(batch, text_col):
                packed = [book.encode(s) for s in part.column(text_col).to_pylist()]
                ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype("<i4")
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))
                made = [ids]
                if decoded_col:
                    made.append(pa.array([book.decode(array("i", p)) for p in packed], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + made, names + added)

    kinds = [T.StructField(out_col, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded_col, T.StringType())] if decoded_col else [])
    added = [f.name for f in kinds]
    return df.mapInArrow(run, T.StructType(passed + kinds))


def _slices(batch: pa.RecordBatch, col: str, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``size`` bytes of ``col``, at least one row each."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * size // max(size, batch.column(col).nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col string``: the text that the ids stand for, special ids included.

    Null ids give null, no ids the empty text; a null or unknown id inside the
    array adds nothing. Other columns as in :func:`encode`.
    """
    spark = df.sparkSession
    python_workers(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    df = _rest(df, out_col)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = _once(Decoder, vocabulary.value)
        size = len(book.labels)
        for batch in batches:
            for part in _slices(batch, ids_col):
                column = part.column(ids_col)
                at, values = column.offsets.to_numpy(), column.values
                whole = not values.null_count
                numbers = values.to_numpy(zero_copy_only=False)
                if not whole or (len(numbers) and (numbers.min() < 0 or numbers.max() >= size)):
                    texts = [None if ids is None else book.decode([i for i in ids if i is not None and 0 <= i < size]) for ids in column.to_pylist()]
                else:
                    nulls = column.is_null().to_numpy(zero_copy_only=False)
                    texts = [None if null else book.decode(numbers[a:b].tolist()) for a, b, null in zip(at[:-1], at[1:], nulls)]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(texts, pa.string())], names + [out_col])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())]))
