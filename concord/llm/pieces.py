"""Whole texts to ids piece by piece, with the ids of short pieces kept.

A byte-level vocabulary splits a text into words, each encoded by itself, and a
word begins before each space that stands between two other characters. So a
text may be cut there, each different piece be encoded once and its ids be
kept: the ids are the same, at a fraction of the time. White space runs, where
this does not hold, are never cut apart.
"""

from __future__ import annotations

import re

_JOINT = re.compile(r"\s (?!\S)").search
_APART = re.compile(r"(?<=\S) (?=\S)").split

_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Marks(dict):
    """Ids of runs of marks."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, run: str) -> bytes:
        ids = self.codec.ids(run)
        if len(run) <= self.codec.LONGEST:
            self[run] = ids
        return ids


class _Pieces(dict):
    """Ids of pieces of text as they stand after ``lead`` (a space or nothing); a missing piece is encoded when looked up.

    What is sure to be words of its own is looked up by itself: a run of marks
    behind a letter, and the lines of a piece that has single line ends
    between other characters. So ``word,`` is ``word`` and ``,``.
    """

    def __init__(self, codec: PieceCodec, lead: str, older: dict[str, bytes]):
        super().__init__()
        self.codec, self.lead, self.older = codec, lead, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._parts(piece)
        if len(piece) <= self.codec.LONGEST:
            self[piece] = ids
        return ids

    def _parts(self, piece: str) -> bytes:
        codec = self.codec
        if piece and not any(s in piece for s in codec.special):
            if "\n" in piece:
                head, *lines = parts = piece.split("\n")
                if all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
                    return self[head] + b"".join([codec.line_end + codec.bare[x] for x in lines])
            else:
                word = piece.rstrip(_MARKS)
                if word != piece and word[-1:].isalpha():
                    return self[word] + codec.marks[piece[len(word) :]]
        return codec.ids(self.lead + piece)


class PieceCodec:
    """``encode`` from ``ids``, which encodes a piece of text by itself. ``special``: strings that are never cut."""

    KEPT, LONGEST = 1 << 20, 48  # pieces kept (twice as many at most), characters of each
    special: list[str]

    def ids(self, text: str) -> bytes:
        """The ids of a piece as packed little-endian 32-bit numbers."""
        raise NotImplementedError

    def start(self) -> None:
        if any(" " in s for s in self.special):
            raise ValueError("a special token that holds a space could be cut")
        self.line_end = self.ids("\n")
        self.spaced, self.bare, self.marks = _Pieces(self, " ", {}), _Pieces(self, "", {}), _Marks(self)

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; none for a null or empty one."""
        if not text:
            return b""
        if len(self.spaced) + len(self.bare) >= self.KEPT:
            self.spaced.older, self.bare.older = {}, {}
            self.spaced, self.bare, self.marks = _Pieces(self, " ", self.spaced), _Pieces(self, "", self.bare), _Marks(self)
        first, *rest = _APART(text) if _JOINT(text) else text.split(" ")
        return (self.ids(first) if first else b"") + b"".join(map(self.spaced.__getitem__, rest))
