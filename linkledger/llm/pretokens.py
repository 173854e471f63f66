"""Cutting texts into pieces that a byte-level BPE library encodes independently, and encoding these.

A text's ids are those of its pieces one after another. Pieces are words of basic Latin letters
up to an ASCII character (no pre-token goes across such a place), other runs between white
space, and runs of white space. Pieces of the first kind skip the library's normaliser and
pre-tokeniser and go to its BPE model directly; all others take the whole way.
"""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space as the libraries' patterns have it (Python's \s also has 0x1C to 0x1F).
_SPACE = r"\t-\r \x85\xa0  -     　"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = rf"[{_LETTERS}]++(?=[\x00-\x7f]|\Z)"
#: Space before a word belongs to it; of a longer run the rest is a piece of its own.
WITH_SPACE = re.compile(rf" ?{_WORD}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
WITHOUT_SPACE = re.compile(rf"{_WORD}|[^{_SPACE}]+")
_PLAIN = re.compile(rf" ?[{_LETTERS}]+")
#: Pieces longer than this are encoded each time and not remembered.
LONGEST_KEPT = 48


def byte_letters() -> dict[int, str]:
    """How byte-level models write basic Latin letters and the space: printable bytes as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in [0x20, *range(0x41, 0x100)]}


class Encoder:
    """The ids of pieces by the library for one file."""

    def __init__(self, path: str, lower: bool):
        from tokenizers import Tokenizer

        self.library, self.lower, self.signs = Tokenizer.from_file(path), lower, byte_letters()
        self.model = self.library.model
        probe = ["the", "Ünïversité", "ing"] if lower else [" the", "Ünïversité", "ing"]
        self.direct = all(self._direct(p) == self._whole(p) for p in probe)

    def _whole(self, piece: str) -> list[int]:
        return self.library.encode(piece, add_special_tokens=False).ids

    def _direct(self, piece: str) -> list[int]:
        if self.lower:
            piece = piece.lower()
        if not piece.isascii() or piece[0] == " ":
            piece = piece.translate(self.signs)
        return [t.id for t in self.model.tokenize(piece)]

    def ids(self, piece: str) -> list[int]:
        return self._direct(piece) if self.direct and _PLAIN.fullmatch(piece) else self._whole(piece)


class Remembered(dict):
    """What ``make`` gives for pieces, kept in two generations of ``room`` entries: what isn't asked for goes, memory is bounded."""

    def __init__(self, make, room: int):
        super().__init__()
        self.make, self.room, self.old = make, room, {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
            if len(piece) > LONGEST_KEPT:
                return value
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value
