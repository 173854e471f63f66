"""SentencePiece encoding that keeps the source place of every piece, and decoding.

Before it is encoded a text is normalised: at each place the longest rule of the model's compiled character map
(a double array trie) that matches is applied, a character without a rule stays. Every byte of the result remembers
where in the source its rule began. Pieces follow one another in the normalised text, so the ends of a piece there give
its span of source bytes: [start of the rule of its first byte, start of that of the byte after it). Where one
source character becomes several pieces, such as bytes, the last has the character and the others are empty.

The library finds the pieces of whole texts; a worker holds one batch of them at a time. For a model without rules the
places are made by array operations, else rule by rule.

Defined cases: null text counts as empty, which has no pieces; texts of any length are encoded whole, one at a time;
repeated rows are encoded each; an empty table gives no rows; extra columns are not read. Models with user-defined
pieces or white space as a suffix are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the library writes a space inside pieces.
SPACE = "▁"
_SPANS = "ids array<int>, starts array<int>, stops array<int>"


class CharacterMap:
    """The compiled rules of a model: a trie of sources in 32-bit units, and the results, each up to a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.results = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest rule that matches at a place gives, and the bytes it takes."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._offset(units[0])
        for end in range(at, len(text)):
            node ^= text[end]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != text[end]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        return self.results[found[0] : self.results.index(b"\0", found[0])], found[1]


class Normaliser:
    """Text to normalised bytes and the source place of each, as a model's settings have it."""

    def __init__(self, spec):
        self.rules = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def steps(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Result, start and bytes taken of each rule that is applied."""
        at = 0
        while at < len(text):
            found = self.rules.longest(text, at)
            if found is None:
                lead = text[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = text[at : at + n], n
            yield found[0], at, found[1]
            at += found[1]

    def __call__(self, text: bytes) -> tuple[bytes, list[int]]:
        """The normalised text and the source place of each of its bytes and of its end."""
        space = SPACE.encode() if self.escape else b" "
        out, places = bytearray(), []
        spaced, begun = self.squeeze, False
        for result, at, _ in self.steps(text):
            if spaced:
                result = result.lstrip(b" ")
            if not begun and (result or not self.squeeze):
                begun = True
                if self.dummy:
                    out += space
                    places += [at] * len(space)
            if result:
                spaced = self.squeeze and result.endswith(b" ")
                result = result.replace(b" ", space)
                out += result
                places += [at] * len(result)
        end = len(text)
        while self.squeeze and out.endswith(space):
            end = places[-len(space)]
            del out[-len(space) :], places[-len(space) :]
        return bytes(out), [*places, end]

    def places(self, text: bytes) -> np.ndarray:
        """The source places alone, without a step for each character where the model has no rules."""
        if self.rules.units or self.squeeze or not text:
            return np.array(self(text)[1], dtype=np.int64)
        b = np.frombuffer(text, dtype=np.uint8)
        starts = np.maximum.accumulate(np.where(b & 0xC0 == 0x80, 0, np.arange(len(b))))
        wide = len(SPACE.encode()) if self.escape else 1
        places = np.repeat(starts, np.where(b == 0x20, wide, 1))
        return np.concatenate([np.zeros(wide * self.dummy, np.int64), places, [len(b)]])


class Pieces:
    """Encodes texts with one model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = model.SentencePiece
        if model.trainer_spec.treat_whitespace_as_suffix or any(p.type == kind.USER_DEFINED for p in model.pieces):
            raise ValueError(f"{path}: white space as a suffix or user-defined pieces")
        self.normalise = Normaliser(model.normalizer_spec)
        #: Normalised bytes of each piece; an unknown piece has those of its text.
        self.length = np.array([1 if p.type == kind.BYTE else len(p.piece.encode()) for p in model.pieces], dtype=np.int64)
        self.unknown = None if model.trainer_spec.byte_fallback else self.library.unk_id()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Of each text ids and source stops (bytes) of all pieces; each piece begins where the one before stops."""
        for text, ids in zip(texts, self.library.encode(texts, num_threads=1), strict=True):
            lengths = self.length[np.array(ids, dtype=np.int64)]
            if self.unknown in ids:
                lengths = np.array([n if i != self.unknown else len(p.encode()) for n, i, p in zip(
                    lengths.tolist(), ids, self.library.encode(text, out_type=str), strict=True)])
            ends, places = np.cumsum(lengths), self.normalise.places(text.encode())
            if len(ids) and ends[-1] != len(places) - 1:
                raise ValueError(f"the pieces have {ends[-1]} bytes, the normalised text {len(places) - 1}")
            yield ids, places[ends]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


_WORKER: dict[str, Pieces] = {}


def _pieces(path: str) -> Pieces:
    if path not in _WORKER:
        _WORKER.clear()
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


def _path(path: str | None) -> str:
    return path or public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and, of every piece, its id and its span of the text's UTF-8 bytes: ids, starts, stops."""
    path = _path(path)
    kind = pa.struct([(name, pa.list_(pa.int32())) for name in ("ids", "starts", "stops")])

    @F.arrow_udf(f"struct<{_SPANS.replace(' array', ': array')}>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(path)
        for texts in batches:
            found = pieces.encode([t or "" for t in texts.to_pylist()])
            yield pa.array([{"ids": i, "starts": [0, *s[:-1]] if i else [], "stops": s} for i, s in found], kind)

    return docs.select("doc_id", spans("text").alias("s")).select("doc_id", "s.*")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text that ``ids`` decode to."""
    path = _path(path)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(path)
        for batch in batches:
            yield pa.array([pieces.decode(ids.as_py() or []) for ids in batch], pa.string())

    return rows.select("doc_id", texts("ids").alias("text"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and covered_bytes, the source bytes in the pieces' spans.

    The same encoding and decoding as above, digested where it is made, so that no ids leave the worker.
    """
    path = _path(path)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"]
    kind = pa.struct([(n, pa.string() if "sha" in n else pa.int64()) for n in names])

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, covered_bytes: bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(path)
        for texts in batches:
            out = []
            for ids, stops in pieces.encode([t or "" for t in texts.to_pylist()]):
                joined = ",".join(map(str, ids)).encode()
                text = pieces.decode(ids).encode()
                out.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(text).hexdigest(), int(stops[-1]) if ids else 0))
            yield pa.array([dict(zip(names, o, strict=True)) for o in out], kind)

    return docs.select("doc_id", run("text").alias("s")).select("doc_id", "s.*")
