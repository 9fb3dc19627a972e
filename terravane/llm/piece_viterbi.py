"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

The automaton reads a text once. At each position its output links name every piece that ends there, and each of these relaxes
the best score of that position from the best score where the piece begins: the Viterbi path in a single pass.
Characters that no piece covers cost a penalty and become byte pieces. Where no piece can reach across a place (before a
word's space mark, around characters in no piece), the text is cut; each distinct stretch is searched once for a worker.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

# Fixed values of the model file's format: numbers of the fields and kinds of pieces.
PIECES, NORMALIZER = 1, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
NORMAL, UNKNOWN, BYTE = 1, 2, 6
CHARACTER_MAP, ADD_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def vocabulary() -> str:
    """Path of the sentence-piece model among the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a serialised message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Pieces, scores and the automaton of a model file with identity normalisation."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        pieces, rules = [], {ADD_PREFIX: 1, REMOVE_EXTRA: 1, ESCAPE: 1, CHARACTER_MAP: b""}
        for field, value in message(data):
            if field == PIECES:
                x = dict(message(value))
                pieces.append((x[PIECE_TEXT].decode(), struct.unpack("<f", x.get(PIECE_SCORE, b"\0\0\0\0"))[0], x.get(PIECE_KIND, NORMAL)))
            elif field == NORMALIZER:
                rules.update(message(value))
        if rules[CHARACTER_MAP] or rules[REMOVE_EXTRA] or not rules[ESCAPE]:
            raise ValueError("only models without a character map that keep and escape white space are read")
        self.prefix = bool(rules[ADD_PREFIX])
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.automaton, self.byte_id, self.unknown, self.text = ahocorasick.Automaton(), {}, 0, []
        longest = ""
        for i, (piece, score, kind) in enumerate(pieces):
            self.text.append(b"")
            if kind == BYTE:
                self.byte_id[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif kind == UNKNOWN:
                self.unknown = i
            elif kind == NORMAL:
                self.automaton.add_word(piece, (len(piece), score, i))
                self.text[i] = piece.replace(SPACE, " ").encode()
                longest += piece if SPACE in piece.lstrip(SPACE) else ""
        self.automaton.make_automaton()
        self.single = {p for p, _, kind in pieces if kind == NORMAL and len(p) == 1}
        self.penalty = min(s for _, s, kind in pieces if kind == NORMAL) - UNKNOWN_PENALTY
        self.stretch = self._stretches([p for p, _, kind in pieces if kind == NORMAL]) if not longest else re.compile(r"[\s\S]+")
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _stretches(pieces: list[str]) -> re.Pattern:
        """Stretches that no piece can leave.

        No piece holds a space mark after another character, so each begins a stretch; nor a letter or digit before one
        of ``ending``, so these end a stretch. White space in no piece stands alone.
        """
        held = {c for p in pieces for c in p}
        lone = "".join(re.escape(c) for c in "\n\t\r" if c not in held)
        joined = {b for p in pieces for a, b in zip(p, p[1:], strict=False) if a.isalnum()}
        ending = "".join(re.escape(c) for c in ".,;:!?%&$#*" if c not in joined)
        inner = f"[^{SPACE}{lone}]"
        kinds = [rf"{SPACE}*(?:{inner}*?[^\W_](?=[{ending}])|{inner}+)" if ending else f"{SPACE}*{inner}+", f"{SPACE}+"]
        return re.compile("|".join([*kinds, *([f"[{lone}]"] if lone else [])]))

    def segment(self, text: str) -> list[int]:
        """Ids of the best path over one stretch; of equal paths the one whose last pieces are longer."""
        n = len(text)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        done = 0
        for end, (size, score, i) in self.automaton.iter(text):
            if end > done:
                self._bridge(text, best, back, done, end)
                done = end
            at = end + 1 - size
            total = best[at] + score
            if total > best[end + 1] or total == best[end + 1] and at < back[end + 1][0]:
                best[end + 1], back[end + 1] = total, (at, i)
        self._bridge(text, best, back, done, n)
        out, at = [], n
        while at:
            at, i = back[at]
            out.append(i)
        return [j for i in reversed(out) for j in (self._bytes(i[1]) if isinstance(i, tuple) else (i,))]

    def _bridge(self, text: str, best: list, back: list, start: int, stop: int) -> None:
        """Goes on over characters from ``start`` that are no piece of their own; best scores up to ``stop`` are then final."""
        for i in range(start, stop):
            if text[i] not in self.single:
                total = best[i] + self.penalty
                if total > best[i + 1]:
                    best[i + 1], back[i + 1] = total, (i, (self.unknown, text[i]))

    def _bytes(self, character: str) -> list[int]:
        return [self.byte_id[b] for b in character.encode()] if self.byte_id else [self.unknown]

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian bytes."""
        if not text:
            return b""
        stretches = self.stretch.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        known = self.known
        out = list(map(known.get, stretches))
        if None in out:
            for k, x in enumerate(out):
                if x is None:
                    s = stretches[k]
                    x = known.get(s)
                    if x is None:
                        x = np.array(self.segment(s), self.dtype).tobytes()
                        if len(s) <= _shared.CACHE_WORD_BYTES:
                            known[s] = x
                    out[k] = x
        if len(known) * _shared.CACHE_ENTRY > _shared.CACHE_BYTES:
            known.clear()
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of ids; a leading space that encoding put there is taken away."""
        raw = b"".join(map(self.text.__getitem__, np.frombuffer(ids, self.dtype).tolist()))
        return raw[1:] if self.prefix and raw[:1] == b" " else raw


def _model(path: str) -> PieceModel:
    return _shared.per_worker(f"pieces:{path}", lambda: PieceModel(path))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                ids = [model.encode(x.decode("utf-8", "replace")) for x in docs]
                same = [model.decode(x) == t for x, t in zip(ids, docs, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, j - i), pa.array([len(x) // model.dtype.itemsize for x in ids], pa.int64()), pa.array([zlib.crc32(np.frombuffer(x, model.dtype).astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array(same), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids_crc32", "round_trip", "ids"]
                )

    return run


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32 of the ids as unsigned 32-bit numbers, round_trip, ids) for each whole text.

    ``ids`` are little-endian, of two bytes each for up to 65,536 pieces, else four. ``round_trip`` says whether
    decoding gives the text's bytes again, as it does for all texts without the space mark itself. Null is the empty
    text, which has no ids. Rows repeated or without doc_id are encoded as they come; other columns are ignored.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(_encode(model or vocabulary()), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, ids binary")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([None if x is None else model.decode(x).decode("utf-8", "replace") for x in batch["ids"].to_pylist()], pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(_decode(model or vocabulary()), "doc_id long, text string")
