"""Token ids by the word-level BPE vocabulary, as its library gives them, at several times its speed.

The vocabulary's normaliser and splitter never join anything across ASCII white space, so a text's ids are those of
its white-space-separated chunks one after another. Each distinct chunk is encoded once for a worker: chunks of
plain lower-case Latin words by a byte-pair engine loaded with the same merges, all others by the library itself.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from . import _shared

_PLAIN = re.compile(r"((?:[a-z]|[ß-öø-ÿ])+)([.,!?;:%&$#*]*)")


def vocabulary() -> str:
    """Path of the word-level BPE vocabulary among the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder:
    """Encodes whole texts to little-endian ids of ``dtype``."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix, symbol = model["end_of_word_suffix"], _byte_of_symbol()
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        ranks: dict[bytes, int] = {}
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        for piece, i in model["vocab"].items():
            if piece in special:
                continue
            last = piece.endswith(suffix)
            self.ends[i] = last
            ranks[bytes(symbol[c] for c in (piece[: -len(suffix)] if last else piece)) + b"\n" * last] = i
        self.special = [x.encode() for x in special]
        #: A newline stands for the end of a word: plain words hold none.
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        self.chunks: dict[bytes, bytes] = {}

    def _by_library(self, chunks: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        stems, tails, odd = [], [], []
        for chunk in new:
            word = chunk.decode("utf-8", "replace")
            m = _PLAIN.fullmatch(word.lower()) if len(chunk) <= _shared.CACHE_WORD_BYTES else None
            if m and word.isalnum() | bool(m[2]) and "K" not in word and "Å" not in word:
                stems.append((chunk, m[1]))
                tails.append(m[2])
            else:
                odd.append((chunk, word))
        if stems:
            ids = np.array(self.merges.encode_ordinary("\n".join(s for _, s in stems) + "\n"), self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            raw, width, start = ids.tobytes(), self.dtype.itemsize, 0
            marks = {t: b"" for t in set(tails)}
            known = [t for t in marks if t]
            marks.update(zip(known, self._by_library(known), strict=True) if known else ())
            for (chunk, _), tail, stop in zip(stems, tails, stops.tolist(), strict=True):
                self.chunks[chunk] = raw[start * width : stop * width] + marks[tail]
                start = stop
        if odd:
            self.chunks.update(zip([c for c, _ in odd], self._by_library([w for _, w in odd]), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes; equal to the library's, special tokens not added."""
        if len(self.chunks) * _shared.CACHE_ENTRY > _shared.CACHE_BYTES:
            self.chunks.clear()
        known, found, new = self.chunks, [], {}
        for text in texts:
            if any(s in text for s in self.special):
                found.append((None, self._by_library([text.decode("utf-8", "replace")])))
                continue
            words = text.lower().split()
            ids = list(map(known.get, words))
            if None in ids:
                gaps = [i for i, x in enumerate(ids) if x is None]
                new.update((words[i], None) for i in gaps)
                found.append(([(i, words[i]) for i in gaps], ids))
            else:
                found.append((None, ids))
        if new:
            self._learn(list(new))
        out = []
        for gaps, ids in found:
            for i, word in gaps or ():
                ids[i] = known[word]
            out.append(b"".join(ids))
        if any(len(c) > _shared.CACHE_WORD_BYTES for c in new):
            known.clear()
        return out


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for the vocabulary at ``path``."""
    return _shared.per_worker(f"words:{path}", lambda: WordEncoder(path))
