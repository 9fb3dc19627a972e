"""Token counts of fields and sections by offset mapping.

A document is encoded once, as a whole, so that its counts are those a model would see. Tokens are mapped to character
spans and joined with the spans of sections; a token that lies across a boundary goes where an explicit rule says:

* ``majority``: to the section that has most of its characters, the earliest of equals;
* ``start``: to the section of its first character;
* ``split``: to all, in proportion to its characters in each.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

RULES = ("majority", "start", "split")


def vocabulary() -> str:
    """Path of the byte-level BPE ranks among the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class SpanEncoder:
    """A byte-level tokenizer with the character span of each token."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("spans", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def spans(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(first character, character after the last) of each token; a token that holds a part of a character spans it."""
        sizes = self.size[self.encoding.encode_ordinary(text.decode("utf-8", "replace"))]
        stop = np.cumsum(sizes)
        character = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80) - 1
        return character[stop - sizes], character[stop - 1] + 1


def attribute(first: np.ndarray, stop: np.ndarray, starts: np.ndarray, end: int, rule: str = "majority") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens across boundaries) for sections that begin at ``starts`` (ascending, the first at
    0) and end where the next begins, the last at ``end``. Empty sections get none."""
    a = np.searchsorted(starts, first, "right") - 1
    b = np.searchsorted(starts, stop - 1, "right") - 1
    across = np.flatnonzero(a != b)
    if rule == "start" or not len(across):
        return np.bincount(a, minlength=len(starts)).astype(np.float64), len(across)
    counts = np.bincount(a[a == b], minlength=len(starts)).astype(np.float64)
    edges = np.append(starts, end)
    for t in across.tolist():
        sections = np.arange(a[t], b[t] + 1)
        share = np.minimum(edges[sections + 1], stop[t]) - np.maximum(edges[sections], first[t])
        if rule == "split":
            counts[sections] += share / share.sum()
        else:
            counts[sections[share.argmax()]] += 1
    return counts, len(across)


def line_starts(text: bytes) -> np.ndarray:
    """Characters at which the lines of a text begin; a newline belongs to the line that it ends."""
    raw = np.frombuffer(text, np.uint8)
    after = np.flatnonzero(raw == 10) + 1
    starts = np.cumsum(raw & 0xC0 != 0x80)  # characters up to each byte
    after = after[after < len(raw)]
    return np.concatenate([[0], starts[after - 1]]).astype(np.int64)


def _encoder(path: str) -> SpanEncoder:
    return _shared.per_worker(f"spans:{path}", lambda: SpanEncoder(path))


def _count_lines(path: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                n, across, sections, counts = [], [], [], []
                for text in docs:
                    first, stop = encode.spans(text) if text else (np.zeros(0, np.int64),) * 2
                    starts = line_starts(text)
                    count, over = attribute(first, stop, starts, int(stop[-1]) if len(stop) else 0, rule)
                    n.append(len(first))
                    across.append(over)
                    sections.append(starts)
                    counts.append(count)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, j - i), pa.array(n, pa.int64()), pa.array([len(s) for s in sections], pa.int64()), pa.array(across, pa.int64()), pa.array(sections, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.float64()))],
                    ["doc_id", "n_tokens", "n_sections", "n_across", "section_starts", "section_tokens"],
                )

    return run


def count_by_line(docs: DataFrame, *, rule: str = "majority", tokenizer: str | None = None) -> DataFrame:
    """For each document its tokens and those of its lines: n_tokens, n_sections, n_across (tokens across boundaries),
    section_starts (characters) and section_tokens, which add up to n_tokens under every rule.

    Null text is the empty text: one empty line without tokens. Rows repeated or without doc_id are counted as they
    come, other columns ignored; an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(_count_lines(tokenizer or vocabulary(), rule), "doc_id long, n_tokens long, n_sections long, n_across long, section_starts array<long>, section_tokens array<double>")


def _count_fields(path: str, rule: str, fields: list[str], join: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            columns = [_shared.texts(batch[f"field{k}"]) for k in range(len(fields))]
            rows = []
            for values in zip(*columns, strict=True):
                pieces = [v + (join.encode() if k + 1 < len(values) else b"") for k, v in enumerate(values)]
                text = b"".join(pieces)
                sizes = np.array([len(p.decode("utf-8", "replace")) for p in pieces])
                first, stop = encode.spans(text) if text else (np.zeros(0, np.int64),) * 2
                # Empty fields share their start with the next one: only fields that have characters are joined.
                full = np.flatnonzero(sizes)
                counts = np.zeros(len(fields))
                if len(full):
                    counts[full] = attribute(first, stop, (np.cumsum(sizes) - sizes)[full], int(sizes.sum()), rule)[0]
                rows.append(counts)
            out = np.array(rows).reshape(batch.num_rows, len(fields))
            yield pa.RecordBatch.from_arrays([batch["key"], *(pa.array(out[:, k]) for k in range(len(fields)))], ["key", *(f"field{k}" for k in range(len(fields)))])

    return run


def count_by_field(table: DataFrame, key: str, fields: list[str], *, join: str = "\n", rule: str = "majority", tokenizer: str | None = None) -> DataFrame:
    """``key`` and, for each field, the tokens it has in the row's fields joined by ``join``; the joint belongs to the
    field before it. Null fields are empty ones. Rows that repeat, or without a key, are counted as they come; without
    fields only the key is given, and an empty table gives no rows. Other columns are ignored."""
    if key in [f"{f}_tokens" for f in fields]:
        raise ValueError("a field's count would have the key's name")
    given = table.select(F.col(key).alias("key"), *(F.col(f).cast("string").alias(f"field{k}") for k, f in enumerate(fields)))
    kind = dict(given.dtypes)["key"]
    out = given.mapInArrow(_count_fields(tokenizer or vocabulary(), rule, fields, join), ", ".join([f"key {kind}", *(f"field{k} double" for k in range(len(fields)))]))
    return out.select(F.col("key").alias(key), *(F.col(f"field{k}").alias(f"{f}_tokens") for k, f in enumerate(fields)))
