"""Best-fit-decreasing packing of whole documents into id matrices.

Documents longer than a sequence are first split into full sequences and a rest, losslessly. The pieces of a group of
documents are then placed longest first, each into the fullest open sequence that still takes it; a segment tree
over remaining capacities finds that one in a number of steps that is the logarithm of the length.

Groups follow from the data, so any cluster gives the same sequences: documents are dealt to groups by a hash, so many
that a group has a bounded size, and go by doc_id in a group. Ids are shuffled once, text is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared, tokens

#: Bytes of text of a group, about: its documents are packed together. More would not fill sequences better to speak of.
GROUP_BYTES = 8 << 20
#: Tokens at which a group is packed in parts, should it be larger all the same.
GROUP_TOKENS = 8_000_000


class CapacityTree:
    """Open sequences by remaining capacity; ``take`` finds the least capacity that is not below a length."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.held = [0] * (2 * self.size)  # sequences in each subtree
        self.open: dict[int, list[int]] = {}

    def add(self, capacity: int, sequence: int) -> None:
        self.open.setdefault(capacity, []).append(sequence)
        self._count(capacity, 1)

    def _count(self, capacity: int, by: int) -> None:
        node, held = capacity + self.size, self.held
        while node:
            held[node] += by
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the fullest sequence with room, which is taken out; None if there is none."""
        node, held = length + self.size, self.held
        if not held[node]:
            while node > 1 and (node & 1 or not held[node + 1]):  # up, until a subtree to the right holds one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if held[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._count(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Pieces (none longer than ``width``) of each sequence, placed longest first, equal ones in their order."""
    tree, sequences = CapacityTree(width), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = width, len(sequences)
            sequences.append([])
        capacity, sequence = found
        sequences[sequence].append(i)
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], sequence)
    return sequences


_ENCODED = "doc_id long, mark long, grp long, ids binary"
_PACKED = "sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, doc_starts array<long>"


def _encode(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        end = b"" if end_id is None else np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                ids = [x + end for x in encode.encode(docs)]
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(i, j - i) for c in ("doc_id", "mark", "grp")), pa.array(ids, pa.binary())], ["doc_id", "mark", "grp", "ids"])

    return run


def _pack(kind: np.dtype, pad_id: int, width: int):
    """Rows of whole groups, sorted, to sequences."""
    names = [x.split()[0] for x in _PACKED.split(", ")]

    def packed(ids: list[np.ndarray], owners: list[int | None], first: int) -> pa.RecordBatch:
        pieces = [(d, s, min(width, len(x) - s)) for d, x in enumerate(ids) for s in range(0, len(x), width)]
        sequences = best_fit([n for *_, n in pieces], width)
        matrix, columns = np.full((len(sequences), width), pad_id, kind), [[] for _ in range(5)]
        for row, members in zip(matrix, sequences, strict=True):
            ends = [0]
            for p in members:
                d, s, n = pieces[p]
                row[ends[-1] : ends[-1] + n] = ids[d][s : s + n]
                ends.append(ends[-1] + n)
            for column, value in zip(columns, (ends[-1], ends, ends[:-1], [owners[pieces[p][0]] for p in members], [pieces[p][1] for p in members]), strict=True):
                column.append(value)
        n, ends, resets, docs, starts = columns
        return pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + len(sequences)), pa.int64()), pa.array(n, pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary()), pa.array(ends, pa.list_(pa.int32())), pa.array(resets, pa.list_(pa.int32())), pa.array(docs, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int64()))], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        now, ids, owners, size, first = None, [], [], 0, 0
        for batch in batches:
            for group, owner, raw in zip(batch["grp"].to_pylist(), batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if ids and (group != now or size >= GROUP_TOKENS):
                    out = packed(ids, owners, first)
                    ids, owners, size, first = [], [], 0, first + out.num_rows
                    yield from (out.slice(k, 500) for k in range(0, out.num_rows, 500))
                if group != now:
                    now, first = group, group << 36
                ids.append(np.frombuffer(raw, kind))
                owners.append(owner)
                size += len(ids[-1])
        if ids:
            out = packed(ids, owners, first)
            yield from (out.slice(k, 500) for k in range(0, out.num_rows, 500))

    return run


def pack_best_fit(docs: DataFrame, *, width: int = 4096, end_id: int | None = 2, pad_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """A row for each sequence: its ids as a row of a little-endian matrix (two bytes an id for up to 65,536 ids, else
    four), padded by ``pad_id`` to ``width``; cumulative segment lengths from 0; the places where positions start again at 0;
    and each segment's document and where in that document's ids it starts.

    A document is its text's ids and then ``end_id``; every id is in exactly one segment. Null text is the empty
    text; without an end id it gives no segment. Rows repeated or without doc_id are packed as they come. Other
    columns are ignored; an empty table gives no rows. sequence_id is unique, not gapless. The same documents give the
    same sequences on any cluster.
    """
    path = tokenizer or tokens.vocabulary()
    kind = tokens.WordEncoder(path).dtype
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    groups, mark = max(1, -(-size // GROUP_BYTES)), F.xxhash64(text)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), text.alias("text"))
    dealt = given.select("doc_id", "mark", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(groups).cast("long")).alias("grp"), "text")
    encoded = dealt.mapInArrow(_encode(path, end_id), _ENCODED)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(groups, 20_000))
    return encoded.repartition(tasks, "grp").sortWithinPartitions("grp", "doc_id", "mark").mapInArrow(_pack(kind, pad_id, width), _PACKED)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Packed sequences as Parquet, uncompressed ids, for readers that map them into memory."""
    packed.write.mode("errorifexists").option("compression", "none").parquet(path)


def positions(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Position of each id in its segment; padding counts on from 0."""
    edges = np.append(np.array(cu_seqlens), width)
    return np.arange(width) - np.repeat(edges[:-1], np.diff(edges))
