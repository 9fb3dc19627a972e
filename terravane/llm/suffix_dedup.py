"""Removal of byte strings that an earlier document holds, by per-shard suffix arrays.

Sorting the suffixes of all text would cost far more than the repeats in it are worth, so three steps precede it. Every
window of ``width`` bytes chooses an anchor: the gram in it with the least hash. Equal windows choose equal anchors,
so a window can only repeat if its anchor's gram occurs in two documents, and only such windows go on. They are
dealt out by anchor as contexts (the runs of windows that share an anchor), once for each shard of documents. A
reducing task first folds equal contexts. Of those that remain beside others of the same anchor it builds
suffix arrays, each of some whole anchors, or shard by shard of bounded size where an anchor has more: ranks of eight bytes refined by doubling (Larsson-Sadakane: only groups
that are not yet settled are sorted again), Kasai's common prefixes, and windows with a common prefix of ``width`` or more
form a group. Groups of different shards are merged by binary search among sorted windows. Back come, for each
context, the windows that a smaller doc_id starts as well; each shard of documents then takes its bytes out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

GRAM = 20
#: Bytes of text in a shard of documents, about; a single longer text makes a shard of its own.
SHARD_BYTES = 8 << 20
#: Bytes of contexts in one suffix array, and bytes from which the next anchors get an array of their own, as small ones
#: stay in a processor's cache.
ARRAY_BYTES = 4 << 20
BUNDLE_BYTES = 1 << 18
#: Grams with more than this share of all anchors are listed (so there are at most that many), and their windows are
#: dealt out one by one by their own hash rather than by anchor.
HOT_SHARE = 1 / 2000
#: Text bytes for a reducing task, and parts (of whole anchors) that a task takes.
TASK_BYTES = 64 << 20
PARTS_PER_TASK = 4
#: Windows that are worked on at once, and twice the bytes of text that are: few enough for a processor's cache.
_WINDOWS = 1 << 18
_PIECE = 1 << 17
_NONE = np.iinfo(np.int64).max


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(3).compress(data)


def _unpress(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays to bytes, by planes of equal significance, in which sorted or small numbers leave runs of zeros."""
    out = [np.array([len(arrays)], "<i8").tobytes()]
    for a in arrays:
        out.append(np.array([len(a), a.dtype.itemsize], "<i8").tobytes() + a.dtype.str.encode().ljust(8) + np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())
    return _press(b"".join(out))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = _unpress(data), 8, []
    for _ in range(int(np.frombuffer(raw, "<i8", 1)[0])):
        n, size = np.frombuffer(raw, "<i8", 2, at).tolist()
        kind = raw[at + 16 : at + 24].strip().decode()
        out.append(np.frombuffer(raw, np.uint8, n * size, at + 24).reshape(size, n).T.copy().reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += 24 + n * size
    return out


class _Numbers(dict):
    """Numbers of distinct strings, in the order in which they are first asked for."""

    def __missing__(self, string: bytes) -> int:
        n = self[string] = len(self)
        return n


# --- shards of documents ----------------------------------------------------------------------------------------------


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to shards: (shard, bytes, rows): Arrow's stream format, compressed."""
    _shared.forget()
    number = TaskContext.get().partitionId() << 32
    held, size = [], 0

    def out() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema) as w:
            for b in held:
                w.write_batch(b)
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([_press(sink.getvalue().to_pybytes())], pa.binary())], ["shard", "bytes", "rows"])

    for batch in batches:
        lengths = [len(x) for x in _shared.texts(batch["text"])]
        start = 0
        for i, n in enumerate(lengths):
            size += n
            if size >= SHARD_BYTES or i + 1 == len(lengths):
                held.append(batch.slice(start, i + 1 - start))
                start = i + 1
            if size >= SHARD_BYTES:
                yield out()
                held, size, number = [], 0, number + 1
    if held:
        yield out()


def _rows(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(_unpress(blob)).read_all()


# --- anchors ----------------------------------------------------------------------------------------------------------


def _sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    """Least of each n entries in a row, by doubling."""
    span = 1
    while span * 2 <= n:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[: len(a) - (n - span)], a[n - span :]) if n > span else a


def _gram_hashes(text: np.ndarray, n: int) -> np.ndarray:
    """A mixed 64-bit hash of each n bytes in a row, by doubling."""
    mult = np.uint64(0x9E3779B97F4A7C15)
    power, done, at, span = text.astype(np.uint64) + np.uint64(1), None, 0, 1
    base = mult
    while True:
        if n & span:
            # Put the next stretch of ``span`` bytes after those that are done.
            done = power if done is None else done[: len(power) - at] * base + power[at : at + len(done[: len(power) - at])]
            at += span
        if at == n:
            break
        power = power[:-span] * base + power[span:]
        base = np.uint64((int(base) ** 2 | 1) & 0xFFFFFFFFFFFFFFFF)
        span *= 2
    h = done
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(hash, text's index, first window, windows, anchor's offset) of each run of windows with the same anchor, in order.

    A run's context is the bytes from its first window's start to its last one's end; the anchor's gram stands at the
    offset in it. All windows of all texts are in exactly one run.
    """
    pieces: list[tuple[int, int, bytes]] = []
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text) - width + 1), _PIECE // 2):  # long texts go in overlapping pieces
            if len(text) - at >= width:
                pieces.append((d, at, text[at : at + _PIECE // 2 + width - 1]))
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for k, piece in enumerate(pieces):
        group.append(piece)
        size += len(piece[2])
        if size >= _PIECE // 2 or k + 1 == len(pieces):
            for whole, part in zip(out, _runs(group, width), strict=True):
                whole.append(part)
            group, size = [], 0
    kinds = (np.uint64, np.int64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(out, kinds, strict=True))


def _runs(group: list[tuple[int, int, bytes]], width: int) -> tuple[np.ndarray, ...]:
    joined = np.frombuffer(b"".join(t for *_, t in group), np.uint8)
    n = np.array([len(t) for *_, t in group])
    start = np.cumsum(n) - n
    h = _gram_hashes(joined, GRAM)
    place = np.uint64(21)  # below the hash's leading bits stands the position, so that the first of equal grams is least
    key = (h >> place << place) | np.arange(len(h), dtype=np.uint64)
    least = _sliding_min(key, width - GRAM + 1)
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    for e in (start + n)[:-1].tolist():  # windows that lie in no single piece
        new[max(0, e - width + 1) : e] = False
    new[start] = True
    first = np.flatnonzero(new)
    piece = np.searchsorted(start, first, "right") - 1
    count = np.minimum(np.append(first[1:], len(least)), (start + n - width + 1)[piece]) - first
    chosen = (least[first] & np.uint64((1 << 21) - 1)).astype(np.int64)
    doc = np.array([d for d, *_ in group])[piece]
    offset = np.array([a for _, a, _ in group])[piece]
    return h[chosen], doc, first - start[piece] + offset, count, chosen - first


def _ids(rows: pa.Table) -> np.ndarray:
    """doc_ids for comparison; null stands after all others."""
    return np.array([_NONE if x is None else x for x in rows["doc_id"].to_pylist()], np.int64)


class _Grams:
    """Distinct gram hashes of a shard, the runs of each, and whether two documents of the shard hold it."""

    def __init__(self, h: np.ndarray, owner: np.ndarray):
        self.order = np.argsort(h, kind="stable")
        s = h[self.order]
        self.start = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1]) if len(s) else np.zeros(0, np.int64)
        self.hash = s[self.start]
        self.count = np.diff(np.append(self.start, len(s)))
        o = owner[self.order]
        self.several = np.minimum.reduceat(o, self.start) != np.maximum.reduceat(o, self.start) if len(s) else np.zeros(0, bool)

    def of_runs(self, flag: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.order), bool)
        out[self.order] = np.repeat(flag, self.count)
        return out


def _parts(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(34)) % np.uint64(parts)).astype(np.int64)


def _dealt(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices) of the entries of each part, in their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(part[rows[0]]), rows


def _list_grams(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            for shard, blob in zip(batch["shard"].to_pylist(), batch["rows"], strict=True):
                rows = _rows(blob.as_py())
                h, doc, *_ = anchors(_shared.texts(rows["text"]), width)
                g = _Grams(h, _ids(rows)[doc])
                for part, at in _dealt(_parts(g.hash, parts)):
                    steps = np.diff(g.hash[at], prepend=np.uint64(0))
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard]), pa.array([_pack(steps, g.several[at].astype(np.uint8), g.count[at].astype("<u4"))], pa.binary())], ["part", "shard", "grams"])

    return run


def _shared_grams(hot_from: float):
    """Grams of whole parts to those that more than one document holds: (shard, grams) back to each shard that has
    them. Grams with over ``hot_from`` anchors are listed as well, shard being null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        hashes, owners, flags, counts, names = [], [], [], [], []
        for batch in batches:
            for shard, blob in zip(batch["shard"].to_pylist(), batch["grams"], strict=True):
                steps, several, count = _unpack(blob.as_py())
                hashes.append(np.cumsum(steps, dtype=np.uint64))
                flags.append(several)
                counts.append(count)
                owners.append(np.full(len(steps), len(names), np.int32))
                names.append(shard)
        if not names:
            return
        h, owner, flag, count = map(np.concatenate, (hashes, owners, flags, counts))
        order = np.argsort(h, kind="stable")
        h, owner, flag, count = h[order], owner[order], flag[order], count[order]
        start = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
        n = np.diff(np.append(start, len(h)))
        several = (n > 1) | (np.maximum.reduceat(flag, start) > 0)
        total = np.add.reduceat(count.astype(np.int64), start)
        often = np.flatnonzero(several & (total > hot_from))
        if len(often):
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([_pack(h[start[often]])], pa.binary())], ["shard", "grams"])
        keep = np.repeat(several, n)
        h, owner = h[keep], owner[keep]
        for k, at in _dealt(owner.astype(np.int64)):
            yield pa.RecordBatch.from_arrays([pa.array([names[k]]), pa.array([_pack(np.diff(h[at], prepend=np.uint64(0)))], pa.binary())], ["shard", "grams"])

    return run


# --- contexts ---------------------------------------------------------------------------------------------------------


class _Contexts:
    """Distinct contexts of a shard, in a fixed order that the answers refer to, and where each occurs."""

    def __init__(self, rows: pa.Table, answers: list[bytes], hot: np.ndarray, width: int):
        texts, ids = _shared.texts(rows["text"]), _ids(rows)
        h, doc, first, windows, offset = anchors(texts, width)
        known = np.unique(np.concatenate([np.cumsum(_unpack(b)[0], dtype=np.uint64) for b in answers])) if answers else np.zeros(0, np.uint64)
        near = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
        wanted = np.flatnonzero(known[near] == h) if len(known) else np.zeros(0, np.int64)
        alone = np.isin(h[wanted], hot)
        h, doc, first, windows, offset = (x[wanted] for x in (h, doc, first, windows, offset))
        if alone.any():  # windows of hot grams stand for themselves
            times = np.where(alone, windows, 1)
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            h, doc, first, windows, offset, alone = (np.repeat(x, times) for x in (h, doc, first, windows, offset, alone))
            first, windows, offset = np.where(alone, first + inner, first), np.where(alone, 1, windows), np.where(alone, offset - inner, offset)
        numbers = _Numbers()
        at = np.fromiter((numbers[texts[d][f:e]] for d, f, e in zip(doc.tolist(), first.tolist(), (first + windows + width - 1).tolist(), strict=True)), np.int64, len(h))
        self.strings = list(numbers)
        self.least = np.full(len(numbers), _NONE, np.int64)
        np.minimum.at(self.least, at, ids[doc])
        once = np.empty(len(numbers), np.int64)
        once[at[::-1]] = np.arange(len(at))[::-1]  # where each context is met first
        self.keys, self.windows, self.offset = h[once], windows[once], offset[once]
        for k in np.flatnonzero(alone[once]).tolist():
            self.keys[k] = int.from_bytes(hashlib.blake2b(self.strings[k], digest_size=8).digest(), "little")
        self.texts, self.ids, self.doc, self.first, self.at = texts, ids, doc, first, at


def _send_contexts(hot: np.ndarray, width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            for shard, blob, answers in zip(batch["shard"].to_pylist(), batch["rows"], batch["answers"], strict=True):
                c = _Contexts(_rows(blob.as_py()), answers.as_py() or [], hot, width)
                if not c.strings:
                    continue
                for part, at in _dealt(_parts(c.keys, parts)):
                    at = at[np.argsort(c.keys[at], kind="stable")]
                    text = b"".join([c.strings[i] for i in at.tolist()])
                    numbers = _pack(at.astype("<i8"), np.diff(c.keys[at], prepend=np.uint64(0)), c.windows[at].astype("<u4"), c.least[at], c.offset[at].astype("<u4"))
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard]), pa.array([numbers], pa.binary()), pa.array([_press(text)], pa.binary())], ["part", "shard", "numbers", "texts"])

    return run


# --- suffix arrays ----------------------------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first leading; zeros follow the text."""
    n = len(text)
    out = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for span in (1, 2, 4):
        out = out[:-span] << np.uint64(8 * span) | out[span:]
    return out[:n]


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of the text's suffixes, ordered by their first ``depth`` bytes at least; equal ones by place.

    Larsson-Sadakane: suffixes are first ranked by eight bytes, and then, as long as groups are left, those of groups
    are ranked by the rank of the suffix that starts as far on as has been compared, which doubles each time.
    """
    n = len(text)
    key = _words(text)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]  # a group's number is the place of its first member
    rank = np.empty(n, np.int64)
    rank[order] = group
    done = 8
    loose = np.flatnonzero(~(new & np.append(new[1:], True)))
    while done < depth and len(loose):
        members = order[loose]
        ahead = members + done
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        sub = np.argsort(rank[members] * (n + 1) + second, kind="stable")  # by rank, then by what comes ahead
        members, second = members[sub], second[sub]
        own = rank[members]
        order[loose] = members
        fresh = np.ones(len(loose), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (second[1:] != second[:-1])
        rank[members] = loose[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        settled = fresh & np.append(fresh[1:], True)
        loose = loose[~settled]
        done *= 2
    rank[order] = np.arange(n)
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """Kasai: bytes, ``most`` at most, that each suffix shares with the one before it in the array (0 for the first).

    The walk along the text, in which a suffix shares at least one byte less than the one before it, goes through all
    contexts (``starts``, ``lengths``) side by side, so that each step is one over arrays. It needs that the suffix after the
    one that was shared with comes first as well; of suffixes that are alike to the array's depth it may not, and then the
    count begins anew.
    """
    shared = np.zeros(len(text), np.int64)
    h, with_ = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    words = _words(np.concatenate([text, np.zeros(most + 8, np.uint8)]))
    bytes_ = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)  # numbers from which one more byte is not zero
    active = np.arange(len(starts))
    for step in range(int(lengths.max(initial=0))):
        active = active[lengths[active] > step]
        p = starts[active] + step
        r = rank[p]
        q = order[np.maximum(r - 1, 0)]
        after = np.minimum(with_[active] + 1, len(text) - 1)
        k = np.where((r > 0) & (rank[after] < r), np.maximum(h[active] - 1, 0), 0)
        left = np.minimum(len(text) - np.maximum(p, q), most)
        open_ = np.flatnonzero((r > 0) & (k < left))
        while len(open_):
            differ = words[p[open_] + k[open_]] ^ words[q[open_] + k[open_]]
            k[open_] += np.where(differ == 0, 8, 7 - np.searchsorted(bytes_, differ, "right"))
            open_ = open_[(differ == 0) & (k[open_] < left[open_])]
        k = np.minimum(k, left)
        shared[p] = k
        h[active], with_[active] = k, q
    return shared[order]


def _window_groups(strings: list[bytes], windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, window, group) of all windows of one array's contexts; equal windows have equal groups, in order."""
    text = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    starts = np.cumsum(lengths) - lengths
    order, rank = suffix_array(text, width)
    shared = common_prefixes(text, order, rank, starts, lengths, width)
    context = np.repeat(np.arange(len(strings)), windows)
    window = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = starts[context] + window
    group = np.cumsum(shared < width)
    return context, window, group[rank[place]]


def repeated_windows(strings: list[bytes], windows: np.ndarray, least: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of distinct contexts the least doc_id of any context that holds it, as (start of each, values)."""
    sizes = np.cumsum([len(s) for s in strings])
    cuts = np.unique(np.searchsorted(sizes, np.arange(ARRAY_BYTES, sizes[-1] + ARRAY_BYTES, ARRAY_BYTES)))
    bounds = np.unique(np.concatenate([[0], np.minimum(cuts + 1, len(strings))]))
    begin = np.cumsum(windows) - windows
    out = np.full(int(windows.sum()), _NONE, np.int64)
    arrays = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        context, window, group = _window_groups(strings[lo:hi], windows[lo:hi], width)
        seen = np.zeros(int(group.max(initial=-1)) + 1, bool)  # groups that have a window; others are suffixes between
        seen[group] = True
        number = (np.cumsum(seen) - 1)[group]
        low = np.full(int(seen.sum()), _NONE, np.int64)
        np.minimum.at(low, number, least[lo + context])
        text = None
        if len(bounds) > 2:
            first = np.empty(len(low), np.int64)
            first[number[::-1]] = np.arange(len(number))[::-1]
            text = np.array([strings[lo + context[i]][window[i] : window[i] + width] for i in first.tolist()], f"S{width}")
        arrays.append([begin[lo + context] + window, number, low, text])
    # Windows of an array come in the order of its suffixes: those of another are found among them by binary search.
    # numpy drops trailing zero bytes when it compares; windows that end so differ only in their number, all ``width`` long.
    for i, (_, _, low, text) in enumerate(arrays):
        for _, _, other_low, other in arrays[:i]:
            spot = np.minimum(np.searchsorted(other, text), len(other) - 1)
            hit = np.flatnonzero(other[spot] == text)
            both = np.minimum(low[hit], other_low[spot[hit]])
            low[hit] = both
            other_low[spot[hit]] = both
    # A window met in a later array has told the earlier ones; once more, so that arrays between learn it as well.
    for i, (_, _, low, text) in enumerate(arrays):
        for _, _, other_low, other in arrays[i + 1 :]:
            spot = np.minimum(np.searchsorted(other, text), len(other) - 1)
            hit = np.flatnonzero(other[spot] == text)
            low[hit] = np.minimum(low[hit], other_low[spot[hit]])
    for at, number, low, _ in arrays:
        out[at] = low[number]
    return begin, out


def _find_repeats(width: int):
    """Contexts of whole parts to (shard, answer): its contexts' windows that a smaller doc_id starts as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        parts: dict[int, list[tuple[int, bytes, bytes]]] = {}
        for batch in batches:
            for part, shard, numbers, texts in zip(*(batch[c].to_pylist() for c in ("part", "shard", "numbers", "texts")), strict=True):
                parts.setdefault(part, []).append((shard, numbers, texts))
        for blobs in parts.values():
            yield from _one_part(blobs, width)

    return run


def _with_neighbours(beside: np.ndarray, strings: list[bytes], keys: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Of contexts of the same anchor those that can have a window in common with another.

    A window holds ``width - GRAM`` bytes beside the gram, so at least half of them on one side: contexts that agree with
    no other in as many bytes on either side of the gram have no window in common with any.
    """
    half = (width - GRAM) // 2
    sides: tuple[dict, dict] = {}, {}
    found = np.zeros(len(beside), bool)
    for j, (i, at, key) in enumerate(zip(beside.tolist(), offsets[beside].tolist(), keys[beside].tolist(), strict=True)):
        text = strings[i]
        for side, part in zip(sides, (text[at - half : at] if at >= half else b"", text[at + GRAM : at + GRAM + half]), strict=True):
            if len(part) == half:
                other = side.setdefault((key, part), j)
                if other != j:
                    found[j] = found[other] = True
    return beside[found]


def _one_part(blobs: list[tuple[int, bytes, bytes]], width: int) -> Iterator[pa.RecordBatch]:
    known = _Numbers()
    entry_of, entry_shard, entry_at, entry_least, keys, windows, offsets = [], [], [], [], [], [], []
    for k, (_, numbers, texts) in enumerate(blobs):
        at, steps, count, least, offset = _unpack(numbers)
        text, before = _unpress(texts), len(known)
        stop = np.cumsum(count.astype(np.int64) + width - 1)
        of = np.fromiter((known[text[a:b]] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)), np.int64, len(at))
        new = of >= before  # a shard sends a context once, so these come in the order of their numbers
        keys.append(np.cumsum(steps, dtype=np.uint64)[new])
        windows.append(count[new].astype(np.int64))
        offsets.append(offset[new].astype(np.int64))
        entry_of.append(of)
        entry_shard.append(np.full(len(at), k))
        entry_at.append(at)
        entry_least.append(least)
    strings = list(known)
    known.clear()
    of, shard, at, least, keys, windows, offsets = map(np.concatenate, (entry_of, entry_shard, entry_at, entry_least, keys, windows, offsets))
    low = np.full(len(strings), _NONE, np.int64)
    np.minimum.at(low, of, least)
    # Contexts alone with their anchor need no array: what repeats in them does so in equal contexts.
    order = np.argsort(keys, kind="stable")
    start = np.concatenate([[0], np.flatnonzero(keys[order][1:] != keys[order][:-1]) + 1])
    size = np.diff(np.append(start, len(order)))
    beside = order[np.repeat(size > 1, size)]
    beside = _with_neighbours(beside, strings, keys, offsets, width)
    entry, start, length = _repeats(of, least, low, windows, *_by_anchors(beside, strings, keys, windows, low, width))
    for k, rows in _dealt(shard[entry].astype(np.int64)):
        yield pa.RecordBatch.from_arrays([pa.array([blobs[k][0]]), pa.array([_pack(at[entry[rows]].astype("<i8"), start[rows].astype("<u4"), length[rows].astype("<u4"))], pa.binary())], ["shard", "repeats"])


def _by_anchors(beside: np.ndarray, strings: list[bytes], keys: np.ndarray, windows: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each context's windows among the values, or -1, values): ``repeated_windows`` of the contexts ``beside``,
    which are in the order of their anchors. Windows of different anchors differ, so arrays of whole anchors need no merging."""
    begin, values, done = np.full(len(strings), -1, np.int64), [], 0
    if not len(beside):
        return begin, np.zeros(0, np.int64)
    sizes = np.cumsum(windows[beside] + width - 1)
    ends = np.append(np.flatnonzero(keys[beside][1:] != keys[beside][:-1]) + 1, len(beside))
    lo = 0
    while lo < len(beside):
        enough = np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BUNDLE_BYTES) + 1
        hi = int(ends[min(np.searchsorted(ends, enough), len(ends) - 1)])
        own = beside[lo:hi]
        first, value = repeated_windows([strings[i] for i in own.tolist()], windows[own], low[own], width)
        begin[own] = done + first
        values.append(value)
        done, lo = done + len(value), hi
    return begin, np.concatenate(values)


def _repeats(of: np.ndarray, least: np.ndarray, low: np.ndarray, windows: np.ndarray, begin: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, first window, windows) of the runs of windows that a smaller doc_id than the entry's own ``least`` starts too."""
    alone = np.flatnonzero((begin[of] < 0) & (low[of] < least))  # entries without an array repeat as a whole
    out = [(alone, np.zeros(len(alone), np.int64), windows[of[alone]])]
    some = np.flatnonzero(begin[of] >= 0)
    sizes = np.cumsum(windows[of[some]])
    for part in np.split(some, np.unique(np.searchsorted(sizes, np.arange(_WINDOWS, sizes[-1] if len(some) else 0, _WINDOWS)))):
        n = windows[of[part]]
        entry = np.repeat(part, n)
        window = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
        hit = np.flatnonzero(values[begin[of[entry]] + window] < least[entry])
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (entry[hit[1:]] != entry[hit[:-1]])
        first = np.flatnonzero(new)
        out.append((entry[hit[first]], window[hit[first]], np.diff(np.append(first, len(hit)))))
    entry, start, length = map(np.concatenate, zip(*out, strict=True))
    order = np.argsort(entry, kind="stable")
    return entry[order], start[order], length[order]


# --- removal ----------------------------------------------------------------------------------------------------------


def _remove(hot: np.ndarray, width: int, kept: tuple[str, ...], with_text: bool):
    names = [*kept, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            for blob, answers, repeats in zip(batch["rows"], batch["answers"], batch["repeats"], strict=True):
                rows = _rows(blob.as_py())
                c = _Contexts(rows, answers.as_py() or [], hot, width)
                told: dict[int, list[tuple[int, int]]] = {}
                for b in repeats.as_py() or []:
                    for k, s, n in zip(*(x.tolist() for x in _unpack(b)), strict=True):
                        told.setdefault(k, []).append((s, n))
                spans: dict[int, list[tuple[int, int]]] = {}
                ids, least = c.ids, c.least
                few = np.zeros(len(least), bool)
                few[list(told)] = True
                few = np.flatnonzero(few[c.at] | (ids[c.doc] > least[c.at])) if len(c.at) else np.zeros(0, np.int64)
                for d, f, k in zip(c.doc[few].tolist(), c.first[few].tolist(), c.at[few].tolist(), strict=True):
                    if ids[d] > least[k]:  # an earlier document of this shard has the whole context
                        spans.setdefault(d, []).append((f, f + int(c.windows[k]) + width - 1))
                    else:
                        for s, n in told.get(k, ()):
                            spans.setdefault(d, []).append((f + s, f + s + n + width - 1))
                n_removed, n_spans, digest, left = [], [], [], []
                for d, text in enumerate(c.texts):
                    removed = runs = at = 0
                    pieces = []
                    for a, b in sorted(spans.get(d, ())):
                        if a > at or not runs:
                            pieces.append(text[at:a])
                            runs += 1
                            removed += b - a
                            at = b
                        elif b > at:
                            removed += b - at
                            at = b
                    pieces.append(text[at:])
                    rest = b"".join(pieces)
                    n_removed.append(removed)
                    n_spans.append(runs)
                    digest.append(hashlib.sha256(rest).hexdigest())
                    if with_text:
                        left.append(rest)
                new = [pa.array([len(t) for t in c.texts], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()), *[pa.array(left, pa.binary())] * with_text]
                for out in pa.table([*(rows[x] for x in kept), *new], names=names).to_batches(max_chunksize=2000):
                    yield out

    return run


def remove_repeats(docs: DataFrame, *, width: int = 50, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """Takes out of every document each byte covered by ``width`` bytes that also start in a document with a smaller doc_id.

    Strings are judged on the input, and matches do not cross documents. Returns the columns ``keep`` and n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 and, on demand, the remaining bytes as ``kept``.

    Null text is the empty text; shorter texts than ``width`` stay whole. A row without doc_id comes after all that
    have one; rows of the same doc_id do not take from each other, so repeated rows fare alike. Other columns are
    ignored, an empty table gives no rows. A kept column that has the name of a result raises ValueError.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    if set(results) & set(keep):
        raise ValueError(f"kept columns must not be named {results}")
    given = docs.select(*dict.fromkeys(["doc_id", *keep, "text"])).withColumn("text", F.col("text").cast("string")).withColumn("doc_id", F.col("doc_id").cast("long"))
    kinds = dict(given.dtypes)
    shards = _shared.cut(given.mapInArrow(_shard, "shard long, bytes long, rows binary"))
    size = shards.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    parts = PARTS_PER_TASK * tasks
    hot_from = HOT_SHARE * size / (0.5 * (width - GRAM + 2))  # a window of so many grams has an anchor every half of it
    answers = _shared.cut(shards.select("shard", "rows").mapInArrow(_list_grams(width, parts), "part int, shard long, grams binary").repartition(tasks, "part").mapInArrow(_shared_grams(hot_from), "shard long, grams binary"))
    often = [_unpack(bytes(r[0]))[0] for r in answers.where("shard is null").select("grams").collect()]  # some thousand at most
    hot = np.concatenate(often) if often else np.zeros(0, np.uint64)
    by_shard = answers.where("shard is not null").groupBy("shard").agg(F.collect_list("grams").alias("answers"))
    asked = shards.select("shard", "rows").join(by_shard, "shard", "left")
    repeats = _shared.cut(asked.mapInArrow(_send_contexts(hot, width, parts), "part int, shard long, numbers binary, texts binary").repartition(tasks, "part").mapInArrow(_find_repeats(width), "shard long, repeats binary"))
    told = asked.join(repeats.groupBy("shard").agg(F.collect_list("repeats").alias("repeats")), "shard", "left")
    kept = [f"`{c}` {kinds[c]}" for c in keep]
    schema = ", ".join([*kept, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", *["kept binary"] * with_text])
    return told.select("rows", "answers", "repeats").mapInArrow(_remove(hot, width, keep, with_text), schema)
