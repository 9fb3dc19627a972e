"""SimHash near-duplicates by anchor-point covering.

A fingerprint is a 64-bit majority vote over the XXH64 values of its text's word shingles. Anchors are the codewords of
a covering code on some of the 64 bits: a product of perfect codes, in which each word of a block lies within the
block's covering radius R of exactly one codeword, its home. If two fingerprints differ in t bits or fewer, then the
home of the one lies within R + t of the other in each block, over all blocks with t to spend together. So every
fingerprint goes once to its home anchor and as a replica to every anchor within covering radius plus threshold, and
is compared per anchor, homes against replicas. No linked pair is missed, whatever the bits.

Which texts share 0.8 of their five-word shingles, no distance of 64 bits can say, so ``similar`` goes on from there. Texts
whose fingerprints meet at an anchor are candidates, and their whole sets of shingles decide. That finds most links; the
others are found by the sets alone. If all sets are put in one order, here the rarest shingle first, two so similar have
one in common within the first fifth of each. What meets there and is not yet linked is decided by the sets, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared
from .components import component_labels, connected_components

_LANES = np.uint64(0x0101010101010101)
#: Fingerprints of one anchor that are compared at once, a side; larger anchors are compared by parts.
BLOCK = 2048
#: Homes of an anchor up to which a code is not made longer: replicas then cost more than the comparisons they save.
HOMES = 128
#: Entries that one reducing task takes, as planned from their number.
TASK_ROWS = 2_000_000
#: An anchor that is home to more fingerprints is dealt out by bands of bits, so that no task takes it whole. It has
#: a ``MOST_HOT``-th of all as well, so no more than so many anchors are listed.
HOT_HOMES = 20_000
MOST_HOT = 4096

# The two perfect binary codes in use, as length, covering radius and generator polynomial.
GOLAY = (23, 3, 0b101011100011)
HAMMING = (7, 1, 0b1011)


# --- fingerprints -----------------------------------------------------------------------------------------------------


def majorities(hashes: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """The bits set in over half of each run of ``votes`` hashes, eight bits counted at once in the bytes of a word."""
    starts, pieces = np.cumsum(votes) - votes, -(-votes // 255)  # a byte counts to 255
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    ones = np.empty((len(votes), 8, 8), np.int64)
    for b in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(b) & _LANES, cuts)
        ones[:, :, b] = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    over = 2 * ones.reshape(len(votes), 64) > votes[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]


def grams_of(text: bytes, shingle: int) -> list[bytes]:
    """The text's word shingles in order; all its words as one where there are no more than ``shingle``."""
    words = text.lower().split()  # of bytes: A-Z, and white space 09-0D and 20
    if len(words) <= shingle:
        return [b" ".join(words)] if words else []
    line, at, ends = b" ".join(words), 0, []
    for w in words:
        at += len(w)
        ends.append(at)
        at += 1
    starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
    return [line[a:b] for a, b in zip(starts, ends[shingle - 1 :], strict=True)]


def fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """A 64-bit fingerprint of each text; zero where there is no word."""
    hash_of = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    hashes, owners, votes = [], [], []

    def count() -> None:
        if not hashes:
            return
        out[owners] = majorities(np.array(hashes, np.uint64), np.array(votes))
        hashes.clear(), owners.clear(), votes.clear()

    for i, text in enumerate(texts):
        grams = grams_of(text, shingle)
        if not grams:
            continue
        hashes.extend([hash_of(g, 42) for g in grams])
        owners.append(i)
        votes.append(len(grams))
        if len(hashes) >= 100_000:
            count()
    count()
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                f = fingerprints(docs, shingle)
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(i, j - i) for c in batch.schema.names if c != "text"), pa.array(f.view(np.int64))], [*(c for c in batch.schema.names if c != "text"), "bits"])

    return run


def simhash(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint of each document's whole text as a signed 64-bit number."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(_fingerprint_batches(shingle), "doc_id long, bits long")


# --- anchors ----------------------------------------------------------------------------------------------------------


@cache
def _homes(code: tuple[int, int, int], threshold: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The home's number for every word of a block, and for each d up to the threshold the numbers of all further
    codewords within R + d: an array of numbers for each word, padded by -1."""
    n, radius, generator = code
    words = 1 << n
    check = n - generator.bit_length() + 1  # information bits
    codewords = np.zeros(1 << check, np.int64)
    for bit in range(check):
        codewords[1 << bit : 2 << bit] = codewords[: 1 << bit] ^ (generator << bit)
    flips = [np.array([m for m in _masks(n, d)], np.int64) for d in range(radius + threshold + 1)]
    home = np.full(words, -1, np.int32)
    numbers = np.arange(len(codewords), dtype=np.int32)
    for d in range(radius + 1):
        for m in flips[d]:
            home[codewords ^ m] = numbers
    return home, [np.concatenate(flips[: radius + 1 + d]) if d == 0 else flips[radius + d] for d in range(threshold + 1)]


def _masks(n: int, ones: int, first: int = 0) -> Iterator[int]:
    if ones == 0:
        yield 0
        return
    for b in range(first, n):
        for rest in _masks(n, ones - 1, b + 1):
            yield 1 << b | rest


class Anchors:
    """A product of perfect codes over the low bits of a fingerprint."""

    def __init__(self, codes: tuple[tuple[int, int, int], ...], threshold: int):
        self.codes, self.threshold = codes, threshold
        self.sizes = [1 << n - g.bit_length() + 1 for n, _, g in codes]

    @staticmethod
    def for_rows(rows: int, threshold: int) -> Anchors:
        """The shortest product that leaves an anchor some hundred homes, so that work per row stays the same."""
        codes = [GOLAY]
        for more in (HAMMING, HAMMING, GOLAY, HAMMING):
            size = np.prod([2.0 ** (n - g.bit_length() + 1) for n, _, g in codes])
            if rows / size < HOMES or sum(n for n, *_ in codes) + more[0] > 64:
                break
            codes.append(more)
        return Anchors(tuple(codes), threshold)

    def _number(self, parts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(np.broadcast(*parts).shape, np.int64) if len(parts) > 1 else np.zeros(parts[0].shape, np.int64)
        for part, size in zip(parts, self.sizes, strict=True):
            out = out * size + part
        return out

    def _blocks(self, bits: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for n, *_ in self.codes:
            out.append((bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64))
            at += n
        return out

    def home(self, bits: np.ndarray) -> np.ndarray:
        return self._number([_homes(c, 0)[0][b] for c, b in zip(self.codes, self._blocks(bits), strict=True)])

    def near(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor) for every anchor within covering radius plus threshold."""
        rings = []
        for code, block in zip(self.codes, self._blocks(bits), strict=True):
            rings.append([_ring(code, d)(block) for d in range(self.threshold + 1)])
        index, anchor = [], []
        for spent in product(range(self.threshold + 1), repeat=len(self.codes)):
            if sum(spent) > self.threshold:
                continue
            parts = [ring[d] for ring, d in zip(rings, spent, strict=True)]  # each: (index, number), sorted by index
            at, number = parts[0]
            for size, (i, k) in zip(self.sizes[1:], parts[1:], strict=True):
                count = np.bincount(i, minlength=len(bits))
                first = np.cumsum(count) - count
                times = count[at]
                pick = np.repeat(first[at], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                at, number = np.repeat(at, times), np.repeat(number, times) * size + k[pick]
            index.append(at)
            anchor.append(number)
        return np.concatenate(index), np.concatenate(anchor)


def _ring(code: tuple[int, int, int], d: int):
    """Maps words to the codewords whose least distance is R + d, or at most R for d = 0, as (index, number)."""
    n, radius, _ = code
    home, _ = _homes(code, 0)

    def of(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if d == 0:
            return np.arange(len(block)), home[block].astype(np.int64)
        # A codeword at distance R + d from a word is the home of some word d bits away from it.
        pairs = np.concatenate([np.arange(len(block)) * (len(home) + 1) + home[block ^ m] for m in _masks(n, d)])
        pairs = np.unique(pairs)
        i, k = pairs // (len(home) + 1), pairs % (len(home) + 1)
        far = _distance(code, block[i], k) == radius + d
        return i[far], k[far]

    return of


@cache
def _codewords(code: tuple[int, int, int]) -> np.ndarray:
    n, _, generator = code
    out = np.zeros(1 << n - generator.bit_length() + 1, np.int64)
    for bit in range(n - generator.bit_length() + 1):
        out[1 << bit : 2 << bit] = out[: 1 << bit] ^ (generator << bit)
    return out


def _distance(code: tuple[int, int, int], words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words ^ _codewords(code)[numbers])


# --- links ------------------------------------------------------------------------------------------------------------


def _deal(entry: np.ndarray, anchor: np.ndarray, hot: np.ndarray, threshold: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and their parts; those of hot anchors once for each band."""
    part = _part(anchor, parts)
    many = np.flatnonzero(np.isin(anchor, hot))
    if len(many):
        bands = [(entry["bits"][many] >> shift & mask) for shift, mask in _bands(threshold)]
        dealt = [_part(anchor[many] * 0x10001 + 1 + b + (key.view(np.int64) << 20), parts) for b, key in enumerate(bands)]
        rest = np.delete(np.arange(len(entry)), many)
        entry, part = np.concatenate([entry[rest], *[entry[many]] * len(bands)]), np.concatenate([part[rest], *dealt])
    return entry, part


def _blobs(entry: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    entry, part = entry[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    return pa.RecordBatch.from_arrays([pa.array(part[np.concatenate([[0], cuts])], pa.int32()), pa.array([x.tobytes() for x in np.split(entry, cuts)], pa.binary())], ["part", "entries"])


def _replicate(anchors: Anchors, hot: np.ndarray, parts: int):
    """Fingerprints to (part, entries) rows, an entry being an anchor and the fingerprint. Entries of hot anchors go to
    a part for each of threshold + 1 bands of bits: linked pairs share a band, and meet in that part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_bits = batch["bits"].to_numpy().view(np.uint64)
            for i in range(0, len(all_bits), 4096):
                bits = all_bits[i : i + 4096]
                at, anchor = anchors.near(bits)
                entry = np.empty(len(at), _ENTRY)
                entry["anchor"], entry["bits"] = anchor, bits[at]
                yield _blobs(*_deal(entry, anchor, hot, anchors.threshold, parts))

    return run


_ENTRY = np.dtype([("anchor", "<u8"), ("bits", "<u8")])


def _bands(threshold: int) -> list[tuple[np.uint64, np.uint64]]:
    """Shift and mask of threshold + 1 bands that make up the 64 bits."""
    width = 64 // (threshold + 1)
    return [(np.uint64(b * width), np.uint64((1 << (width if b < threshold else 64 - b * width)) - 1)) for b in range(threshold + 1)]


def _part(anchor: np.ndarray, parts: int) -> np.ndarray:
    return ((anchor.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _home_of(anchors: Anchors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(anchors.home(batch["bits"].to_numpy().view(np.uint64)))], ["anchor"])

    return run


def _links(anchors: Anchors, threshold: int):
    """Entries of whole anchors to links that connect what the anchors' comparisons connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        blobs = [x for batch in batches for x in batch["entries"].to_pylist()]
        if not blobs:
            return
        entry = np.frombuffer(b"".join(blobs), _ENTRY)
        del blobs
        entry = entry[np.argsort(entry["anchor"], kind="stable")]
        number, bits = entry["anchor"], np.ascontiguousarray(entry["bits"])
        at_home = anchors.home(bits) == number
        starts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(number)]])
        left, right = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            ours = np.sort(bits[s:e][at_home[s:e]])
            if len(ours) and e - s > 1:
                a, b = near_pairs(ours, bits[s:e], threshold)
                if len(a):
                    left.append(a)
                    right.append(b)
            if len(left) >= 1000 or left and e == len(number):
                a, b = _forest(np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                left, right = [], []
        if left:
            a, b = _forest(np.concatenate(left), np.concatenate(right))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``left`` and ``right`` that connect exactly what all pairs within the threshold connect.

    Small sides are compared whole. Larger ones are first split by threshold + 1 bands of bits, of which linked
    pairs share one. Of the pairs found, only a spanning forest is given: copies need no link to each other.
    """
    if len(left) * len(right) <= BLOCK * BLOCK:
        i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= threshold)
        return _forest(left[i], right[j])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for shift, mask in _bands(threshold):
        kl, kr = left >> shift & mask, right >> shift & mask
        ol, orr = np.argsort(kl, kind="stable"), np.argsort(kr, kind="stable")
        l, r, kl, kr = left[ol], right[orr], kl[ol], kr[orr]
        keys, first, count = np.unique(kl, return_index=True, return_counts=True)
        lo, hi = np.searchsorted(kr, keys, "left"), np.searchsorted(kr, keys, "right")
        for a, n, b, c in zip(first.tolist(), count.tolist(), lo.tolist(), hi.tolist(), strict=True):
            for x in range(a, a + n, BLOCK):
                for y in range(b, c, BLOCK):
                    i, j = np.nonzero(np.bitwise_count(l[x : min(x + BLOCK, a + n), None] ^ r[None, y : min(y + BLOCK, c)]) <= threshold)
                    if len(i):
                        found.append(_forest(l[x + i], r[y + j]))
        if found:
            found = [_forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))]
    return found[0] if found else (left[:0], left[:0])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, next larger node of its component), no more than nodes."""
    keep = a != b
    a, b = a[keep], b[keep]
    if not len(a):
        return a, b
    nodes, label = component_labels(a, b)
    order = np.lexsort((nodes, label))
    same = label[order][1:] == label[order][:-1]
    return nodes[order][:-1][same], nodes[order][1:][same]


def links_by_anchors(fingerprints: DataFrame, threshold: int) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (bits) exactly as all pairs within the threshold do."""
    rows = fingerprints.count()
    anchors = Anchors.for_rows(rows, threshold)
    homes = fingerprints.mapInArrow(_home_of(anchors), "anchor long").groupBy("anchor").count()
    hot = np.array([r["anchor"] for r in homes.where(F.col("count") > max(HOT_HOMES, rows // MOST_HOT)).collect()], np.int64)
    tasks = max(int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows * 64 // TASK_ROWS)
    entries = fingerprints.mapInArrow(_replicate(anchors, hot, 16 * tasks), "part int, entries binary")
    return entries.repartition(tasks, "part").mapInArrow(_links(anchors, threshold), "a long, b long")


def near_duplicates(docs: DataFrame, *, threshold: int = 2, shingle: int = 3) -> DataFrame:
    """A row for each document: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links
    of at most ``threshold`` differing bits reach.

    Null and empty texts have fingerprint zero and link like any other. A null doc_id keeps its row and takes part
    in links; it is never the smallest, and a component of null ids only has a null id. Repeated rows stay repeated.
    Other columns are ignored; an empty table gives no rows.
    """
    marked = _shared.cut(simhash(docs, shingle))
    classes = _shared.cut_few(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    placed = _components(classes, links_by_anchors(classes.select("bits"), threshold))
    return _shared.join_crowded(marked, placed, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(bits, component_id) of each class (bits, first_id)."""
    roots = connected_components(links.distinct())
    placed = _shared.cut_few(classes.join(roots, classes["bits"] == roots["node"], "left").select("bits", "first_id", F.coalesce("root", "bits").alias("root")))
    smallest = _shared.cut_few(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return _shared.cut_few(_shared.join_crowded(placed, smallest, "root").select("bits", "component_id"))


# --- similar texts ----------------------------------------------------------------------------------------------------

#: Texts are similar from this share of their shingles on, as a fraction: what both have of what either has.
ALIKE = (4, 5)
#: Sets that meet at a key up to which all of them are compared at once.
FEW = 8
#: Sets of one key that are compared in one task; more are compared by pairs of parts.
KEY_SETS = 20_000
#: Keys that one task takes, as planned from their number.
TASK_KEYS = 1_000_000
#: Rounds in which each set is compared with the nearest one it meets, before all that are still apart are compared.
NEAREST_ROUNDS = 2
#: Texts whose shingles are counted to tell frequent ones, and frequent shingles that are told at most. Neither changes
#: what is found: a frequent shingle that is taken for a rare one makes more candidates.
COUNTED_TEXTS = 4000
FREQUENT = 500_000

_KEYED = np.dtype([("key", "<u8"), ("bits", "<u8"), ("n", "<u4"), ("at", "<u2")])
_PARITIES = [f"p{i}" for i in range(8)]
_MARKED = ["doc_id long", "bits long", "fingerprint long", "n long", *(f"{c} long" for c in _PARITIES), "packed binary"]
_MET = "key long, bits long, n long, at long, beside long"


def _hashes(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The hash of each shingle of each text, repeats included."""
    hash_of = xxhash.xxh64_intdigest
    return [np.array([hash_of(g, 42) for g in grams_of(x, shingle)], np.uint64) for x in texts]


def _sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The hashes of each text's shingles, in order and once each."""
    return [np.unique(x) for x in _hashes(texts, shingle)]


def _parities(keys: np.ndarray) -> np.ndarray:
    """Eight words of the parities of the keys that fall on each bit: sets that differ in d keys differ in d bits at most."""
    bit, n = np.unique(keys >> np.uint64(55), return_counts=True)
    out = np.zeros(512, np.uint8)
    out[bit] = n & 1
    return np.packbits(out).view(np.int64)


def _unpacked(packed: list[bytes]) -> list[bytes]:
    return list(map(zstandard.ZstdDecompressor().decompress, packed))


def _key_counts(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                key, n = np.unique(np.concatenate(_sets(docs, shingle)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    return run


def _frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several of ``COUNTED_TEXTS`` texts have, chosen by a hash of the text, and how many have them."""
    mark = F.xxhash64("text")
    drawn = docs.where(F.pmod(mark, F.lit(1 << 30)) < int((1 << 30) * min(1.0, COUNTED_TEXTS / max(docs.count(), 1))))
    counts = drawn.withColumn("mark", mark).dropDuplicates(["mark"]).select("text").mapInArrow(_key_counts(shingle), "key long, n long")
    often = counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    known, count = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    order = np.argsort(known)
    return known[order], count[order]


def _first_fifth(keys: np.ndarray, known: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A set's first keys in the common order, so many that one so similar has one of them among its own first ones."""
    if len(known) and len(keys):
        row = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        keys = keys[np.argsort(np.where(known[row] == keys, count[row], 0), kind="stable")]
    return keys[: len(keys) - -(-ALIKE[0] * len(keys) // ALIKE[1]) + 1]


def _shingle_batches(shingle: int):
    """Texts go on packed: their sets would take more room, and are soon made again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        press = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                lists = _hashes(docs, shingle)
                sets, votes = [np.unique(x) for x in lists], np.array([len(x) for x in lists])
                prints = np.zeros(len(lists), np.uint64)
                if votes.any():
                    prints[votes > 0] = majorities(np.concatenate(lists), votes[votes > 0])
                del lists
                columns = [np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64), prints.view(np.int64), np.array([len(x) for x in sets], np.int64), *np.array([_parities(x) for x in sets]).T.copy()]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), *map(pa.array, columns), pa.array(map(press, docs), pa.binary())], [x.split()[0] for x in _MARKED])

    return run


def _first_keys(frequent, shingle: int, parts: int):
    """Each set's first keys, as blobs by the key's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        known, count = frequent.value
        for batch in batches:
            bits, packed = batch["bits"].to_numpy().view(np.uint64), batch["packed"].to_pylist()
            for i, j in _shared.by_bytes(packed, 1 << 18):
                sets = _sets(_unpacked(packed[i:j]), shingle)
                first = [_first_fifth(x, known, count) for x in sets]
                times = np.array([len(x) for x in first])
                entry = np.empty(times.sum(), _KEYED)
                if not len(entry):
                    continue
                entry["key"], entry["bits"], entry["n"] = np.concatenate(first), np.repeat(bits[i:j], times), np.repeat([len(x) for x in sets], times)
                entry["at"] = np.minimum(np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times), 65535)
                yield _blobs(entry, _part(entry["key"], parts))

    return run


def _can_be(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether sets of n and m keys can be similar if their first common keys have ``at`` and ``to`` keys before."""
    up, down = ALIKE
    return (down * np.minimum(n, m) >= up * np.maximum(n, m)) & ((up + down) * np.minimum(n - at, m - to) >= up * (n + m))


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that two sets or more have among their first ones, a row for each set; where more than ``FEW`` meet, with the
    next set there if it can be similar."""
    _shared.forget()
    blobs = [x for batch in batches for x in batch["entries"].to_pylist()]
    if not blobs:
        return
    entry = np.frombuffer(b"".join(blobs), _KEYED)
    del blobs
    entry = entry[np.lexsort((entry["bits"], entry["key"]))]
    same = entry["key"][1:] == entry["key"][:-1]
    met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    n, at = entry["n"].astype(np.int64), entry["at"].astype(np.int64)
    group = np.cumsum(np.append(True, ~same)) - 1
    chained = (np.bincount(group)[group] > FEW) & np.concatenate([same & _can_be(n[:-1], at[:-1], n[1:], at[1:]), [False]])
    beside = np.concatenate([entry["bits"][1:], entry["bits"][:1]]).view(np.int64)
    for i in range(0, len(entry), 100_000):
        k = np.flatnonzero(met[i : i + 100_000]) + i
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(entry[c][k]).view(np.int64)) for c in ("key", "bits")), pa.array(n[k]), pa.array(at[k]), pa.array(beside[k], mask=~chained[k])], ["key", "bits", "n", "at", "beside"])


def _candidates(best: bool):
    """Pairs (a, b) of sets that meet at a key, have different roots, and can be similar by their sizes and parities; or, for
    each set a that a key holds, the b there with the nearest parities, and how near these are (share). A crowded key comes
    as pairs (lo, hi) of parts: sets of both are compared with each other, or within the part if it is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        rows = [pa.Table.from_batches([b]) for b in batches]
        if not rows:
            return
        table = pa.concat_tables(rows)
        del rows
        key, lo, hi, chunk, bits, n, at, root = (table[c].to_numpy() for c in ("key", "lo", "hi", "chunk", "bits", "n", "at", "root"))
        parity = np.stack([table[c].to_numpy().view(np.uint64) for c in _PARITIES], axis=1)
        order = np.lexsort((bits, hi, lo, key))
        key, lo, hi, chunk, bits, n, at, root, parity = (x[order] for x in (key, lo, hi, chunk, bits, n, at, root, parity))
        new = np.flatnonzero((np.diff(key) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
        starts, (up, down) = np.concatenate([[0], new, [len(key)]]), ALIKE
        nearest, beside = np.full(len(key), np.inf), np.full(len(key), -1)
        left, right, held = [], [], 0

        def near_pairs_of(s: int, e: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for x in range(s, e, 256):
                for y in range(x, e, BLOCK):
                    u, v = np.arange(x, min(x + 256, e))[:, None], np.arange(y, min(y + BLOCK, e))[None, :]
                    i, j = np.nonzero((u < v) & (root[u] != root[v]) & ((chunk[u] != chunk[v]) | (lo[s] == hi[s])) & _can_be(n[u], at[u], n[v], at[v]))
                    i, j = x + i, y + j
                    apart = np.bitwise_count(parity[i] ^ parity[j]).sum(axis=1, dtype=np.int64)
                    near = (up + down) * apart <= (down - up) * (n[i] + n[j])
                    yield i[near], j[near], (apart[near] / (n[i] + n[j])[near])

        def distinct() -> pa.RecordBatch:
            a, b = bits[np.concatenate(left)], bits[np.concatenate(right)]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if (root[s:e] == root[s]).all():
                continue
            for i, j, share in near_pairs_of(s, e):
                if best:
                    for one, two in ((i, j), (j, i)):
                        closer = np.flatnonzero(share < nearest[one])
                        closer = closer[np.argsort(-share[closer], kind="stable")]  # of several the least is written last
                        nearest[one[closer]], beside[one[closer]] = share[closer], two[closer]
                else:
                    left.append(i)
                    right.append(j)
                    held += len(i)
            if held >= 500_000:
                yield distinct()
                left, right, held = [], [], 0
        if held:
            yield distinct()
        if best:
            found = np.flatnonzero(beside >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(bits[found]), pa.array(bits[beside[found]]), pa.array(nearest[found])], ["a", "b", "share"])

    return run


def _decide(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        up, down = ALIKE
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part, similar, held = batch.slice(i, 500), [], {}
                for a, b, one, two in zip(*(part[c].to_pylist() for c in ("a", "b", "one", "two")), strict=True):
                    for bits, packed in ((a, one), (b, two)):
                        if bits not in held:
                            held[bits] = _sets(_unpacked([packed]), shingle)[0]
                    x, y = held[a], held[b]
                    similar.append((up + down) * len(np.intersect1d(x, y, assume_unique=True)) >= up * (len(x) + len(y)))
                yield part.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return run


def _similar_pairs(texts: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are similar. Each text is sent once for each of its pairs, so ``pairs``
    are few and on disk: links that a spanning forest needs, or candidates that little else rules out."""
    if pairs.isEmpty():
        return pairs
    asked = pairs.select(F.col("a").alias("bits")).union(pairs.select(F.col("b").alias("bits"))).distinct()
    held = _shared.cut(texts.select("bits", "packed").join(asked, "bits", "left_semi"))
    one, two = held.select(F.col("bits").alias("a"), F.col("packed").alias("one")), held.select(F.col("bits").alias("b"), F.col("packed").alias("two"))
    return _shared.cut_few(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(_decide(shingle), "a long, b long"))


def _near_parities(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and parities let be similar, once each."""
    up, down = ALIKE
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, two = (classes.select(F.col("bits").alias(x), F.col("n").alias(f"{x}_n"), *(F.col(c).alias(f"{x}_{c}") for c in _PARITIES)) for x in ("a", "b"))
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in _PARITIES), F.lit(0))
    sizes = down * F.least("a_n", "b_n") >= up * F.greatest("a_n", "b_n")
    return pairs.join(one, "a").join(two, "b").where(sizes & ((up + down) * apart <= (down - up) * (F.col("a_n") + F.col("b_n")))).select("a", "b")


def _pairs_by_anchors(classes: DataFrame, threshold: int) -> DataFrame:
    """(a, b): sets whose fingerprints are equal or meet at an anchor, as a spanning forest. Of the sets of a fingerprint
    one stands for all."""
    first = _shared.cut_few(classes.groupBy("fingerprint").agg(F.min("bits").alias("bits")))
    links = links_by_anchors(first.select(F.col("fingerprint").alias("bits")), threshold).distinct()
    one, two = (first.select(F.col("fingerprint").alias(x), F.col("bits").alias(f"{x}_bits")) for x in ("a", "b"))
    met = links.join(one, "a").join(two, "b").select(F.col("a_bits").alias("a"), F.col("b_bits").alias("b"))
    equal = _shared.join_crowded(classes.select("fingerprint", F.col("bits").alias("b")), first, "fingerprint").where("bits != b").select(F.col("bits").alias("a"), "b")
    return met.union(equal)


def _rooted(rows: DataFrame, roots: DataFrame, key: str, root: str) -> DataFrame:
    """``rows`` with the root of ``key``, itself if it has no link."""
    of = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(of, rows[key] == of["_node"], "left").withColumn(root, F.coalesce("_root", key)).drop("_node", "_root")


def _remaining(met: DataFrame, roots: DataFrame, classes: DataFrame, tasks: int, best: bool) -> DataFrame:
    """(a, b): pairs of sets that meet at a key, are not linked yet and can be similar; or the nearest one of each set."""
    rooted = _shared.cut_few(_rooted(met.select("key", "bits", "n", "at"), roots, "bits", "root"))
    several = rooted.groupBy("key").agg(F.count("*").alias("sets"), F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.where("low != high").select("key", F.ceil(F.col("sets") / KEY_SETS).cast("int").alias("chunks"))
    open_ = rooted.join(several, "key").join(classes.select("bits", *_PARITIES), "bits").withColumn("chunk", F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int"))
    dealt = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
    grouped = dealt.drop("chunks", "other").repartition(tasks, "key", "lo", "hi")
    if not best:
        return grouped.mapInArrow(_candidates(False), "a long, b long").distinct()
    nearest = grouped.mapInArrow(_candidates(True), "a long, b long, share double").groupBy("a").agg(F.min(F.struct("share", "b")).alias("n"))
    return nearest.select(F.least("a", "n.b").alias("a"), F.greatest("a", "n.b").alias("b")).distinct()


def similar(docs: DataFrame, *, shingle: int = 5, threshold: int = 2) -> DataFrame:
    """(doc_id, component_id) for each document: what links between texts of similar sets of word shingles reach, as of
    ``ALIKE`` of the shingles that either has; component_id is the smallest doc_id there.

    Candidates come from anchors (fingerprints within ``threshold`` bits), then from keys in common; every link is decided
    by the whole sets, no pair is missed and none is linked below. Sets are of 64-bit hashes, and equal ones one. Where
    many sets meet at a key, neighbours and then the nearest of each set are decided first; only those are compared each with
    each that are not linked yet. Nulls, empty texts and repeats fare as in ``near_duplicates``.
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = _shared.share(spark, _frequent(given.select("text"), shingle))
    marked = _shared.cut(given.mapInArrow(_shingle_batches(shingle), ", ".join(_MARKED)))
    same = [F.first(c).alias(c) for c in ("n", *_PARITIES, "packed")]  # one value for all equal sets, texts but for their spelling
    whole = _shared.cut(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.min("fingerprint").alias("fingerprint"), *same))
    classes = _shared.cut_few(whole.drop("packed"))
    seen = _shared.cut_few(_near_parities(_pairs_by_anchors(classes, threshold), classes))
    links = _similar_pairs(whole, seen, shingle)
    size = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 5 // TASK_KEYS)  # a fifth of the keys
    entries = whole.select("bits", "packed").mapInArrow(_first_keys(frequent, shingle, 4 * tasks), "part int, entries binary")
    met = _shared.cut(entries.repartition(tasks, "part").mapInArrow(_meetings, _MET))
    roots = connected_components(links)
    beside = _rooted(_rooted(met.where("beside is not null").select(F.col("bits").alias("a"), F.col("beside").alias("b")).distinct(), roots, "a", "ra"), roots, "b", "rb").where("ra != rb").select("a", "b")
    steps = [_near_parities(beside, classes), *[None] * (NEAREST_ROUNDS + 1)]
    for k, pairs in enumerate(steps):
        if pairs is None:
            pairs = _remaining(met, connected_components(links), classes, tasks, k <= NEAREST_ROUNDS)
        new = _shared.cut_few(pairs.join(seen, ["a", "b"], "left_anti"))
        links, seen = links.union(_similar_pairs(whole, new, shingle)), seen.union(new)
    return _shared.join_crowded(marked.select("doc_id", "bits"), _components(classes.select("bits", "first_id"), links), "bits").select("doc_id", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is the smallest of its group of similar documents. Rows without
    doc_id stay only where their group has no other; rows that repeat a doc_id share its fate."""
    groups = similar(docs, **options)
    lost = groups.where("not (doc_id <=> component_id)").select(F.col("doc_id").alias("lost_id")).distinct()
    return docs.join(lost, docs["doc_id"].eqNullSafe(lost["lost_id"]), "left_anti")
