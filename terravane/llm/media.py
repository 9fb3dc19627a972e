"""Media columns: MPEG transport streams.

A payload is stored as an elementary stream of 8-bit samples: access units of ``UNIT`` bytes in PES packets with
presentation timestamps, in 188-byte transport packets with continuity counters. Each unit begins with a program clock
reference. Some units are marked as points of random access, and the program association and program map tables stand
before each of these, so that a decoder that joins there finds all it needs.

Reading trusts the bytes only: it finds the program map by the association table, the stream by the map, checks every
counter of tables and stream (a repeated packet is dropped, a marked discontinuity is no error), puts the PES packets
together again and notes timestamps, clock references and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

# Fixed values of the transport stream format (ISO/IEC 13818-1).
PACKET = 188
SYNC = 0x47
PAT_PID = 0
STUFFING = 0xFF
PRIVATE_STREAM_1 = 0xBD
PRIVATE_DATA = 0x06
CLOCK = 90_000
DISCONTINUITY, RANDOM, HAS_CLOCK = 0x80, 0x40, 0x10

#: A payload is padded by PAD to a positive multiple of ALIGN bytes.
ALIGN = 576
PAD = 255
#: Bytes of an access unit; every RANDOM_ACCESS-th unit is marked as a point of random access.
UNIT = 16 * ALIGN
RANDOM_ACCESS = 8
#: Samples a second, from which timestamps follow; with it a unit lasts 96 ms, as clock references may be 100 ms apart.
RATE = 96_000
#: Ticks by which a unit's timestamp is after its clock reference: the time a decoder has to collect it.
DELAY = 9_000
PMT_PID = 0x1000
STREAM_PID = 0x0100

_CRC_STEP = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i << 24
    for _ in range(8):
        _c = (_c << 1 ^ 0x04C11DB7 if _c & 0x80000000 else _c << 1) & 0xFFFFFFFF
    _CRC_STEP[_i] = _c


def section_crc(data: bytes) -> int:
    """The checksum that ends a table section; over a whole section, its checksum included, it is 0."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ int(_CRC_STEP[(c >> 24) ^ b])
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\0\0" + body
    return head + section_crc(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    packet = bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section
    return packet.ljust(PACKET, b"\xff")


_PAT = _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(2, 1, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0" + bytes([PRIVATE_DATA]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0")
_TABLES = np.frombuffer(_table_packet(PAT_PID, _PAT) + _table_packet(PMT_PID, _PMT), np.uint8).reshape(2, PACKET)
#: Bytes of a unit that its first packet holds, beside header, adaptation field and clock reference, and a further packet.
_FIRST, _FURTHER = 176, 184


def _stamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 14, pts >> 22 & 255, 1 | pts >> 14 & 254, pts >> 7 & 255, 1 | pts << 1 & 254])


def pad(text: bytes) -> bytes:
    return text + bytes([PAD]) * (max(1, -(-len(text) // ALIGN)) * ALIGN - len(text))


def _clock(ticks: int) -> bytes:
    """A clock reference: 33 bits at 90 kHz, six reserved ones, and nine bits of 27 MHz that are 0 here."""
    return ((ticks & (1 << 33) - 1) << 15 | 0x3F << 9).to_bytes(6, "big")


def write_stream(payload: bytes) -> bytes:
    """The transport stream of a payload."""
    starts = range(0, len(payload), UNIT)
    sizes = [min(UNIT, len(payload) - at) + 14 for at in starts]
    counts = [1 + -(-max(0, n - _FIRST) // _FURTHER) for n in sizes]
    packets = np.full((sum(counts) + 2 * -(-len(counts) // RANDOM_ACCESS), PACKET), STUFFING, np.uint8)
    row = sent = 0
    for k, (at, count) in enumerate(zip(starts, counts, strict=True)):
        joins, ticks = k % RANDOM_ACCESS == 0, at * CLOCK // RATE
        if joins:
            packets[row : row + 2] = _TABLES
            packets[row : row + 2, 3] = 0x10 | k // RANDOM_ACCESS & 15
            row += 2
        unit = payload[at : at + UNIT]
        pes = b"\0\0\1" + bytes([PRIVATE_STREAM_1]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(ticks + DELAY & (1 << 33) - 1) + unit
        data, first = np.frombuffer(pes, np.uint8), min(_FIRST, len(pes))
        block = packets[row : row + count]
        block[:, 0], block[:, 1], block[:, 2] = SYNC, STREAM_PID >> 8, STREAM_PID & 255
        block[:, 3] = 0x10 | sent + np.arange(count) & 15
        block[0, 1] |= 0x40
        block[0, 3] |= 0x20
        block[0, 4], block[0, 5] = 183 - first, HAS_CLOCK | (RANDOM if joins else 0)
        block[0, 6:12] = np.frombuffer(_clock(ticks), np.uint8)
        block[0, PACKET - first :] = data[:first]
        whole, left = divmod(len(pes) - first, _FURTHER)
        block[1 : 1 + whole, 4:] = data[first : first + _FURTHER * whole].reshape(whole, _FURTHER)
        if left:  # the last packet is filled up by an adaptation field
            block[-1, 3] |= 0x20
            block[-1, 4] = 183 - left
            if left < 183:
                block[-1, 5] = 0
            block[-1, PACKET - left :] = data[len(pes) - left :]
        row += count
        sent += count
    return packets.tobytes()


def _followed(packets: np.ndarray) -> tuple[np.ndarray, int]:
    """The packets of one PID without repeated ones, and how often the counter of those with a payload jumps unmarked."""
    filled = packets[:, 3] & 0x10 != 0
    marked = (packets[:, 3] & 0x20 != 0) & (packets[:, 4] > 0) & (packets[:, 5] & DISCONTINUITY != 0)
    with_payload = np.flatnonzero(filled)
    held = packets[with_payload]
    # A packet may be sent twice; of the bytes only the clock reference may differ.
    twice = (held[1:, :6] == held[:-1, :6]).all(axis=1) & (held[1:, 12:] == held[:-1, 12:]).all(axis=1)
    twice[1:] &= ~twice[:-1]
    keep = np.ones(len(packets), bool)
    keep[with_payload[1:][twice]] = False
    counters = held[np.append(True, ~twice), 3] & 15 if len(held) else held[:, 3]
    allowed = marked[with_payload][np.append(True, ~twice)] if len(held) else marked[:0]
    return packets[keep], int((((counters[1:] - counters[:-1]) & 15 != 1) & ~allowed[1:]).sum())


class Stream:
    """What reading a transport stream finds: the payload, and how it was carried."""

    def __init__(self, media: bytes):
        if not media or len(media) % PACKET:
            raise ValueError("a transport stream is made of whole packets")
        packets = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
        if (packets[:, 0] != SYNC).any():
            raise ValueError("a packet without sync byte")
        if ((packets[:, 3] & 0x20 != 0) & (packets[:, 4] > 183)).any():
            raise ValueError("an adaptation field beyond its packet")
        self.packets, self.damaged = len(packets), int((packets[:, 1] & 0x80 != 0).sum())
        pids = (packets[:, 1].astype(np.int32) & 31) << 8 | packets[:, 2]
        pat, errors = self._table(packets[pids == PAT_PID], 0)
        programs = [(int.from_bytes(pat[i : i + 2], "big"), int.from_bytes(pat[i + 2 : i + 4], "big") & 0x1FFF) for i in range(0, len(pat), 4)]
        self.programs, self.counter_errors = [p for p in programs if p[0]], errors
        if not self.programs:
            raise ValueError("no program")
        pmt, errors = self._table(packets[pids == self.programs[0][1]], 2)
        self.counter_errors += errors
        at = 4 + (int.from_bytes(pmt[2:4], "big") & 0xFFF)
        self.streams = []
        while at < len(pmt):
            self.streams.append((pmt[at], int.from_bytes(pmt[at + 1 : at + 3], "big") & 0x1FFF))
            at += 5 + (int.from_bytes(pmt[at + 3 : at + 5], "big") & 0xFFF)
        if not self.streams:
            raise ValueError("no stream")
        own, errors = _followed(packets[pids == self.streams[0][1]])
        self.counter_errors += errors
        self._collect(own)

    def _collect(self, own: np.ndarray) -> None:
        """Payload, units, timestamps and clock references of the stream's packets."""
        filled, adapted = own[:, 3] & 0x10 != 0, own[:, 3] & 0x20 != 0
        flags = np.where(adapted & (own[:, 4] > 0), own[:, 5], 0)
        start = np.where(adapted, 5 + own[:, 4].astype(np.int64), 4)
        begins = (own[:, 1] & 0x40 != 0) & filled
        mask = np.arange(PACKET) >= start[:, None]
        mask[~filled] = False
        data = own[mask].tobytes()
        length = np.where(filled, PACKET - start, 0)
        heads = (np.cumsum(length) - length)[begins].tolist()
        self.random_access = np.flatnonzero(flags[begins] & RANDOM).tolist()
        self.clock = [int.from_bytes(own[i, 6:12].tobytes(), "big") >> 15 for i in np.flatnonzero(flags & HAS_CLOCK).tolist()]
        self.timestamps, pieces = [], []
        for a, b in zip(heads, [*heads[1:], len(data)], strict=True):
            if data[a : a + 3] != b"\0\0\1":
                raise ValueError("a PES packet without its start code")
            size = int.from_bytes(data[a + 4 : a + 6], "big")
            if size and a + 6 + size != b:
                raise ValueError("a PES packet of another length than it says")
            if data[a + 7] & 0x80:
                s = data[a + 9 : a + 14]
                self.timestamps.append((s[0] & 14) << 29 | s[1] << 22 | (s[2] & 254) << 14 | s[3] << 7 | s[4] >> 1)
            pieces.append(data[a + 9 + data[a + 8] : b])
        self.units, self.payload = len(pieces), b"".join(pieces)

    @staticmethod
    def _table(packets: np.ndarray, table: int) -> tuple[bytes, int]:
        """The entries of a table, each of whose sections is in one packet, and its packets' counter errors. Sections that
        repeat must be sound; the last one holds."""
        if not len(packets):
            raise ValueError("a table is missing")
        packets, errors = _followed(packets)
        known: dict[bytes, bytes] = {}
        for packet in packets:
            raw = packet.tobytes()
            if raw[3] & 0x10 == 0:
                continue
            at = 5 + raw[4] if raw[3] & 0x20 else 4
            key = raw[at:]
            if key not in known:
                at += 1 + raw[at]
                size = int.from_bytes(raw[at + 1 : at + 3], "big") & 0xFFF
                if raw[at] != table or section_crc(raw[at : at + 3 + size]):
                    raise ValueError("a table with another number or checksum")
                known[key] = raw[at + 8 : at + 3 + size - 4]
            entries = known[key]
        if not known:
            raise ValueError("a table is missing")
        return entries, errors

    def feature(self) -> str:
        samples = np.bincount(np.frombuffer(self.payload, np.uint8), minlength=256)
        mean = int((samples * np.arange(256)).sum()) * 1000 // max(1, len(self.payload))
        last = self.timestamps[-1] if self.timestamps else 0
        return f"packets={self.packets};units={self.units};pts={self.timestamps[0] if self.timestamps else 0}-{last};pcr={len(self.clock)};rap={len(self.random_access)};cc_errors={self.counter_errors};mean={mean};symbols={int((samples > 0).sum())}"


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, random_access array<long>, timestamps array<long>, clock_references array<long>"


def _store(with_media: bool):
    names = [x.split()[0] for x in _FEATURES.split(", ")] + ["media"] * with_media

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                rows = []
                for text in docs:
                    media = write_stream(pad(text))
                    found = Stream(media)
                    got = found.payload
                    rows.append((len(text), len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-32:]), len(media), hashlib.sha256(media).hexdigest(), found.feature(), found.random_access, found.timestamps, found.clock, media))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), *columns[: 10 + with_media]], names)

    return run


def to_transport_streams(docs: DataFrame, *, with_media: bool = False) -> DataFrame:
    """Each text's UTF-8 bytes, padded by 255 to a positive multiple of 576, as a transport stream that is read back.

    Returns the payload's and the stream's sizes and digests, a feature line computed from what was read, the numbers
    of the units at which decoding may start, all presentation timestamps and clock references (at 90 kHz); the stream
    itself on demand as ``media``. Equal texts give equal values. Null text is the empty text: a payload of padding only. Rows repeated
    or without doc_id are treated like others, other columns ignored; an empty table gives no rows.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(_store(with_media), _FEATURES + ", media binary" * with_media)


_INDEX = "doc_id long, payload binary, counter_errors long, random_access array<long>, timestamps array<long>, clock_references array<long>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = batch["media"].to_pylist()
        for i, j in _shared.by_bytes([x or b"" for x in media]):
            found = [None if x is None else Stream(x) for x in media[i:j]]
            columns = [(f and f.payload, f and f.counter_errors, f and f.random_access, f and f.timestamps, f and f.clock) for f in found]
            kinds = (pa.binary(), pa.int64(), *[pa.list_(pa.int64())] * 3)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), *(pa.array(c, k) for c, k in zip(zip(*columns, strict=True), kinds, strict=True))], [x.split()[0] for x in _INDEX.split(", ")])


def read_transport_streams(table: DataFrame) -> DataFrame:
    """(doc_id, media) to the payload and its index; a null stream gives nulls, a broken one raises ValueError."""
    given = table.select(F.col("doc_id").cast("long").alias("doc_id"), "media")
    return given.mapInArrow(_read, _INDEX)
