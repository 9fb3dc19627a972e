"""Image and height codecs on bytes: PNG and GeoTIFF without an imaging library, and raw heights."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the formats: PNG's signature and colour types; TIFF's tags and value types.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
TIFF_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113


def write_png(pixels: np.ndarray) -> bytes:
    """8-bit pixels of 1, 3 or 4 channels."""
    pixels = np.ascontiguousarray(pixels, np.uint8)
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    kind = {v: k for k, v in PNG_CHANNELS.items()}[channels]
    rows = np.zeros((pixels.shape[0], 1 + pixels.shape[1] * channels), np.uint8)
    rows[:, 1:] = pixels.reshape(pixels.shape[0], -1)
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], 8, kind, 0, 0, 0)
    return PNG_SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """(height, width) or (height, width, channels) of 8-bit pixels; palettes and interlace are not read."""
    if data[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at < len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            body += part
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in PNG_CHANNELS or head[6]:
        raise ValueError("only 8-bit PNG files without palette or interlace are read")
    width, height, n = head[0], head[1], PNG_CHANNELS[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height, width * n), np.uint8)
    above = np.zeros(width * n, np.int32)
    for r in range(height):
        line, filtered = raw[r, 1:].astype(np.int32), int(raw[r, 0])
        if filtered == 1:
            line = np.cumsum(line.reshape(width, n), axis=0).reshape(-1) & 255
        elif filtered == 2:
            line = (line + above) & 255
        elif filtered > 2:
            for i in range(width * n):
                left, up, corner = (line[i - n], above[i], above[i - n]) if i >= n else (0, above[i], 0)
                if filtered == 3:
                    line[i] = (line[i] + (left + up) // 2) & 255
                else:
                    guess = left + up - corner
                    near = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))
                    line[i] = (line[i] + near[2]) & 255
        out[r] = above = line
    return out.reshape(height, width) if n == 1 else out.reshape(height, width, n)


def occupancy(data: bytes | None, width: int, height: int) -> np.ndarray:
    """Whether any colour channel of an image is set; a missing image is empty, another size is met by nearest pixels."""
    if data is None:
        return np.zeros((height, width), bool)
    image = read_png(data)
    mask = image > 0 if image.ndim == 2 else (image[..., :3] > 0).any(axis=2)
    rows, cols = (np.minimum((np.arange(n) * m) // n, m - 1) for n, m in ((height, mask.shape[0]), (width, mask.shape[1])))
    return mask[rows][:, cols]


def write_tiff(bands: np.ndarray, transform: tuple[float, float, float, float] | None = None, epsg: int | None = None, nodata: float | None = None) -> bytes:
    """(bands, height, width) as one deflated strip a band; ``transform`` is west, north, and the sizes of a pixel."""
    bands = np.ascontiguousarray(bands)
    count, height, width = bands.shape
    strips = [zlib.compress(b.astype(bands.dtype.newbyteorder("<")).tobytes()) for b in bands]
    bits, fmt = bands.dtype.itemsize * 8, {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    offsets = (8 + np.cumsum([0, *map(len, strips)]))[:-1].tolist()
    tags = [(WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [bits] * count), (COMPRESSION, "H", [8]), (262, "H", [1]), (STRIP_OFFSETS, "I", offsets), (SAMPLES, "H", [count]), (ROWS_PER_STRIP, "I", [height]), (STRIP_BYTES, "I", list(map(len, strips))), (PLANAR, "H", [2]), (FORMAT, "H", [fmt] * count)]
    if transform:
        tags += [(PIXEL_SCALE, "d", [transform[2], transform[3], 0.0]), (TIE_POINT, "d", [0.0, 0.0, 0.0, transform[0], transform[1], 0.0])]
    if epsg:
        key = 2048 if epsg == 4326 else 3072
        tags.append((GEO_KEYS, "H", [1, 1, 0, 2, 1024, 0, 1, 2 if key == 2048 else 1, key, 0, 1, epsg]))
    if nodata is not None:
        tags.append((NODATA, "c", [bytes([b]) for b in f"{nodata:g}".encode() + b"\0"]))
    at = 8 + sum(map(len, strips))
    extra, entries, free = b"", b"", at + 2 + 12 * len(tags) + 4
    for tag, kind, values in tags:
        body = struct.pack(f"<{len(values)}{kind}", *values)
        place = body.ljust(4, b"\0") if len(body) <= 4 else struct.pack("<I", free + len(extra))
        extra += body if len(body) > 4 else b""
        entries += struct.pack("<HHI", tag, {v: k for k, v in TIFF_TYPES.items()}[kind], len(values)) + place
    return struct.pack("<2sHI", b"II", 42, at) + b"".join(strips) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + extra


class Tiff:
    """A strip-organised TIFF file, plain or deflated, with what its geographic tags say."""

    def __init__(self, data: bytes):
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None:
            raise ValueError("not a TIFF file")
        (at,) = struct.unpack_from(order + "I", data, 4)
        (n,) = struct.unpack_from(order + "H", data, at)
        self.tags: dict[int, tuple] = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            if kind in TIFF_TYPES:
                form = f"{order}{count}{TIFF_TYPES[kind]}"
                place = at + 10 + 12 * k
                if struct.calcsize(form) > 4:
                    (place,) = struct.unpack_from(order + "I", data, place)
                self.tags[tag] = struct.unpack_from(form, data, place)
        get = lambda tag, other=None: self.tags.get(tag, (other,))[0]
        self.width, self.height, self.bands = get(WIDTH), get(HEIGHT), get(SAMPLES, 1)
        kind = np.dtype(f"{order}{'uif'[get(FORMAT, 1) - 1]}{get(BITS, 8) // 8}")
        if get(COMPRESSION, 1) not in (1, 8, 32946) or get(PREDICTOR, 1) != 1:
            raise ValueError("only plain and deflated strips are read")
        strips = [data[a : a + b] for a, b in zip(self.tags[STRIP_OFFSETS], self.tags[STRIP_BYTES], strict=True)]
        raw = b"".join(s if get(COMPRESSION, 1) == 1 else zlib.decompress(s) for s in strips)
        flat = np.frombuffer(raw, kind)
        shape = (self.bands, self.height, self.width) if get(PLANAR, 1) == 2 else (self.height, self.width, self.bands)
        self.pixels = flat.reshape(shape) if get(PLANAR, 1) == 2 else np.moveaxis(flat.reshape(shape), 2, 0)
        self.nodata = float(b"".join(self.tags[NODATA]).rstrip(b"\0")) if NODATA in self.tags else None
        keys = self.tags.get(GEO_KEYS, ())
        self.epsg = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (2048, 3072)), None)

    def transform(self) -> tuple[float, float, float, float] | None:
        """West, north, and the sizes of a pixel, from tie point and scale."""
        if PIXEL_SCALE not in self.tags or TIE_POINT not in self.tags:
            return None
        tie, scale = self.tags[TIE_POINT], self.tags[PIXEL_SCALE]
        return tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1]

    def window(self, row: int, col: int, height: int, width: int, fill: float = 0) -> np.ndarray:
        """A window that may reach beyond the raster, where it holds ``fill``."""
        out = np.full((self.bands, height, width), fill, self.pixels.dtype)
        r0, c0, r1, c1 = max(row, 0), max(col, 0), min(row + height, self.height), min(col + width, self.width)
        if r1 > r0 and c1 > c0:
            out[:, r0 - row : r1 - row, c0 - col : c1 - col] = self.pixels[:, r0:r1, c0:c1]
        return out


def write_heights(heights: np.ndarray) -> bytes:
    """Unsigned 16-bit little-endian heights, the last row first."""
    return np.ascontiguousarray(np.flipud(heights)).astype("<u2").tobytes()


def read_heights(data: bytes, height: int, width: int) -> np.ndarray:
    """Heights from 0 to 1, the first row on top; a short buffer is filled up by 0."""
    size = height * width * 2
    flat = np.frombuffer(data[:size].ljust(size, b"\0"), "<u2")
    return np.flipud(flat.reshape(height, width)) / 65535.0


def read_hgt(data: bytes, side: int | None = None) -> np.ndarray:
    """Big-endian signed heights of a square degree, 1201 or 3601 a side by the length."""
    flat = np.frombuffer(data, ">i2")
    side = side or int(round(len(flat) ** 0.5))
    if side * side != len(flat):
        raise ValueError("the heights do not form a square")
    return flat.reshape(side, side).astype(np.float32)
