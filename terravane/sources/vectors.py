"""Vector files: GeoJSON, shapefile and GeoPackage to feature rows and back.

A feature row has ``file``, ``fid``, ``epsg`` (null if unknown), ``kind`` (Point, LineString, Polygon and their Multi forms),
``shape`` (MultiPolygon coordinates; null for others), ``lines`` (MultiLineString coordinates; a point is a line of one
point) and ``properties`` (map of texts). Features that cannot be read are skipped, files of another format raise ValueError.
"""

from __future__ import annotations

import json
import math
import mmap
import re
import sqlite3
import struct
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import batched, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.kernels import signed_area
from ..operators._lineage import settle
from ..operators.shapes import SHAPE, clean

FEATURE = f"file string, fid long, epsg int, kind string, shape {SHAPE}, lines array<array<array<double>>>, properties map<string, string>"
POLYGONAL, LINEAR = ("Polygon", "MultiPolygon"), ("LineString", "MultiLineString")
# Codes of shapefile geometries, of well-known binary, and of coordinate systems in .prj texts.
SHP_POINT, SHP_LINE, SHP_POLYGON = 1, 3, 5
WKB = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
SHAPEFILE_PARTS = (".shp", ".shx", ".dbf")
#: Files up to this many bytes are read whole; of larger ones, and of all that are written, stretches are held. Rows are the same.
WHOLE_BYTES = 16 << 20
#: Bytes of a stretch that a task writes, and of one that it is sent: Arrow's batches are of up to 10,000 rows.
STRETCH, SENT = 1 << 20, 1 << 12
#: Characters that a GeoJSON file may say before its features, if it is read by lines.
_HEAD = 1 << 16


def _parts(kind: str, coordinates) -> tuple[list | None, list | None]:
    """(shape, lines) of GeoJSON coordinates."""
    if kind in POLYGONAL:
        return ([coordinates] if kind == "Polygon" else coordinates), None
    if kind in LINEAR:
        return None, ([coordinates] if kind == "LineString" else coordinates)
    if kind in ("Point", "MultiPoint"):
        return None, [[p] for p in ([coordinates] if kind == "Point" else coordinates)]
    raise ValueError(kind)


def _flat(x):
    """Coordinates as pairs of floats."""
    return [float(x[0]), float(x[1])] if x and not isinstance(x[0], (list, tuple)) else [_flat(y) for y in x]


def _geojson_epsg(doc: dict) -> int | None:
    name = (doc.get("crs") or {}).get("properties", {}).get("name", "")
    code = re.search(r"(\d+)$", name)
    return 4326 if not name or name.endswith("CRS84") else int(code[1]) if code else None


def _geojson_feature(k: int, f: dict) -> tuple | None:
    try:
        g = f.get("geometry")
        shape, lines = _parts(g["type"], _flat(g["coordinates"])) if g else (None, None)
        return k, g and g["type"], shape, lines, {a: v if isinstance(v, str) else json.dumps(v) for a, v in (f.get("properties") or {}).items() if v is not None}
    except (KeyError, TypeError, ValueError, IndexError):
        return None  # as the tolerant reader does: a broken feature costs only itself


def geojson_features(text: str) -> tuple[int | None, list[tuple]]:
    doc = json.loads(text)
    made = (_geojson_feature(k, f) for k, f in enumerate(doc["features"] if doc.get("type") == "FeatureCollection" else [doc]))
    return _geojson_epsg(doc), [f for f in made if f]


def epsg_of(projection: str) -> int | None:
    """The code that a .prj text says, or that its name of a UTM zone on WGS84 stands for."""
    code = re.findall(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]', projection)
    if code:
        return int(code[-1])
    zone = re.search(r"UTM[ _]zone[ _](\d+)([NS])", projection, re.IGNORECASE)
    if zone:
        return (32600 if zone[2].upper() == "N" else 32700) + int(zone[1])
    return 3857 if "Pseudo" in projection or "Mercator_Auxiliary" in projection else 4326 if projection.startswith("GEOGCS") and "WGS" in projection else None


def projection_of(epsg: int) -> str:
    if 32601 <= epsg <= 32660 or 32701 <= epsg <= 32760:
        return f'PROJCS["WGS_1984_UTM_Zone_{epsg % 100}{"N" if epsg < 32700 else "S"}",GEOGCS["GCS_WGS_1984"],AUTHORITY["EPSG","{epsg}"]]'
    return f'GEOGCS["GCS_WGS_1984",AUTHORITY["EPSG","{epsg}"]]' if epsg == 4326 else f'PROJCS["EPSG_{epsg}",AUTHORITY["EPSG","{epsg}"]]'


def dbf_rows(data: bytes) -> list[dict[str, str]]:
    return list(_dbf_rows(data))


def _dbf_rows(data: bytes | mmap.mmap) -> Iterator[dict[str, str]]:
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("utf-8", "replace"), data[at + 16]))
        at += 32
    for k in range(n):
        row, p = {}, head + k * size + 1
        for name, width in fields:
            text = data[p : p + width].decode("utf-8", "replace").strip(" \0")
            if text:
                row[name] = text
            p += width
        yield row


def dbf_head(n: int, widths: dict[str, int]) -> bytes:
    """What stands before ``n`` rows of fields of these widths."""
    out = struct.pack("<4BIHH20x", 3, 100, 1, 1, n, 32 + 32 * len(widths) + 1, 1 + sum(widths.values()))
    return out + b"".join(name.encode()[:10].ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14) for name, w in widths.items()) + b"\r"


def dbf_body(rows: Iterable[dict[str, str]], widths: dict[str, int]) -> bytes:
    return b"".join(b" " + b"".join((r.get(n) or "").encode()[:w].ljust(w) for n, w in widths.items()) for r in rows)


def shp_shapes(data: bytes) -> list[tuple[str | None, list | None, list | None]]:
    """(kind, shape, lines) of each record. Shells are clockwise in the format; each hole goes to the shell before it."""
    return list(_shp_shapes(data))


def _shp_shapes(data: bytes | mmap.mmap) -> Iterator[tuple[str | None, list | None, list | None]]:
    if struct.unpack_from(">I", data)[0] != 9994:
        raise ValueError("not a shapefile")
    at = 100
    while at + 12 <= len(data):
        size = struct.unpack_from(">I", data, at + 4)[0] * 2
        kind = struct.unpack_from("<I", data, at + 8)[0] % 10
        body, at = at + 12, at + 8 + size
        if kind == SHP_POINT:
            yield "Point", None, [[list(struct.unpack_from("<2d", data, body))]]
        elif kind in (SHP_LINE, SHP_POLYGON):
            parts, points = struct.unpack_from("<2I", data, body + 32)
            starts = [*struct.unpack_from(f"<{parts}I", data, body + 40), points]
            xy = np.frombuffer(data, "<f8", 2 * points, body + 40 + 4 * parts).reshape(-1, 2)
            rings = [xy[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            if kind == SHP_LINE:
                yield "MultiLineString" if len(rings) > 1 else "LineString", None, [r.tolist() for r in rings]
                continue
            shape: list = []
            for r in rings:
                if signed_area(r[:-1]) <= 0 or not shape:
                    shape.append([r.tolist()])
                else:
                    shape[-1].append(r.tolist())
            yield "MultiPolygon" if len(shape) > 1 else "Polygon", shape, None
        else:
            yield None, None, None


def shp_record(shape: list | None, lines: list | None, polygonal: bool) -> tuple[bytes, list[float]]:
    """A record without its number and size, and its bounds (none if it is empty)."""
    rings = [np.array(r, float) for p in shape or () for r in p] if polygonal else [np.array(r, float) for r in lines or ()]
    if not rings:
        return struct.pack("<I", 0), []
    if polygonal:  # shells clockwise, holes the other way
        flags = [k == 0 for p in shape for k in range(len(p))]
        rings = [r if (signed_area(r[:-1]) <= 0) == shell else r[::-1] for r, shell in zip(rings, flags, strict=True)]
    xy = np.concatenate(rings)
    bounds = [*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist()]
    starts = np.cumsum([0, *(len(r) for r in rings[:-1])])
    return struct.pack("<I4d2I", SHP_POLYGON if polygonal else SHP_LINE, *bounds, len(rings), len(xy)) + starts.astype("<i4").tobytes() + xy.astype("<f8").tobytes(), bounds


def shp_head(size: int, polygonal: bool, bounds: list[float]) -> bytes:
    """The first 100 bytes of a .shp or .shx of ``size`` bytes, which are counted in pairs as signed numbers."""
    if size // 2 >= 1 << 31:
        raise ValueError("a shapefile holds 4 GB at most")
    return struct.pack(">I20xI", 9994, size // 2) + struct.pack("<2I8d", 1000, SHP_POLYGON if polygonal else SHP_LINE, *bounds, 0, 0, 0, 0)


def wkb_parts(data: bytes, at: int = 0) -> tuple[str, list, int]:
    """(kind, coordinates, end) of well-known binary."""
    order = "<" if data[at] else ">"
    kind = WKB[struct.unpack_from(order + "I", data, at + 1)[0] % 1000]
    at += 5
    if kind == "Point":
        return kind, list(struct.unpack_from(order + "2d", data, at)), at + 16
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if kind.startswith("Multi"):
        out = []
        for _ in range(n):
            _, part, at = wkb_parts(data, at)
            out.append(part)
        return kind, out, at
    rings = []
    for _ in range(n if kind == "Polygon" else 1):
        m = n
        if kind == "Polygon":
            (m,) = struct.unpack_from(order + "I", data, at)
            at += 4
        rings.append(np.frombuffer(data, order + "f8", 2 * m, at).reshape(-1, 2).tolist())
        at += 16 * m
    return kind, rings if kind == "Polygon" else rings[0], at


def write_wkb(kind: str, coordinates: list) -> bytes:
    code = next(k for k, v in WKB.items() if v == kind)
    head = struct.pack("<BI", 1, code)
    line = lambda r: struct.pack("<I", len(r)) + np.array(r, "<f8").tobytes()
    if kind == "Point":
        return head + struct.pack("<2d", *coordinates)
    if kind == "LineString":
        return head + line(coordinates)
    if kind == "Polygon":
        return head + struct.pack("<I", len(coordinates)) + b"".join(map(line, coordinates))
    return head + struct.pack("<I", len(coordinates)) + b"".join(write_wkb(kind.removeprefix("Multi"), c) for c in coordinates)


def gpkg_features(data: bytes) -> tuple[int | None, list[tuple]]:
    """Features of all feature tables of a GeoPackage, opened in memory."""
    con = sqlite3.connect(":memory:")
    con.deserialize(data)
    epsg, out = _gpkg_features(con)
    return epsg, list(out)


def _gpkg_features(con: sqlite3.Connection) -> tuple[int | None, Iterator[tuple]]:
    con.row_factory = sqlite3.Row
    tables = con.execute("select table_name, column_name, srs_id from gpkg_geometry_columns order by table_name").fetchall()

    def rows() -> Iterator[tuple]:
        k = 0
        for table, column, _ in tables:
            for row in con.execute(f'select * from "{table}"'):
                blob = row[column]
                kind = shape = lines = None
                if blob is not None:
                    skip = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]  # header, and the envelope that its flags announce
                    kind, coordinates, _ = wkb_parts(blob, skip)
                    shape, lines = _parts(kind, coordinates)
                yield k, kind, shape, lines, {k: str(row[k]) for k in row.keys() if k not in (column, "fid") and row[k] is not None}
                k += 1

    return (tables[-1][2] if tables and tables[-1][2] > 0 else None), rows()


def gpkg_blob(kind: str | None, shape: list | None, lines: list | None, epsg: int) -> bytes | None:
    if not kind:
        return None
    coordinates = shape if shape is not None else [p[0] for p in lines] if "Point" in kind else lines
    return b"GP\0\x01" + struct.pack("<i", epsg) + write_wkb(kind, coordinates if kind.startswith("Multi") else coordinates[0])


def write_gpkg(rows: Iterable[tuple], fields: list[str], epsg: int, path: str, name: str = "features") -> None:
    """A GeoPackage at a path of this machine, of one table of (fid, geometry, fields in their order) rows, which come one by one."""
    con = sqlite3.connect(path)
    con.executescript("""
        pragma journal_mode = off; pragma synchronous = off;
        pragma application_id = 1196444487; pragma user_version = 10300;
        create table gpkg_spatial_ref_sys (srs_name text, srs_id integer primary key, organization text, organization_coordsys_id integer, definition text, description text);
        create table gpkg_contents (table_name text primary key, data_type text, identifier text, description text, last_change text, min_x double, min_y double, max_x double, max_y double, srs_id integer);
        create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z tinyint, m tinyint, primary key (table_name, column_name));
    """)
    con.execute("insert into gpkg_spatial_ref_sys values (?, ?, 'EPSG', ?, ?, null)", (f"EPSG:{epsg}", epsg, epsg, projection_of(epsg)))
    con.execute("insert into gpkg_contents (table_name, data_type, identifier, srs_id) values (?, 'features', ?, ?)", (name, name, epsg))
    con.execute("insert into gpkg_geometry_columns values (?, 'geom', 'GEOMETRY', ?, 0, 0)", (name, epsg))
    con.execute(f'create table "{name}" (fid integer primary key, geom blob{"".join(f", {chr(34)}{f}{chr(34)} text" for f in fields)})')
    con.executemany(f'insert into "{name}" values ({", ".join("?" * (2 + len(fields)))})', rows)
    con.commit()
    con.close()


def _rows(path: str, epsg: int | None, features: list[tuple]) -> pa.RecordBatch:
    points = pa.list_(pa.list_(pa.float64()))
    columns = list(zip(*features, strict=True)) or [[]] * 5
    kinds = (pa.int64(), pa.string(), pa.list_(pa.list_(points)), pa.list_(points), pa.map_(pa.string(), pa.string()))
    made = [pa.array([list(v.items()) if isinstance(v, dict) else v for v in c], k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(features), pa.string()), made[0], pa.array([epsg] * len(features), pa.int32()), *made[1:]], ["file", "fid", "epsg", "kind", "shape", "lines", "properties"])


def _batches(path: str, epsg: int | None, features: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    for some in batched(features, 2000):
        yield _rows(path, epsg, list(some))


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
            yield from _batches(path, *(gpkg_features(content) if path.lower().endswith(".gpkg") else geojson_features(content.decode("utf-8"))))


def _shapefile(stem: str, parts: dict) -> Iterator[pa.RecordBatch]:
    """Rows of a shapefile's parts by their suffixes."""
    missing = [p for p in SHAPEFILE_PARTS if p not in parts]
    if missing:
        raise ValueError(f"{stem} lacks {', '.join(missing)}")
    rows = chain(_dbf_rows(parts[".dbf"]), repeat({}))
    features = ((k, *made, row) for k, (made, row) in enumerate(zip(_shp_shapes(parts[".shp"]), rows, strict=False)))
    return _batches(stem + ".shp", epsg_of(parts[".prj"][:].decode("utf-8", "replace")) if ".prj" in parts else None, features)


def _read_shapefiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from _shapefile(row["stem"], dict(row["parts"]))


# Large files: Spark's text reader deals out any file by its line feeds, as the bytes that it has, whatever file system holds it.


def _lines(spark: SparkSession, large: list) -> DataFrame:
    """(uri, block, line) of files: a line's bytes, and where the stretch of the file begins in which a task finds it."""
    return spark.read.option("lineSep", "\n").text([r["path"] for r in large]).select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[bytes]]]:
    """(uri, block, lines) of neighbours."""
    for batch in batches:
        uri, block, lines = (batch[c].to_pylist() for c in ("uri", "block", "line"))
        cuts = [0, *(i for i in range(1, len(uri)) if block[i] != block[i - 1] or uri[i] != uri[i - 1]), len(uri)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield uri[a], block[a], lines[a:b]


def _packed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uri, block, at, chunk): lines put together again, in the order of ``at`` within a block; line feeds between chunks are left out."""
    at = 0
    for uri, block, lines in _blocks(batches):
        chunks, held, size = [], [], 0
        for x in lines:
            held.append(x)
            size += len(x) + 1
            if size >= SENT:
                chunks.append(b"\n".join(held))
                held, size = [], 0
        if held:
            chunks.append(b"\n".join(held))
        n = len(chunks)
        yield pa.RecordBatch.from_arrays([pa.array([uri] * n), pa.array([block] * n), pa.array(range(at, at + n), pa.int64()), pa.array(chunks, pa.binary())], ["uri", "block", "at", "chunk"])
        at += n


def _gathered(batches: Iterator[pa.RecordBatch], lengths: dict[str, int]) -> Iterator[tuple[str, dict]]:
    """(stem, files by suffix): files that come by chunks in order, each in a scratch file that goes with it."""
    stem, held = None, {}

    def whole() -> dict:
        for uri, f in held.items():
            if f.tell() < lengths[uri]:
                f.write(b"\n")
            f.flush()
            if f.tell() != lengths[uri]:
                raise ValueError(f"{uri} has {lengths[uri]} bytes, of which {f.tell()} were read")
        return {re.search(r"\.[A-Za-z]+$", uri)[0].lower(): f for uri, f in held.items()}

    for batch in batches:
        for of, uri, chunk in zip(*(batch[c].to_pylist() for c in ("stem", "uri", "chunk")), strict=True):
            if of != stem and held:
                yield stem, whole()
                held = {}
            stem = of
            if uri in held:
                held[uri].write(b"\n")
            else:
                held[uri] = tempfile.NamedTemporaryFile()
            held[uri].write(chunk)
    if held:
        yield stem, whole()


def _read_large(lengths: dict[str, int], paths: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stem, files in _gathered(batches, lengths):
            if ".gpkg" in files:
                con = sqlite3.connect(files[".gpkg"].name)
                yield from _batches(paths[stem], *_gpkg_features(con))
                con.close()
            else:
                yield from _shapefile(paths[stem], {suffix: mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) for suffix, f in files.items()})

    return run


def _large_files(spark: SparkSession, large: list, stems: dict[str, str]) -> DataFrame:
    """Features of GeoPackages and shapefiles, each put together by one task on its machine's disk. ``stems``: of each uri."""
    paths = {stems[r["uri"]]: r["path"] if r["path"].lower().endswith(".gpkg") else re.sub(r"\.[A-Za-z]+$", "", r["path"]) for r in large}
    packed = _lines(spark, large).mapInArrow(_packed_lines, "uri string, block long, at long, chunk binary")
    stem = F.when(F.lower("uri").endswith(".gpkg"), F.col("uri")).otherwise(F.regexp_replace("uri", r"\.[A-Za-z]+$", ""))
    dealt = packed.withColumn("stem", stem).repartition(len(paths), "stem").sortWithinPartitions("stem", "uri", "block", "at")
    return dealt.mapInArrow(_read_large({r["uri"]: r["length"] for r in large}, paths), FEATURE)


def _line_features(paths: dict[str, str]):
    """Features of lines with a feature each, by their numbers in their block; and a row for each line of another kind (text, and
    its place in the block): what stands before a file's features (head), and what stands in or after them. A line of a
    feature that cannot be read has no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple = ()
        for uri, block, lines in _blocks(batches):
            if (uri, block) != at:
                at, i, place, before = (uri, block), 0, 0, block == 0
            features, other = [], []
            for line in lines:
                text, place = line.decode("utf-8").strip(), place + 1
                said = text if len(text) <= _HEAD else "{"  # no head is so long
                if before:
                    other.append((i, True, said, place))
                    before = re.search(r'"features"\s*:\s*\[$', text) is None
                    continue
                try:
                    doc = json.loads(text.removesuffix(","))
                except ValueError:
                    other.append((i, False, said, place))
                    continue
                made = _geojson_feature(i, doc) if isinstance(doc, dict) else None
                if made:
                    features.append(made)
                else:
                    other.append((i, False, None, place))
                i += 1
            yield _beside(_rows(paths[uri], None, features), uri, block, [(None, None, None)] * len(features))
            yield _beside(_rows(paths[uri], None, [(x[0], None, None, None, None) for x in other]), uri, block, [x[1:] for x in other])

    return run


def _beside(rows: pa.RecordBatch, uri: str, block: int, notes: list[tuple]) -> pa.RecordBatch:
    head, text, place = zip(*notes, strict=True) if notes else ((), (), ())
    more = [pa.array([uri] * len(notes), pa.string()), pa.array([block] * len(notes), pa.int64()), pa.array(head, pa.bool_()), pa.array(text, pa.string()), pa.array(place, pa.int64())]
    return pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, "uri", "block", "head", "text", "place"])


def _geojson_head(head: str, tail: str) -> dict | None:
    """What a file says before its features, if the file is that, a feature a line, and the end of the list."""
    try:
        doc = json.loads(head + "]}")
    except ValueError:
        return None
    return doc if isinstance(doc, dict) and doc.get("type") == "FeatureCollection" and doc.get("features") == [] and re.sub(r"\s", "", tail) == "]}" else None


def _large_geojson(spark: SparkSession, large: list) -> DataFrame:
    """Features of GeoJSON files, dealt out by lines if each feature has one of its own; others are read whole."""
    paths = {r["uri"]: r["path"] for r in large}
    read = settle(_lines(spark, large).mapInArrow(_line_features(paths), f"{FEATURE}, uri string, block long, head boolean, text string, place long"))
    # A row for each stretch of a file, and the few lines that are no features.
    said = F.col("text").rlike(r"\S")
    ends = read.groupBy("uri", "block").agg(F.max(F.when(F.col("text").isNull(), F.col("fid"))).alias("last"), F.min(F.when(said & ~F.col("head"), F.col("fid"))).alias("tail")).orderBy("uri", "block").collect()
    sizes = read.where(said).groupBy("uri").agg(F.sum(F.octet_length("text") + 1).alias("size")).collect()
    few = [r["uri"] for r in sizes if r["size"] <= 2 * _HEAD]  # others are of another layout
    texts: dict = {}
    for r in read.where(F.col("uri").isin(few) & said).select("uri", "block", "place", "head", "text").orderBy("uri", "block", "place").collect():
        texts.setdefault(r["uri"], ([], []))[not r["head"]].append(r["text"])
    heads = {u: doc for u, (head, tail) in texts.items() if (doc := _geojson_head("\n".join(head), "\n".join(tail))) is not None}
    begins, starts, ended = {}, [], set()
    for r in ends:
        count = 0 if r["last"] is None else r["last"] + 1
        if r["uri"] in ended and count or r["tail"] is not None and r["tail"] < count:
            heads.pop(r["uri"], None)  # a feature after the end of the list
        if r["tail"] is not None:
            ended.add(r["uri"])
        starts.append((r["uri"], r["block"], begins.get(r["uri"], 0)))
        begins[r["uri"]] = begins.get(r["uri"], 0) + count
    made = spark.createDataFrame([(u, b, n, _geojson_epsg(heads[u])) for u, b, n in starts if u in heads], "of string, from_block long, before long, of_epsg int")
    found = read.where("head is null").join(F.broadcast(made), (F.col("uri") == F.col("of")) & (F.col("block") == F.col("from_block")))
    out = found.select("file", (F.col("fid") + F.col("before")).alias("fid"), F.col("of_epsg").alias("epsg"), "kind", "shape", "lines", "properties")
    rest = [p for u, p in paths.items() if u not in heads]
    return out.unionByName(spark.read.format("binaryFile").load(rest).select("path", "content").mapInArrow(_read_whole, FEATURE)) if rest else out


def features(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows of .geojson, .json and .gpkg files, and of shapefiles with their parts beside them. ``path`` names files or
    a folder of them. Schemas are fixed, nothing is inferred. Large GeoJSON files of a feature a line are read by all tasks,
    and large files of the other kinds by a task each that holds a stretch of them."""
    lower = path.lower()
    if lower.endswith(".shp"):
        path = path[:-4] + ".*"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.where(F.col("length") > WHOLE_BYTES).select("path", "length", F.col("_metadata.file_path").alias("uri")).collect()
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", "content")
    suffix = F.lower(F.regexp_extract("path", r"(\.[A-Za-z]+)$", 1))
    texts, tables, shapefiles = (".geojson", ".json"), (".gpkg",), (*SHAPEFILE_PARTS, ".prj")
    if lower.endswith((*texts, *tables)):
        out = small.mapInArrow(_read_whole, FEATURE)
    else:
        parts = small.withColumn("suffix", suffix).withColumn("stem", F.regexp_replace("path", r"\.[A-Za-z]+$", ""))
        wanted = shapefiles if lower.endswith(".shp") else (*texts, *tables, *shapefiles)
        listed = [r for r in listed if r["path"].lower().endswith(wanted)]
        stems = [re.sub(r"\.[A-Za-z]+$", "", r["path"]) for r in listed if r["path"].lower().endswith(shapefiles)]
        shp = parts.where(F.col("suffix").isin(*shapefiles) & ~F.col("stem").isin(stems)).groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct("suffix", "content"))).alias("parts"))
        out = shp.mapInArrow(_read_shapefiles, FEATURE)
        if not lower.endswith(".shp"):
            out = out.unionByName(parts.where(F.col("suffix").isin(*texts, *tables)).select("path", "content").mapInArrow(_read_whole, FEATURE))
        if stems:  # with the small parts of large shapefiles
            listed = [r for r in listed if not r["path"].lower().endswith(shapefiles)] + files.where(suffix.isin(*shapefiles) & F.regexp_replace("path", r"\.[A-Za-z]+$", "").isin(stems)).select("path", "length", F.col("_metadata.file_path").alias("uri")).collect()
    lines, others = ([r for r in listed if r["path"].lower().endswith((*tables, *shapefiles)) != one] for one in (True, False))
    if lines:
        out = out.unionByName(_large_geojson(spark, lines))
    if others:
        out = out.unionByName(_large_files(spark, others, {r["uri"]: r["uri"] if r["uri"].lower().endswith(tables) else re.sub(r"\.[A-Za-z]+$", "", r["uri"]) for r in others}))
    return out


def missing_parts(spark: SparkSession, path: str) -> DataFrame:
    """(stem, missing, without_prj) of the shapefiles in a folder: required parts that are not there."""
    names = spark.read.format("binaryFile").load(path).select(F.regexp_replace("path", r"\.[A-Za-z]+$", "").alias("stem"), F.lower(F.regexp_extract("path", r"(\.[A-Za-z]+)$", 1)).alias("suffix"))
    held = names.groupBy("stem").agg(F.collect_set("suffix").alias("held")).where(F.array_contains("held", ".shp") | F.array_contains("held", ".dbf"))
    return held.select("stem", F.array_except(F.array(*map(F.lit, SHAPEFILE_PARTS)), "held").alias("missing"), (~F.array_contains("held", ".prj")).alias("without_prj"))


def first_shapefile(spark: SparkSession, path: str) -> str | None:
    """The first .shp of a folder by name."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path).agg(F.min("path")).first()
    return found[0]


def only(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Features of some kinds, as POLYGONAL or LINEAR."""
    return df.where(F.col("kind").isin(*kinds))


def polygon_rows(df: DataFrame) -> DataFrame:
    """(id, shape, properties) of clean single polygons; ids go by file, feature and part."""
    parts = clean(only(df, POLYGONAL).select("file", "fid", "shape", "properties"))
    keyed = parts.withColumn("key", F.struct("file", "fid", "part"))
    # A position in the whole order: the rows before a file's features, by counts of files, and the place among them.
    inside = Window.partitionBy("file").orderBy("key")
    counts = keyed.groupBy("file").agg(F.count("*").alias("n"))
    before = counts.select(F.col("file"), F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return keyed.withColumn("at", F.row_number().over(inside) - 1).join(before, "file").select((F.col("before") + F.col("at")).alias("id"), "shape", "properties")


def needs_reprojection(df: DataFrame, epsg: int) -> bool:
    """Whether any row's coordinate system is another one, or unknown."""
    return not df.where(F.col("epsg").isNull() | (F.col("epsg") != epsg)).isEmpty()


def feature_json(df: DataFrame) -> DataFrame:
    """(json) of each feature row (kind, shape or lines, properties) as GeoJSON."""
    single = ~F.col("kind").startswith("Multi")
    points = F.col("kind").contains("Point")
    text = F.when(F.col("kind").contains("Polygon"), F.when(single, F.to_json(F.col("shape")[0])).otherwise(F.to_json("shape")))
    text = text.when(points, F.when(single, F.to_json(F.col("lines")[0][0])).otherwise(F.to_json(F.transform("lines", lambda p: p[0])))).otherwise(F.when(single, F.to_json(F.col("lines")[0])).otherwise(F.to_json("lines")))
    geometry = F.when(F.col("kind").isNull(), F.lit("null")).otherwise(F.concat(F.lit('{"type":"'), F.col("kind"), F.lit('","coordinates":'), text, F.lit("}")))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce(F.to_json("properties"), F.lit("{}")), F.lit(',"geometry":'), geometry, F.lit("}")).alias("json"))


@contextmanager
def _new_file(spark: SparkSession, path: str):
    """A function that adds bytes to a new file by whatever file system Spark knows; an existing one raises an error. A file
    that is not finished goes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(place, False)
    try:
        yield lambda data: out.write(bytearray(data))
        out.close()
    except BaseException:
        out.close()
        system.delete(place, False)
        raise


def write_text(spark: SparkSession, path: str, data: bytes) -> None:
    """One file by whatever file system Spark knows; an existing one raises an error."""
    with _new_file(spark, path) as add:
        add(data)


def _by_stretch(records: Iterable, size) -> Iterator[list]:
    """Neighbours of about ``STRETCH`` bytes together."""
    held, n = [], 0
    for x in records:
        held.append(x)
        n += size(x)
        if n >= STRETCH:
            yield held
            held, n = [], 0
    if held:
        yield held


def _json_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in _by_stretch(batch["json"].cast(pa.binary()).to_pylist(), len):
            yield pa.RecordBatch.from_arrays([pa.array([b",\n".join(some)], pa.binary())], ["body"])


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(fid, kind, shape, lines, properties) of 500 rows at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            yield list(zip(*(part[c].to_pylist() for c in ("fid", "kind", "shape", "lines")), [dict(p or ()) for p in part["properties"].to_pylist()], strict=True))


def _gpkg_rows(fields: list[str], epsg: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _features_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([gpkg_blob(*r[1:4], epsg) for r in rows], pa.binary()), pa.array([[r[4].get(f) for f in fields] for r in rows], pa.list_(pa.string()))], ["fid", "geom", "fields"])

    return run


def _shp_stretches(polygonal: bool, widths: dict[str, int]):
    """Stretches of records with room for their numbers, the records' sizes, the rows beside them, and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _features_of(batches):
            made = [(*shp_record(r[2], r[3], polygonal), r[4]) for r in rows]
            for some in _by_stretch(made, lambda m: len(m[0])):
                body = b"".join(bytes(4) + struct.pack(">I", len(m[0]) // 2) + m[0] for m in some)
                sizes = np.array([len(m[0]) for m in some], "<i8")
                known = np.array([m[1] for m in some if m[1]]).reshape(-1, 4)
                low_high = [*known[:, :2].min(axis=0).tolist(), *known[:, 2:].max(axis=0).tolist()] if len(known) else [None] * 4
                yield pa.RecordBatch.from_arrays([pa.array([len(some)], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([body], pa.binary()), pa.array([sizes.tobytes()], pa.binary()), pa.array([dbf_body((m[2] for m in some), widths)], pa.binary()), *(pa.array([x], pa.float64()) for x in low_high)], ["n", "size", "body", "sizes", "rows", "x0", "y0", "x1", "y1"])

    return run


def _numbered(body: bytes, sizes: np.ndarray, first: int) -> bytes:
    """A stretch of records with their numbers."""
    out = np.frombuffer(body, np.uint8).copy()
    at = np.cumsum(sizes + 8) - (sizes + 8)
    out[at[:, None] + np.arange(4)] = (first + np.arange(len(sizes))).astype(">u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes()


def _write_shapefile(df: DataFrame, stem: str, epsg: int) -> None:
    spark = df.sparkSession
    polygonal = bool(df.agg(F.max(F.coalesce(F.size("shape"), F.lit(0)) > 0)).first()[0])
    entries = df.select(F.explode("properties").alias("key", "value")).groupBy("key").agg(F.max(F.octet_length("value")).alias("w"))
    widths = {r["key"]: min(254, max(1, r["w"] or 0)) for r in entries.orderBy("key").collect()} or {"fid": 1}  # a file's fields
    made = settle(df.orderBy("fid").select("fid", "kind", "shape", "lines", "properties").mapInArrow(_shp_stretches(polygonal, widths), "n long, size long, body binary, sizes binary, rows binary, x0 double, y0 double, x1 double, y1 double"))
    t = made.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first()
    bounds = [0.0] * 4 if t[2] is None else list(t[2:])
    heads = shp_head(100 + t["size"], polygonal, bounds), shp_head(100 + 8 * t["n"], polygonal, bounds)
    with _new_file(spark, stem + ".shp") as add:
        add(heads[0])
        first = 1
        for r in made.select("body", "sizes").toLocalIterator():
            sizes = np.frombuffer(r["sizes"], "<i8")
            add(_numbered(r["body"], sizes, first))
            first += len(sizes)
    with _new_file(spark, stem + ".shx") as add:
        add(heads[1])
        at = 50
        for r in made.select("sizes").toLocalIterator():
            words = np.frombuffer(r["sizes"], "<i8") // 2
            begin = at + np.cumsum(words + 4) - (words + 4)
            add(np.stack([begin, words], axis=1).astype(">u4").tobytes())
            at += int((words + 4).sum())
    with _new_file(spark, stem + ".dbf") as add:
        add(dbf_head(t["n"], widths))
        for r in made.select("rows").toLocalIterator():
            add(r["rows"])
        add(b"\x1a")
    write_text(spark, stem + ".prj", projection_of(epsg).encode())


def write_features(df: DataFrame, path: str, epsg: int) -> None:
    """Feature rows as one .geojson, .gpkg or .shp file (with .shx, .dbf and .prj). Tasks make stretches of the file, which go to
    the checkpoint folder; the driver copies them one by one, so a layer may be larger than its memory. A GeoPackage's rows
    go through a scratch file of the driver, which is as large as the GeoPackage."""
    spark = df.sparkSession
    if path.lower().endswith((".geojson", ".json")):
        made = settle(feature_json(df.orderBy("fid")).mapInArrow(_json_stretches, "body binary"))
        crs = "urn:ogc:def:crs:OGC:1.3:CRS84" if epsg == 4326 else f"urn:ogc:def:crs:EPSG::{epsg}"
        with _new_file(spark, path) as add:
            add(f'{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"{crs}"}}}},"features":['.encode())
            between = b"\n"
            for r in made.toLocalIterator():
                add(between + r["body"])
                between = b",\n"
            add(b"\n]}")
    elif path.lower().endswith(".gpkg"):
        fields = [r["key"] for r in df.select(F.explode(F.map_keys("properties")).alias("key")).distinct().orderBy("key").collect()]  # a table's columns
        made = settle(df.orderBy("fid").select("fid", "kind", "shape", "lines", "properties").mapInArrow(_gpkg_rows(fields, epsg), "fid long, geom binary, fields array<string>"))
        with tempfile.NamedTemporaryFile() as scratch, _new_file(spark, path) as add:
            write_gpkg(((r["fid"], r["geom"], *r["fields"]) for r in made.toLocalIterator()), fields, epsg, scratch.name)
            while data := scratch.read(STRETCH):
                add(data)
    elif path.lower().endswith(".shp"):
        _write_shapefile(df, path[:-4], epsg)
    else:
        raise ValueError("a path must end in .geojson, .json, .gpkg or .shp")


def polygon_features(df: DataFrame) -> DataFrame:
    """Feature rows of (id, shape)."""
    kind = F.when(F.size("shape") > 1, "MultiPolygon").otherwise("Polygon")
    return df.select(F.lit("").alias("file"), F.col("id").cast("long").alias("fid"), F.lit(None).cast("int").alias("epsg"), kind.alias("kind"), "shape", F.lit(None).cast("array<array<array<double>>>").alias("lines"), F.create_map(F.lit("id"), F.col("id").cast("string")).alias("properties"))


def chunk_plan(west: float, south: float, east: float, north: float, most: float = 0.25) -> list[tuple[float, float, float, float]]:
    """A box as so many equal ones, the same number along both sides, that the whole's area over their number is no more than
    ``most`` square degrees; requests for features are made box by box."""
    n = math.ceil(math.sqrt((east - west) * (north - south) / most)) if (east - west) * (north - south) > most else 1
    x, y = (east - west) / n, (north - south) / n
    return [(west + i * x, south + j * y, west + (i + 1) * x, south + (j + 1) * y) for j in range(n) for i in range(n)]


def merged_chunks(chunks: list[DataFrame]) -> DataFrame:
    """Features of several chunks, each geometry once."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c)
    mark = F.xxhash64(F.to_json("lines"), F.to_json("shape"))
    return out.withColumn("_mark", mark).dropDuplicates(["_mark"]).drop("_mark")
