"""Placement of buildings, tiles and materials in a scene, and the hooks for a user's own rules."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import affine_to_world


def seeded_choice(df: DataFrame, key: str, options: list[str], out: str) -> DataFrame:
    """``out``: an option for each whole number in ``key``, as Python's generator seeded by it chooses; null for null. Each
    distinct key of a batch is drawn once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch[key].to_pylist()
            drawn = {k: random.Random(k).choice(options) for k in set(keys) - {None}}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([drawn.get(k) for k in keys], pa.string())], [*batch.schema.names, out])

    if not options:
        raise ValueError("there is nothing to choose from")
    return df.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{out}` string"]))


def material_index(name: Column, x: Column, z: Column, count: int) -> Column:
    """A material's number from a building's name and its place in whole centimetres: a chain of hashes times 31, its sign
    masked off. The hash of a text is Spark's, so numbers are the same on every run and machine."""
    def link(a: Column, b: Column) -> Column:
        return F.call_function("mod", a * 31 + b, F.lit(1 << 31))

    start = F.lit(17).cast("long")
    for part in (F.hash(name).cast("long"), F.rint(x * 100).cast("long"), F.rint(z * 100).cast("long")):
        start = link(start, part)
    return F.call_function("mod", start.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(count)).cast("int")


def to_world(corners: Column, tile_x: Column, tile_y: Column, tile: int, width: int, height: int, transform: tuple[float, ...]) -> Column:
    """Corners (arrays of column, row in a tile) as arrays of latitude, longitude: pixels of the whole raster, kept inside it,
    by its affine transform (a, b, c, d, e, f)."""
    inside = lambda v, n: F.least(F.greatest(v, F.lit(0.0)), F.lit(n - 1.0))

    def place(p: Column) -> Column:
        lat, lon = affine_to_world(inside(tile_x * tile + p[0], width), inside(tile_y * tile + p[1], height), *map(F.lit, transform))
        return F.array(lat, lon)

    return F.transform(corners, place)


def convert_buildings(buildings: DataFrame, tile: int, width: int, height: int, transform: tuple[float, ...]) -> DataFrame:
    """Detected buildings (tile_x, tile_y, id, center_x, center_y, corner_points) in pixels as such on the globe; those with
    fewer than three corners go."""
    kept = buildings.where(F.size("corner_points") >= 3)
    world = lambda c: to_world(c, F.col("tile_x"), F.col("tile_y"), tile, width, height, transform)
    centre = world(F.array(F.array(F.col("center_x").cast("double"), F.col("center_y").cast("double"))))[0]
    return kept.select(*(c for c in buildings.columns if c not in ("center_x", "center_y", "corner_points")), centre[0].alias("center_lat"), centre[1].alias("center_lon"), world("corner_points").alias("corner_points_wgs84"))


def in_scene(items: DataFrame, tiles: DataFrame, columns: int, count: int) -> DataFrame:
    """Items (tile_x, tile_y, x, y in pixels from above) at their place in the scene (world_x, world_z), by their tile's pixels
    (width, height), metres (ground_width, ground_height) and origin (origin_x, origin_z); rows of tiles run row by row, and
    items whose tile's index is none of ``count`` go."""
    index = F.col("tile_y") * columns + F.col("tile_x")
    held = items.withColumn("tile_index", index).where((F.col("tile_index") >= 0) & (F.col("tile_index") < count) & F.col("tile_x").between(0, columns - 1))
    both = held.join(tiles, ["tile_x", "tile_y"])
    x = F.col("origin_x") + F.col("x") * F.col("ground_width") / F.col("width")
    z = F.col("origin_z") + (F.col("height") - F.col("y")) * F.col("ground_height") / F.col("height")
    return both.select(*items.columns, "tile_index", x.alias("world_x"), z.alias("world_z"))


def scene_neighbours(tiles: DataFrame) -> DataFrame:
    """Each tile (tile_x, tile_y, name) with the names beside it: left, top, right, bottom, null at borders."""
    out = tiles.select("tile_x", "tile_y", "name")
    for side, dx, dy in (("left", -1, 0), ("top", 0, -1), ("right", 1, 0), ("bottom", 0, 1)):
        other = tiles.select((F.col("tile_x") - dx).alias("tile_x"), (F.col("tile_y") - dy).alias("tile_y"), F.col("name").alias(side))
        out = out.join(other, ["tile_x", "tile_y"], "left")
    return out


def box_faces(width: Column, height: Column, depth: Column, per_metre: float) -> Column:
    """Texture sizes (u, v) of a box's six faces at so many repeats a metre: front, back, left, right, top, bottom."""
    face = lambda n, u, v: F.struct(F.lit(n).alias("face"), (u * per_metre).alias("u"), (v * per_metre).alias("v"))
    return F.array(face("front", width, height), face("back", width, height), face("left", depth, height), face("right", depth, height), face("top", width, depth), face("bottom", width, depth))


def ribbon(line: Column, half: float, cap: float = 3.0) -> Column:
    """A road's surface along a line (array of structs x, y): for each vertex both edges, by the mitre of its two directions,
    no longer than ``cap`` half widths."""
    n = F.size(line)

    def direction(i: Column, j: Column) -> tuple[Column, Column]:
        a, b = F.element_at(line, i), F.element_at(line, j)
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        long_ = F.hypot(dx, dy)
        safe = F.when(long_ > 0, long_)
        return F.coalesce(dx / safe, F.lit(0.0)), F.coalesce(dy / safe, F.lit(0.0))

    def edges(p: Column, k: Column) -> Column:
        i = k + 1
        (ax, ay), (bx, by) = direction(F.greatest(i - 1, F.lit(1)), F.greatest(i, F.lit(2))), direction(F.least(i, n - 1), F.least(i + 1, n))
        mx, my = -(ay + by), ax + bx
        size = F.hypot(mx, my)
        ux, uy = F.coalesce(mx / F.when(size > 1e-12, size), -ay), F.coalesce(my / F.when(size > 1e-12, size), ax)
        cosine = ux * -ay + uy * ax
        reach = F.least(F.lit(cap), 1 / F.when(cosine > 1e-6, cosine)) * half
        r = F.coalesce(reach, F.lit(cap * half))
        return F.struct((p["x"] + ux * r).alias("lx"), (p["y"] + uy * r).alias("ly"), (p["x"] - ux * r).alias("rx"), (p["y"] - uy * r).alias("ry"))

    return F.when(n >= 2, F.transform(line, edges))


# --- a user's own rules -----------------------------------------------------------------------------------------------


def keep_where(rows: DataFrame, rule: Callable[[DataFrame], Column]) -> DataFrame:
    """Rows for which a user's rule, a function from the DataFrame to a condition, holds."""
    return rows.where(F.coalesce(rule(rows), F.lit(False)))


def with_altitude(points: DataFrame, altitude: Callable[[Column, Column], Column], x: str = "x", y: str = "y", out: str = "z") -> DataFrame:
    """``out``: what a user's function of both coordinates' columns gives."""
    return points.withColumn(out, altitude(F.col(x), F.col(y)))


_DETECTORS: dict[str, Callable[..., DataFrame]] = {}


def register_detector(name: str, detector: Callable[..., DataFrame]) -> None:
    """Makes a detector (a function of tiles and options to building rows) known by a name; a known name is replaced."""
    _DETECTORS[name] = detector


def detect(name: str, tiles: DataFrame, **options) -> DataFrame:
    """The building rows that the detector of this name finds; an unknown one raises ValueError."""
    if name not in _DETECTORS:
        raise ValueError(f"no detector {name!r}; known are {sorted(_DETECTORS)}")
    return _DETECTORS[name](tiles, **options)


PREDICTIONS = "array<struct<x: double, y: double, width: double, height: double, confidence: double, class: string, points: array<struct<x: double, y: double>>>>"


def prediction_rows(images: DataFrame, json: str) -> DataFrame:
    """A detector's answer (``json``: an object with ``predictions``) to a row for each prediction: its corners are its points,
    or else those of its box around the centre."""
    keep = [c for c in images.columns if c != json]
    parsed = images.select(*keep, F.posexplode(F.from_json(json, f"predictions {PREDICTIONS}")["predictions"]).alias("n", "p"))
    corner = lambda a, b: F.array(F.col("p.x") + a * F.col("p.width") / 2, F.col("p.y") + b * F.col("p.height") / 2)
    box = F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1))
    points = F.transform("p.points", lambda q: F.array(q["x"], q["y"]))
    return parsed.select(*keep, "n", F.col("p.confidence").alias("confidence"), F.col("p.class").alias("class"), F.when(F.size("p.points") >= 3, points).otherwise(box).alias("corner_points"))
