"""Tile names, grids, completion and mask cleanup."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._order import by_ranges, running


def _tokens(name: Column) -> Column:
    """A name as its runs of digits, each whole, and its other characters, each alone and in lower case."""
    return F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D"), F.lit(0))


def _first(tokens: Column, holds, values) -> Column:
    """What ``values`` gives for the first place of the tokens at which ``holds``; null if it does at none."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), lambda i: holds(lambda k: F.try_element_at(tokens, (i + k).cast("int"))))
    at = F.try_element_at(places, F.lit(1))
    return F.when(at.isNotNull(), values(lambda k: F.try_element_at(tokens, (at + k).cast("int"))))


def _is_number(token: Column) -> Column:
    return F.coalesce(token.try_cast("long").isNotNull(), F.lit(False))


def _is_mark(token: Column) -> Column:
    return F.coalesce(token.isin("_", "-"), F.lit(False))


def _labeled(name: Column, one: str, two: str) -> Column:
    """(a, b): the numbers right after the labels ``one`` and ``two``, with a separator between both parts or none."""
    out = None
    for gap in (1, 0):
        holds = lambda t, g=gap: F.coalesce((t(0) == one) & (t(2 + g) == two), F.lit(False)) & _is_number(t(1)) & _is_number(t(3 + g)) & (_is_mark(t(2)) if g else F.lit(True))
        found = _first(_tokens(name), holds, lambda t, g=gap: F.struct(t(1).try_cast("long").alias("a"), t(3 + g).try_cast("long").alias("b")))
        out = found if out is None else F.coalesce(out, found)
    return F.coalesce(out, F.struct(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b")))


def row_col(name: Column) -> Column:
    """(a, b): row and column of a tile name whose numbers are labeled r and c, or else its first two numbers that each
    follow a separator."""
    bare = _first(_tokens(name), lambda t: _is_mark(t(0)) & _is_number(t(1)) & _is_mark(t(2)) & _is_number(t(3)), lambda t: F.struct(t(1).try_cast("long").alias("a"), t(3).try_cast("long").alias("b")))
    marked = _labeled(name, "r", "c")
    return F.when(marked["a"].isNotNull(), marked).otherwise(F.coalesce(bare, marked))


def x_y(name: Column) -> Column:
    """(a, b): pixel offsets of a tile name whose numbers are labeled x and y."""
    return _labeled(name, "x", "y")


def flat_index(name: Column) -> Column:
    """The number that ends a tile name, after a separator and before its suffix."""
    parts = F.split(name, r"\.")
    suffix = F.try_element_at(parts, F.lit(-1))
    stem = F.when((F.size(parts) > 1) & (suffix != "") & ~suffix.contains("-"), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "."))

    def ending(text: Column) -> Column:
        tokens = _tokens(text)
        last, before = F.try_element_at(tokens, F.lit(-1)), F.try_element_at(tokens, F.lit(-2))
        return F.when(_is_mark(before) & _is_number(last), last.try_cast("long"))

    return F.coalesce(ending(name), ending(stem))


def flat_columns(n: int) -> int:
    """Columns of a grid of n tiles: n over its largest divisor up to its square root."""
    import math

    return next(n // d for d in range(math.isqrt(n), 0, -1) if n % d == 0) if n > 0 else 0


def south_west(tiles: DataFrame, row: str, col: str) -> DataFrame:
    """Tiles in the left and lower half of the grid that the tiles span."""
    limits = tiles.agg(F.min(row).alias("r0"), F.max(row).alias("r1"), F.min(col).alias("c0"), F.max(col).alias("c1"))
    west = F.col(col) < F.col("c0") + (F.col("c1") - F.col("c0") + 1) / 2
    south = F.col(row) >= F.col("r0") + (F.col("r1") - F.col("r0") + 1) / 2
    return tiles.crossJoin(F.broadcast(limits)).where(west & south).select(*tiles.columns)


def complete(grid: DataFrame, entries: DataFrame, keys: list[str], zeros: dict[str, object]) -> DataFrame:
    """A row for each tile of the grid: its entry's values, or zeros. Entries outside the grid go."""
    out = grid.select(*keys).distinct().join(entries, keys, "left")
    return out.select(*keys, *(F.coalesce(F.col(c), F.lit(z)).alias(c) for c, z in zeros.items()))


def grid_indices(names: DataFrame, raw_row: str, raw_col: str) -> DataFrame:
    """Pixel offsets to tile indices: ranks of distinct values, the axes swapped. Distinct offsets are ranked first, so
    that the windows hold a grid's side and not its tiles."""
    by = lambda c, out: names.select(c).distinct().select(c, (F.dense_rank().over(Window.orderBy(c)) - 1).alias(out))
    return names.join(by(raw_col, "tile_x"), raw_col).join(by(raw_row, "tile_y"), raw_row)


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bin, n) of half-open bins between edges; empty bins have 0, values outside are left out."""
    number = F.lit(None).cast("int")
    for k in reversed(range(len(edges) - 1)):
        number = F.when((F.col(value) >= edges[k]) & (F.col(value) < edges[k + 1]), k).otherwise(number)
    bins = df.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    counts = df.select(number.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    return bins.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def density_sample(pixels: DataFrame, tile: list[str], order: list[str], density: float, seed: int) -> DataFrame:
    """Pixels of each tile without replacement: floor(count * density), one at least, by a seeded hash."""
    w = Window.partitionBy(*tile)
    ranked = pixels.withColumn("k", F.row_number().over(w.orderBy(F.xxhash64(F.lit(seed), *tile, *order), *order))).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("k") <= F.greatest(F.lit(1), F.floor(F.col("n") * density))).drop("k", "n")


def clean_buildings(pixels: DataFrame, blocked: DataFrame) -> DataFrame:
    """Building pixels (building, x, y) against blocked ones (x, y): pixels, blocked pixels and what becomes of each
    building: removed when all are blocked, mask_only when some are, kept when none is."""
    hit = pixels.join(blocked.select("x", "y").distinct().withColumn("b", F.lit(1)), ["x", "y"], "left")
    counts = hit.groupBy("building").agg(F.count("*").alias("pixels"), F.count("b").alias("blocked"))
    return counts.withColumn("fate", F.when(F.col("blocked") == F.col("pixels"), "removed").when(F.col("blocked") > 0, "mask_only").otherwise("kept"))


def positions_on_mask(positions: DataFrame, masks: DataFrame) -> DataFrame:
    """Positions (tile, x, y from 0 to 1) whose pixel in the tile's mask (tile, width, height, px) is set."""
    both = positions.join(masks, "tile")
    clamp = lambda v, n: F.least(F.greatest((v * n).cast("int"), F.lit(0)), n - 1)
    at = clamp(F.col("y"), F.col("height")) * F.col("width") + clamp(F.col("x"), F.col("width"))
    return both.where(F.element_at("px", at + 1) > 0).select(*positions.columns)


def inference_starts(size: Column, tile: int, overlap: int) -> Column:
    """Starts of tiles that cover ``size`` pixels with an overlap; the last one is moved inwards."""
    stride = tile - overlap
    return F.when(size <= tile, F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), F.ceil((size - tile) / stride)), lambda k: F.least(k * stride, size - tile))))


def degree_tiles(boxes: DataFrame) -> DataFrame:
    """A row for each degree tile that a box (left, bottom, right, top) touches."""
    out = boxes.withColumn("lon", F.explode(F.sequence(F.floor("left"), F.ceil("right") - 1)))
    return out.withColumn("lat", F.explode(F.sequence(F.floor("bottom"), F.ceil("top") - 1)))


def dedupe_coordinates(values: DataFrame, value: str, tolerance: float) -> DataFrame:
    """(value, group): along the sorted values a new group begins where a value is more than the tolerance above the first
    one of the group before. Groups are numbered from 0.

    A gap beyond the tolerance always begins a group, so stretches between such gaps are folded apart.
    """
    distinct = values.select(F.col(value).cast("double").alias("v")).distinct()
    ranged = by_ranges(distinct, ["v"])
    ends = {r["p"]: r["b"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.max("v").alias("b")).collect()}  # a row for each task

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId()
        last = max((b for p, b in ends.items() if p < own), default=-np.inf)
        for batch in batches:
            v = batch["v"].to_numpy()
            if len(v):
                gap = np.diff(v, prepend=last) > tolerance
                last = v[-1]
                yield pa.RecordBatch.from_arrays([batch["v"], pa.array(gap.astype(np.int64))], ["v", "new"])

    islands = running(ranged.mapInArrow(marks, "v double, new long"), ["v"], "new", "before").select("v", (F.col("before") + F.col("new")).alias("island"))
    lists = islands.groupBy("island").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    heads = F.aggregate("vs", F.array().cast("array<double>"), lambda a, x: F.when((F.size(a) == 0) | (x - F.coalesce(F.try_element_at(a, F.lit(-1)), x) > tolerance), F.concat(a, F.array(x))).otherwise(a))
    counted = running(lists.select("island", "vs", heads.alias("heads"), F.size(heads).cast("long").alias("n")), ["island"], "n", "base")
    each = counted.select(F.explode("vs").alias(value), "heads", "base")
    return each.select(value, (F.col("base") + F.size(F.filter("heads", lambda h: h <= F.col(value))) - 1).alias("group"))


def groups_of_features(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Counts by degree tile of the places that stand for features."""
    return df.groupBy(F.floor(lat).alias("lat"), F.floor(lon).alias("lon")).agg(F.count("*").alias("n"))


def facade_indices(df: DataFrame, tile: str, facade: str) -> DataFrame:
    """(tile, facade, idx): a tile's distinct facades in the order of their names, from 0. Only distinct ones are ranked."""
    rows = df.select(F.col(tile).alias("tile"), F.col(facade).alias("facade")).distinct()
    return rows.select("tile", "facade", (F.dense_rank().over(Window.partitionBy("tile").orderBy("facade")) - 1).cast("long").alias("idx"))


def exclusion(places: DataFrame, lat: str, lon: str, margin: float = 0.001) -> DataFrame:
    """One row: the middle of the places' box, and the box with a margin."""
    p = places.agg(F.min(lat).alias("a"), F.max(lat).alias("b"), F.min(lon).alias("c"), F.max(lon).alias("e"))
    return p.select(((F.col("a") + F.col("b")) / 2).alias("lat"), ((F.col("c") + F.col("e")) / 2).alias("lon"), (F.col("a") - margin).alias("south"), (F.col("b") + margin).alias("north"), (F.col("c") - margin).alias("west"), (F.col("e") + margin).alias("east"))


def unused(held: DataFrame, used: DataFrame, name: str) -> DataFrame:
    """Names that are held and nothing uses, once each."""
    return held.select(name).distinct().join(used.select(name).distinct(), name, "left_anti")


def on_tiles_of(rows: DataFrame, others: DataFrame, tile: list[str]) -> DataFrame:
    """Rows on tiles that hold any of the others."""
    return rows.join(others.select(*tile).distinct(), tile, "left_semi")


def grid_sample(pixels: DataFrame, value: str, step: int, limit: float) -> DataFrame:
    """Every ``step``-th pixel along both axes (row, col) that reaches the limit."""
    on = lambda c: F.call_function("mod", F.col(c), F.lit(step)) == 0
    return pixels.where((F.col(value) >= limit) & on("row") & on("col"))


def jittered(positions: DataFrame, by: float, size: tuple[str, str], seed: int) -> DataFrame:
    """Positions (x, y, 0 to 1) moved by up to ``by`` pixels along both axes, kept inside; by a seeded hash of each row."""
    shift = lambda c, salt: (F.pmod(F.xxhash64(F.lit(seed + salt), *positions.columns), F.lit(1 << 30)) / float(1 << 29) - 1) * by / F.col(c)
    inside = lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v))
    return positions.withColumns({"x": inside(F.col("x") + shift(size[0], 0)), "y": inside(F.col("y") + shift(size[1], 1))})


def thinned(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """Each row with the given chance, by a seeded hash of it."""
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), *rows.columns), F.lit(1 << 30)) < int(share * (1 << 30)))


def with_fallback(rows: DataFrame, assets: DataFrame, names: list[str], key: str) -> DataFrame:
    """Rows with the asset whose ``key`` is the first of their names that any asset has; rows without one keep nulls."""
    out = rows
    for k, name in enumerate(names):
        found = assets.select(F.col(key).alias(f"_key{k}"), F.struct(*assets.columns).alias(f"_asset{k}")).dropDuplicates([f"_key{k}"])
        out = out.join(found, out[name] == F.col(f"_key{k}"), "left").drop(f"_key{k}")
    picked = F.coalesce(*(F.col(f"_asset{k}") for k in range(len(names))))
    return out.withColumn("asset", picked).drop(*(f"_asset{k}" for k in range(len(names))))


def with_reference(masks: DataFrame, references: DataFrame, stem: str) -> tuple[DataFrame, DataFrame]:
    """Masks with the reference raster of their stem, and the stems of those that have none."""
    return masks.join(references, stem), masks.select(stem).join(references.select(stem), stem, "left_anti")


def mask_values(points: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """Points (x, y from 0 to 1 in their tile) with the value of their pixel in the tile's mask (width, height, px) as ``mask``;
    points without a mask go."""
    both = points.join(masks, keys)
    clamp = lambda v, n: F.least(F.greatest((v * n).cast("int"), F.lit(0)), n - 1)
    at = clamp(F.col("y"), F.col("height")) * F.col("width") + clamp(F.col("x"), F.col("width"))
    return both.select(*points.columns, F.element_at("px", at + 1).alias("mask"))


def covered(boxes: DataFrame, extents: DataFrame, code: str, cell: float) -> DataFrame:
    """Boxes (id and sides) with ``has``: whether any extent of a code (code and sides) shares area with them; a code after !
    asks for the opposite."""
    from .spatial import box_join, intersection_area

    wanted = extents.where(F.col("code") == code.lstrip("!"))
    hit = box_join(boxes, wanted, cell).where(intersection_area() > 0).select("id").distinct().withColumn("_hit", F.lit(True))
    held = F.coalesce("_hit", F.lit(False))
    return boxes.join(hit, "id", "left").withColumn("has", ~held if code.startswith("!") else held).drop("_hit")
