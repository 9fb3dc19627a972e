"""Rasters as rows of pixel arrays, with statistics, stretches and stencils by built-in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import to_byte
from ._order import percentiles


def pixels(tiles: DataFrame, px: str, width: int) -> DataFrame:
    """Long form: the other columns and row, col, v."""
    out = tiles.select(*(c for c in tiles.columns if c != px), F.posexplode(px).alias("at", "v"))
    return out.select(*(c for c in tiles.columns if c != px), F.floor(F.col("at") / width).cast("int").alias("row"), F.call_function("mod", F.col("at"), F.lit(width)).alias("col"), "v")


def tile_stats(tiles: DataFrame, px: str, keys: list[str]) -> DataFrame:
    """min, max and mean of each tile's pixels, without a shuffle: the arrays are folded where they lie."""
    n = F.size(px)
    mean = F.aggregate(px, F.lit(0.0), lambda a, x: a + x) / F.when(n > 0, n)
    return tiles.select(*keys, F.array_min(px).alias("min"), F.array_max(px).alias("max"), mean.alias("mean"))


def global_stats(tiles: DataFrame, px: str, nodata: float) -> DataFrame:
    """Least and greatest pixel of all tiles but nodata, and their difference."""
    valid = F.filter(px, lambda x: (x != nodata) & ~F.isnan(x))
    return tiles.select(F.array_min(valid).alias("a"), F.array_max(valid).alias("b")).agg(F.min("a").alias("min"), F.max("b").alias("max"), (F.max("b") - F.min("a")).alias("range"))


def threshold_mask(px: Column, limit: float, low_is_set: bool = False, invert: bool = False) -> Column:
    """1 where pixels reach the limit (or stay at or under it), or the other way round."""
    return F.transform(px, lambda x: ((x <= limit if low_is_set else x >= limit) != F.lit(invert)).cast("int"))


def mask_share(mask: Column) -> tuple[Column, Column]:
    """Set pixels, and their percentage."""
    n = F.aggregate(mask, F.lit(0), lambda a, x: a + x)
    return n, F.when(F.size(mask) > 0, 100.0 * n / F.when(F.size(mask) > 0, F.size(mask))).otherwise(0.0)


def and_not(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: ((x > 0) & ~(y > 0)).cast("int"))


def either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: ((x > 0) | (y > 0)).cast("int"))


def band_stretch(long: DataFrame, band: str, value: str, nodata: float) -> DataFrame:
    """2nd and 98th percentile of a band's samples that are neither 0 nor nodata; (0, 255) where none is left, and one
    unit apart where they are equal."""
    found = percentiles(long.where((F.col(value) != 0) & (F.col(value) != nodata)), value, [0.02, 0.98], (band,))
    out = long.select(band).distinct().join(found, band, "left")
    lo, hi = F.coalesce(F.col("q")[0], F.lit(0.0)), F.coalesce(F.col("q")[1], F.lit(255.0))
    return out.select(band, lo.alias("lo"), F.when(hi <= lo, lo + 1).otherwise(hi).alias("hi"))


def stretch(px: Column, low: Column, high: Column) -> Column:
    return F.transform(px, lambda x: to_byte(x, low, high))


def to_uint16(px: Column, low: Column, span: Column) -> Column:
    """Heights to 0..65535 of a span, rounded half to even; NaN is 0."""
    safe = F.when(span > 0, span)
    return F.transform(px, lambda z: F.when(F.isnan(z), 0).otherwise(F.least(F.lit(65535.0), F.greatest(F.lit(0.0), F.coalesce(F.rint((z - low) / safe * 65535), F.lit(0.0))))).cast("int"))


def sample(points: DataFrame, long: DataFrame, keys: list[str]) -> DataFrame:
    """Values between pixels at (x, y) by the triangle that holds the place: of the two over each cell the lower right
    one where the fraction along x is at least that along y."""
    x0, y0 = F.floor("x"), F.floor("y")
    at = points.withColumns({"c0": x0, "r0": y0, "fx": F.col("x") - x0, "fy": F.col("y") - y0})
    corners = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    need = at.withColumn("_at", F.explode(corners)).select(*points.columns, "fx", "fy", (F.col("r0") + F.col("_at.a")).alias("row"), (F.col("c0") + F.col("_at.b")).alias("col"), F.concat(F.col("_at.a").cast("string"), F.col("_at.b").cast("string")).alias("_corner"))
    got = need.join(long.select(*keys, "row", "col", "v"), [*keys, "row", "col"]).groupBy(*points.columns, "fx", "fy").pivot("_corner", ["00", "01", "10", "11"]).agg(F.first("v"))
    v00, v01, v10, v11 = (F.col(f"`{k}`") for k in ("00", "01", "10", "11"))
    fx, fy = F.col("fx"), F.col("fy")
    value = F.when(fx >= fy, v00 + fx * (v01 - v00) + fy * (v11 - v01)).otherwise(v00 + fy * (v10 - v00) + fx * (v11 - v10))
    return got.select(*points.columns, value.alias("value"))


def sample_nearest(points: DataFrame, long: DataFrame, keys: list[str], nodata: float | None = None) -> DataFrame:
    """Values of the pixels nearest to (x, y), half to even; nodata as null."""
    near = points.withColumns({"col": F.rint("x").cast("int"), "row": F.rint("y").cast("int")})
    got = near.join(long.select(*keys, "row", "col", F.col("v").alias("value")), [*keys, "row", "col"], "left").select(*points.columns, "value")
    return got if nodata is None else got.withColumn("value", F.nullif("value", F.lit(nodata)))


def composite(layers: list[DataFrame], base: DataFrame, keys: list[str], value: str, nodata: float) -> DataFrame:
    """A value for each row of ``base`` (keys, value): the last layer's that has one beside nodata, else the base's."""
    out = base.select(*keys, F.col(value).alias("_0"))
    for k, layer in enumerate(layers, 1):
        out = out.join(layer.select(*keys, F.nullif(value, F.lit(nodata)).alias(f"_{k}")), keys, "left")
    return out.select(*keys, F.coalesce(*(F.col(f"_{k}") for k in range(len(layers), -1, -1))).alias(value))


def overlapped(width: Column, height: Column, size: int) -> Column:
    """Places and sizes of the height tiles that go with an image's tiles: one row and column more, shared with the next."""
    rows, cols = (F.sequence(F.lit(0).cast("long"), F.ceil(n / size) - 1) for n in (height, width))
    return F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.struct((r * size).alias("row"), (c * size).alias("col"), (F.least(F.lit(size).cast("long"), height - r * size) + 1).alias("height"), (F.least(F.lit(size).cast("long"), width - c * size) + 1).alias("width")))))
