"""Classification of roads and buildings, and colour arithmetic, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Network subtypes of road types, in the order in which types are tried.
ROAD_SUBTYPES = (("motorway", 100), ("trunk", 100), ("primary", 10), ("secondary", 30), ("tertiary", 30), ("residential", 50), ("living_street", 50), ("unclassified", 50), ("service", 70), ("track", 70), ("path", 70), ("footway", 70), ("cycleway", 70), ("pedestrian", 50))
# Widths in metres.
ROAD_WIDTHS = (("motorway", 16.0), ("trunk", 14.0), ("primary", 12.0), ("secondary", 10.0), ("tertiary", 8.0), ("residential", 7.0), ("living_street", 5.0), ("unclassified", 6.0), ("service", 4.0), ("track", 3.5), ("path", 1.5), ("footway", 1.5), ("cycleway", 2.0), ("pedestrian", 5.0))
# Types that the masks show as asphalt.
PAVED = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "living_street", "unclassified", "service")
LANE_WIDTH = 3.5
LEAST_LANES_WIDTH = 4.0
DEFAULT_WIDTH = 6.0
SMALL_AREA = 100.0
MEDIUM_AREA = 800.0


def size_bucket(area: Column) -> Column:
    """small below 100 square metres, medium below 800, else large."""
    return F.when(area < SMALL_AREA, "small").when(area < MEDIUM_AREA, "medium").otherwise("large")


def footprint(width_px: Column, height_px: Column, metres: float) -> Column:
    """Square metres of a rectangle of pixels of a size."""
    return width_px * metres * (height_px * metres)


def in_one_tile(corners: Column, size: float) -> Column:
    """Whether all corners (arrays of structs x, y) lie in the tile of the first one."""
    home = F.struct(F.floor(corners[0]["x"] / size).alias("x"), F.floor(corners[0]["y"] / size).alias("y"))
    return F.forall(corners, lambda p: (F.floor(p["x"] / size) == home["x"]) & (F.floor(p["y"] / size) == home["y"]))


def pixel_window(left: Column, bottom: Column, right: Column, top: Column, west: float, north: float, pixel: float, width: int, height: int) -> Column:
    """The pixels (col, row, width, height) that a box takes of a raster, cut to it; null where nothing is left."""
    inside = lambda v, n: F.least(F.greatest(F.rint(v).cast("long"), F.lit(0).cast("long")), F.lit(n).cast("long"))
    c0, c1 = inside((left - west) / pixel, width), inside((right - west) / pixel, width)
    r0, r1 = inside((north - top) / pixel, height), inside((north - bottom) / pixel, height)
    return F.when((c1 > c0) & (r1 > r0), F.struct(c0.alias("col"), r0.alias("row"), (c1 - c0).alias("width"), (r1 - r0).alias("height")))


def first_match(value: Column, table: tuple[tuple[str, object], ...]) -> Column:
    """The value beside the first key that occurs in the text; null if none does."""
    out, text = F.lit(None), value
    for key, result in reversed(table):
        out = F.when(text.contains(key), F.lit(result)).otherwise(out)
    return out


def road_surface(value: Column) -> Column:
    """asphalt for paved types, else dirt."""
    return F.coalesce(first_match(value, tuple((k, "asphalt") for k in PAVED)), F.lit("dirt"))


def road_width(width: Column, lanes: Column, kind: Column, table: tuple[tuple[str, float], ...] = ROAD_WIDTHS) -> Column:
    """The width tag (metres, comma or point), else lanes of 3.5 m but 4 m at least, else the type's width, else 6."""
    tagged = F.trim(F.regexp_replace(F.regexp_replace(width, "m", ""), ",", ".")).try_cast("double")
    by_lanes = F.greatest(F.split(lanes, ";").getItem(0).try_cast("int") * LANE_WIDTH, F.lit(LEAST_LANES_WIDTH))
    by_kind = F.lit(None).cast("double")
    for key, value in reversed(table):
        by_kind = F.when(kind == key, value).otherwise(by_kind)
    return F.coalesce(tagged, F.when(F.split(lanes, ";").getItem(0).try_cast("int").isNotNull(), by_lanes), by_kind, F.lit(DEFAULT_WIDTH))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where the bottom is 0."""
    return F.when(bottom != 0, top / F.when(bottom != 0, bottom)).otherwise(F.lit(0.0))


def to_byte(x: Column, low: Column, high: Column) -> Column:
    """A stretch of low..high to 0..255, cut off at the ends, truncated; an empty stretch counts as one unit wide."""
    top = F.when(high <= low, low + 1).otherwise(high)
    return (F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (top - low))) * 255).cast("int")


def hue_saturation_value(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue, saturation and value, each 0 to 1, of colours from 0 to 1; grey has hue 0."""
    top, bottom = F.greatest(r, g, b), F.least(r, g, b)
    span = top - bottom
    safe = F.when(span > 0, span)
    sector = F.when(top == r, (g - b) / safe).when(top == g, (b - r) / safe + 2).otherwise((r - g) / safe + 4) / 6
    return F.coalesce(sector - F.floor(sector), F.lit(0.0)), ratio(span, top), top


def soft_range(x: Column, low: Column, high: Column, soft: Column) -> Column:
    """1 inside low..high, falling to 0 over ``soft`` outside."""
    outside = F.greatest(low - x, x - high, F.lit(0.0))
    return F.when(soft > 0, F.greatest(F.lit(0.0), 1 - outside / F.when(soft > 0, soft))).otherwise((outside == 0).cast("double"))


def soft_hue(x: Column, centre: Column, width: Column, soft: Column) -> Column:
    """1 within ``width`` of a hue around the circle, falling to 0 over ``soft``."""
    away = F.abs(x - centre)
    return soft_range(F.least(away, 1 - away), F.lit(0.0), width, soft)


def depth_ratio(on_coast: Column, ratio_: Column, mask: Column) -> Column:
    """0 on the coast, else ten times the ratio under the mask (0 to 255), 0.1 to 1."""
    return F.when(on_coast, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.1), 10 * ratio_ * mask / 255)))


def altitude_scale(span: Column) -> Column:
    """Metres that sixteen bits of altitude span: the first of four steps that holds the tile's span."""
    # The format's four steps.
    return F.when(span < 771, 771).when(span < 1285, 1285).when(span < 4369, 4369).otherwise(13107)


def quad_string(unit: Column) -> Column:
    """Twenty-four binary digits of a place from 0 to 1 (exclusive)."""
    return F.lpad(F.bin(F.least((unit * (1 << 24)).cast("long"), F.lit((1 << 24) - 1).cast("long"))), 24, "0")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def second_of_two(a: Column, b: Column) -> Column:
    """Softmax share of the second of two scores."""
    return 1 / (1 + F.exp(a - b))


def bytes_text(n: Column) -> Column:
    """A size with one digit after the point and the largest unit that leaves 1 or more."""
    out = F.concat(F.format_string("%.1f", n / 1024.0**0), F.lit(" B"))
    for k, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024**k, F.concat(F.format_string("%.1f", n / float(1024**k)), F.lit(f" {unit}"))).otherwise(out)
    return out
