"""Point operations on pixels as column expressions: depth, levels, contrast, saturation, ramps and transitions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cut(x: Column) -> Column:
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), x))


def from_uint16(x: Column) -> Column:
    """The upper eight of sixteen bits."""
    return F.floor(x / 256).cast("int")


def to_eight_bits(px: Column) -> Column:
    """A pixel array stretched from its least to its greatest value; all 0 where they are equal."""
    low, span = F.array_min(px), F.array_max(px) - F.array_min(px)
    return F.transform(px, lambda v: F.coalesce(((v - low) / F.when(span > 0, span) * 255).cast("int"), F.lit(0)))


def contrast(x: Column, brightness: float, factor: float) -> Column:
    """Brightness added and distance from mid grey multiplied, 0 to 255."""
    return _cut((x + brightness - 128) * factor + 128)


def saturate(r: Column, g: Column, b: Column, factor: float) -> tuple[Column, Column, Column]:
    """Each channel's distance from the grey of the same lightness multiplied."""
    grey = 0.299 * r + 0.587 * g + 0.114 * b
    return tuple(_cut(grey + (c - grey) * factor) for c in (r, g, b))


def levels(x: Column, low: float, gamma: float, high: float, out_low: float, out_high: float) -> Column:
    """Input range to output range with a gamma between."""
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / max(high - low, 1e-9)))
    return out_low + F.pow(share, 1 / gamma) * (out_high - out_low)


def red_green(x: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Red and green of a ramp from red at the low end to green at the high end, truncated."""
    span = high - low
    share = F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / F.when(span > 0, span))), F.lit(0.0))
    return ((1 - share) * 255).cast("int"), (share * 255).cast("int")


def density_byte(x: Column) -> Column:
    return (F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)) * 255).cast("int")


def transition(x: Column, profile: str) -> Column:
    """0 to 1 over a shore's width: linear, spline (flat at both ends) or parabolic (flat at the far end)."""
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
    if profile == "spline":
        return 3 * t * t - 2 * t * t * t
    if profile == "parabolic":
        return 2 * t - t * t
    if profile != "linear":
        raise ValueError("profile must be linear, spline or parabolic")
    return t


def rocky(x: Column, gamma: float = 2.5) -> Column:
    """A shore mask's bytes steepened by a tangent with a gamma."""
    return _cut(255 * F.pow(F.tan(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x / 255)) * math.pi / 4), gamma))
