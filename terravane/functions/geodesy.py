"""Geodesy, tile arithmetic and names as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The earth's radius throughout, and metres a degree as the road exporters count them.
EQUATOR_RADIUS = 6378137.0
METRES_PER_LON = 111320.0
METRES_PER_LAT = 110540.0
TILE_PIXELS = 256


def degrees_to_metres(lat: Column, dlon: Column, dlat: Column) -> tuple[Column, Column]:
    """East and north metres of a small step in degrees at a latitude."""
    per_degree = math.pi * EQUATOR_RADIUS / 180
    return dlon * per_degree * F.cos(F.radians(lat)), dlat * per_degree


def road_metres(lat: Column, dlon: Column, dlat: Column) -> tuple[Column, Column]:
    """The same by the factors of the road exporters."""
    return dlon * METRES_PER_LON * F.cos(F.radians(lat)), dlat * METRES_PER_LAT


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EQUATOR_RADIUS * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def mercator_pixel_size(lat: Column, zoom: Column) -> Column:
    """Metres of a web-mercator pixel at a latitude."""
    return F.lit(2 * math.pi * EQUATOR_RADIUS / TILE_PIXELS) * F.cos(F.radians(lat)) / F.pow(F.lit(2.0), zoom)


def _unit_x(lon: Column) -> Column:
    return (lon + 180) / 360


def _unit_y(lat: Column) -> Column:
    s = F.radians(lat)
    return (1 - F.log(F.tan(s) + 1 / F.cos(s)) / math.pi) / 2


def lat_lon_to_pixel(lat: Column, lon: Column, zoom: Column) -> tuple[Column, Column]:
    """Pixel of a place, rounded half to even."""
    size = F.pow(F.lit(2.0), zoom) * TILE_PIXELS
    return F.rint(_unit_x(lon) * size).cast("long"), F.rint(_unit_y(lat) * size).cast("long")


def lat_lon_to_tile(lat: Column, lon: Column, zoom: Column) -> tuple[Column, Column]:
    """Tile of a place."""
    x, y = lat_lon_to_pixel(lat, lon, zoom)
    return F.floor(x / TILE_PIXELS), F.floor(y / TILE_PIXELS)


def lat_lon_to_orthogrid(lat: Column, lon: Column, zoom: Column) -> tuple[Column, Column]:
    """First tile of the block of 16 by 16 tiles that holds a place."""
    cells = F.pow(F.lit(2.0), zoom - 4)
    return (_unit_x(lon) * cells).cast("long") * 16, (_unit_y(lat) * cells).cast("long") * 16


def tile_to_lat_lon(x: Column, y: Column, zoom: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a tile's north-west corner; fractions of tiles are allowed."""
    n = F.pow(F.lit(2.0), zoom)
    return F.degrees(2 * F.atan(F.exp(F.lit(math.pi) * (1 - 2 * y / n))) - math.pi / 2), x / n * 360 - 180


def quadkey(x: Column, y: Column, zoom: Column) -> Column:
    """A digit for each level from the coarsest: 1 for east plus 2 for south."""
    digit = lambda level: (F.expr("0") + F.call_function("mod", F.floor(x / F.pow(F.lit(2.0), level)), F.lit(2)) + 2 * F.call_function("mod", F.floor(y / F.pow(F.lit(2.0), level)), F.lit(2))).cast("int").cast("string")
    return F.when(zoom < 1, F.lit("")).otherwise(F.concat_ws("", F.transform(F.sequence(zoom - 1, F.lit(0), F.lit(-1)), digit)))


def texture_coordinate(lat: Column, lon: Column, x: Column, y: Column, zoom: Column) -> tuple[Column, Column]:
    """Place in a texture of 16 by 16 tiles that begins at tile (x, y); 0 to 1, south to north."""
    n = F.pow(F.lit(2.0), zoom)
    inside = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return inside((_unit_x(lon) * n - x) / 16), inside(1 - (_unit_y(lat) * n - y) / 16)


def affine_to_world(col: Column, row: Column, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of a pixel by the six numbers of an affine transform, to eight places half to even."""
    return F.bround(d * col + e * row + f, 8), F.bround(a * col + b * row + c, 8)


def to_mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Metres east and north in EPSG:3857."""
    s = F.radians(lat)
    return F.radians(lon) * EQUATOR_RADIUS, F.log(F.tan(s) + 1 / F.cos(s)) * EQUATOR_RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude of EPSG:3857 metres."""
    return F.degrees(2 * F.atan(F.exp(y / EQUATOR_RADIUS)) - math.pi / 2), F.degrees(x / EQUATOR_RADIUS)


# Third flattening series of WGS84 for the transverse mercator projection (Krueger, to the third order).
UTM_SCALE = 0.9996
UTM_FALSE_EAST = 500000.0
WGS84_FLATTENING = 1 / 298.257223563


def _krueger() -> tuple[float, tuple, tuple, tuple]:
    """The meridian's radius and the coefficients of the series to the plane, back, and to the latitude."""
    n = WGS84_FLATTENING / (2 - WGS84_FLATTENING)
    radius = EQUATOR_RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    there = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    back = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    latitude = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    return radius, there, back, latitude


def to_utm(lat: Column, lon: Column, zone: int) -> tuple[Column, Column]:
    """East and north metres in a northern UTM zone, by Krueger's series; good to a millimetre inside the zone."""
    radius, alpha, _, _ = _krueger()
    n = WGS84_FLATTENING / (2 - WGS84_FLATTENING)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, away = F.radians(lat), F.radians(lon - (6 * zone - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for k, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        north = north + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return UTM_FALSE_EAST + UTM_SCALE * radius * east, UTM_SCALE * radius * north


def from_utm(east: Column, north: Column, zone: int) -> tuple[Column, Column]:
    """Latitude and longitude of a northern UTM zone's metres, by the same series turned round."""
    radius, _, back, latitude = _krueger()
    xi0, eta0 = north / (UTM_SCALE * radius), (east - UTM_FALSE_EAST) / (UTM_SCALE * radius)
    xi, eta = xi0, eta0
    for k, b in enumerate(back, 1):
        xi = xi - b * F.sin(2 * k * xi0) * F.cosh(2 * k * eta0)
        eta = eta - b * F.cos(2 * k * xi0) * F.sinh(2 * k * eta0)
    conformal = F.asin(F.sin(xi) / F.cosh(eta))
    lat = conformal
    for k, d in enumerate(latitude, 1):
        lat = lat + d * F.sin(2 * k * conformal)
    return F.degrees(lat), 6 * zone - 183 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """A place (x east or longitude, y north or latitude) from one coordinate system to another: EPSG 4326, 3857 and the
    UTM zones 32601 to 32660 and 32701 to 32760; any other one raises ValueError."""
    def utm(epsg: int) -> tuple[int, float]:
        if not (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
            raise ValueError(f"EPSG:{epsg} is not known")
        return epsg % 100, 10_000_000.0 if epsg > 32700 else 0.0

    if source == target:
        return x, y
    if source == 4326:
        lat, lon = y, x
    elif source == 3857:
        lat, lon = from_mercator(x, y)
    else:
        zone, south = utm(source)
        lat, lon = from_utm(x, y - south, zone)
    if target == 4326:
        return lon, lat
    if target == 3857:
        return to_mercator(lat, lon)
    zone, south = utm(target)
    east, north = to_utm(lat, lon, zone)
    return east, north + south


def _signed(value: Column, digits: int) -> Column:
    whole = F.floor(value).cast("int")
    return F.concat(F.when(whole < 0, "-").otherwise("+"), F.lpad(F.abs(whole).cast("string"), digits, "0"))


def tile_name(lat: Column, lon: Column) -> Column:
    """Name of the degree tile, such as +37+036."""
    return F.concat(_signed(lat, 2), _signed(lon, 3))


def folder_name(lat: Column, lon: Column) -> Column:
    """Name of the folder of ten by ten degrees."""
    return F.concat(_signed(F.floor(lat / 10) * 10, 2), _signed(F.floor(lon / 10) * 10, 3))


def hemisphere_name(lat: Column, lon: Column) -> Column:
    """Name of the degree tile by hemispheres, such as N37E036."""
    a, b = F.floor(lat).cast("int"), F.floor(lon).cast("int")
    return F.concat(F.when(a < 0, "S").otherwise("N"), F.lpad(F.abs(a).cast("string"), 2, "0"), F.when(b < 0, "W").otherwise("E"), F.lpad(F.abs(b).cast("string"), 3, "0"))


def tile_path(lat: Column, lon: Column, suffix: str = ".dsf") -> Column:
    """Path of a degree tile's file below its folder."""
    return F.concat(F.concat_ws("/", folder_name(lat, lon), tile_name(lat, lon)), F.lit(suffix))


# What kinds of files of a tile are called, after "Data" and the tile's name, or after the grid's name.
TILE_FILES = {"nodes": ".node", "polygons": ".poly", "triangles": ".ele", "altitudes": ".alt", "airports": ".apt", "weights": ".weight", "mesh": ".mesh"}
HEIGHT_FILES = {"view": ".hgt", "srtm": "_SRTMv3.hgt", "srtm1": "_SRTM_1sec.hgt", "alos": "_ALOS3W30.tif", "ned1": "_NED1.tif", "ned13": "_NED13.tif", "generic": ".tif"}
TILE_FOLDER = "zRIDGE4XP_"


def build_folder(root: str, lat: Column, lon: Column) -> Column:
    """Folder in which a degree tile is built."""
    return F.concat(F.lit(f"{root.rstrip('/')}/{TILE_FOLDER}"), tile_name(lat, lon))


def build_file(folder: Column, lat: Column, lon: Column, kind: str, step: int = 0) -> Column:
    """A tile's file of a kind in its folder; files of later steps carry the step's number."""
    return F.concat(folder, F.lit("/Data"), tile_name(lat, lon), F.lit((f".{step}" if step else "") + TILE_FILES[kind]))


def height_file(root: str, lat: Column, lon: Column, source: str) -> Column:
    """Path of a source's elevation of a degree, below the folder of ten by ten degrees."""
    return F.concat(F.lit(root.rstrip("/") + "/"), folder_name(lat, lon), F.lit("/"), hemisphere_name(lat, lon), F.lit(HEIGHT_FILES[source]))


def cached_file(root: str, lat: Column, lon: Column, layer: str) -> Column:
    """Path of a degree's stored features of a layer."""
    return F.concat(F.lit(root.rstrip("/") + "/"), folder_name(lat, lon), F.lit("/"), tile_name(lat, lon), F.lit("/"), tile_name(lat, lon), F.lit(f"_{layer}.osm.bz2"))


def mask_file(x: Column, y: Column, zoom: Column | None = None, distance: bool = False) -> Column:
    """Name of a mask by its tile's corner, row first; distance masks say so."""
    name = F.concat_ws("_", y.cast("string"), x.cast("string"))
    tail = F.concat(F.lit("_ZL"), zoom.cast("string")) if zoom is not None else F.lit("")
    return F.concat(name, tail, F.lit("_dist.png" if distance else ".png"))


def building_height(longest_m: Column, given: Column) -> Column:
    """Given height, or 3.5 m for each storey: one for each ten metres of the longest side, 1 to 12, half to even."""
    return F.coalesce(given, F.least(F.lit(12.0), F.greatest(F.lit(1.0), F.rint(longest_m / 10))) * 3.5)


def unit_position(x: Column, low: Column, high: Column, digits: int = 6) -> Column:
    """Place between two limits, 0 to 1, rounded half to even; 0 where the limits are equal."""
    span = high - low
    return F.bround(F.least(F.greatest(F.when(span != 0, (x - low) / F.when(span != 0, span)).otherwise(0.0), F.lit(0.0)), F.lit(1.0)), digits)
