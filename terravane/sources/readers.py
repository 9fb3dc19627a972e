"""Readers: text, JSON, XML and image files to rows. Spark finds and reads the files; schemas are fixed, not inferred."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUILDINGS = "tileBuildingsList array<struct<tile_x: int, tile_y: int, image_width: int, image_height: int, total_buildings: int, buildings: array<struct<id: int, center_x: double, center_y: double, width: double, height: double, rotation_degrees: double, confidence: double, class: string, corner_points: array<array<double>>>>>>"
SEGMENTS = "tiles array<struct<source_file: string, source_files: array<string>, group_id: string, crs_wkt: string, buildings: array<struct<id: int, confidence: double, area_px: double, polygon_wgs84: array<array<double>>>>>>"
ROADS = "tile_x int, tile_y int, width_m double, height_m double, roads array<struct<type: string, width_m: double, points: array<struct<u: double, v: double>>>>"
POSITIONS = "map<string, array<struct<x: double, y: double>>>"
TILES = "global_min_elevation double, global_max_elevation double, tiles array<struct<tile_x: int, tile_y: int, texture: string, heightmap: string, texture_width: int, texture_height: int, heightmap_width: int, heightmap_height: int, tile_max_height: double, ground_width_meters: double, ground_height_meters: double>>"


def buildings(spark: SparkSession, path: str) -> DataFrame:
    """Flat building rows of detector files."""
    tiles = spark.read.schema(BUILDINGS).option("multiLine", True).json(path).select(F.explode("tileBuildingsList").alias("t"))
    return tiles.select("t.tile_x", "t.tile_y", "t.image_width", "t.image_height", F.explode("t.buildings").alias("b")).select("tile_x", "tile_y", "image_width", "image_height", "b.*")


def segmentation(spark: SparkSession, path: str) -> DataFrame:
    """Flat object rows of segmentation files, of either layout: by image, or by group of images."""
    t = spark.read.schema(SEGMENTS).option("multiLine", True).json(path).select(F.explode("tiles").alias("t"))
    source = F.coalesce("t.source_file", F.array_join("t.source_files", "+"))
    return t.select(source.alias("source"), "t.group_id", F.explode("t.buildings").alias("b")).select("source", "group_id", "b.*")


def confident(objects: DataFrame, least: float) -> DataFrame:
    """Objects of a confidence and with a ring of three points at least, confidences to four places."""
    return objects.where((F.col("confidence") >= least) & (F.size("polygon_wgs84") >= 3)).withColumn("confidence", F.bround("confidence", 4))


def roads(spark: SparkSession, path: str) -> DataFrame:
    """A row for each point of each road of tile files, in order."""
    t = spark.read.schema(ROADS).option("multiLine", True).json(path)
    r = t.select("tile_x", "tile_y", F.posexplode("roads").alias("road", "r"))
    return r.select("tile_x", "tile_y", "road", "r.type", "r.width_m", F.posexplode("r.points").alias("seq", "p")).select("tile_x", "tile_y", "road", "type", "width_m", "seq", "p.u", "p.v")


def positions(spark: SparkSession, path: str) -> DataFrame:
    """A row for each tree of a file that maps tiles to positions."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", POSITIONS)).alias("tile", "trees"))
    return whole.select("tile", F.explode("trees").alias("p")).select("tile", "p.x", "p.y")


def tile_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row for each tile with the file's limits and the name by which assets are found."""
    m = spark.read.schema(TILES).option("multiLine", True).json(path)
    return m.select("global_min_elevation", "global_max_elevation", F.explode("tiles").alias("t")).select("global_min_elevation", "global_max_elevation", "t.*", F.concat_ws("_", "t.tile_x", "t.tile_y").alias("name"))


def frame_data(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, headers, values) of pipe-separated samples. The first line of each file names its columns; rows of another
    length or with a cell that is no number go. A file without lines has no rows."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    cells = whole.where("trim(text) != ''").select("file", "line", F.filter(F.transform(F.split("text", r"\|"), lambda x: F.trim(x)), lambda x: x != "").alias("cells"))
    first = cells.groupBy("file").agg(F.min_by("cells", "line").alias("headers"), F.min("line").alias("top"))
    rows = cells.join(first, "file").where((F.col("line") > F.col("top")) & (F.size("cells") == F.size("headers")))
    return rows.select("file", "line", "headers", F.transform("cells", lambda x: x.try_cast("double")).alias("values")).where(~F.exists("values", lambda x: x.isNull()))


def osm(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (id, lon, lat), ways (id, refs, tags) and relations (id, members, tags) of OSM XML. Nodes at one place share
    the smallest of their ids as ``first_id``."""
    tags = "tag array<struct<_k: string, _v: string>>"
    read = lambda row, schema: spark.read.format("xml").option("rowTag", row).schema(schema).load(path)
    as_map = F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast("array<struct<_k: string, _v: string>>")), lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v"))))
    nodes = read("node", "_id long, _lon double, _lat double").select(F.col("_id").alias("id"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))
    nodes = nodes.withColumn("first_id", F.min("id").over(Window.partitionBy("lon", "lat")))
    ways = read("way", f"_id long, nd array<struct<_ref: long>>, {tags}").select(F.col("_id").alias("id"), F.col("nd._ref").alias("refs"), as_map.alias("tags"))
    relations = read("relation", f"_id long, member array<struct<_type: string, _ref: long, _role: string>>, {tags}").select(F.col("_id").alias("id"), F.col("member").alias("members"), as_map.alias("tags"))
    return nodes, ways, relations


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, seq, lon, lat) of ways; references to nodes that are not there are left out."""
    refs = ways.select("id", F.posexplode("refs").alias("seq", "ref"))
    return refs.join(nodes.select(F.col("id").alias("ref"), "lon", "lat"), "ref").select("id", "seq", "lon", "lat")


def without_tags(ways: DataFrame, keys: list[str]) -> DataFrame:
    """Ways that have none of the keys."""
    return ways.where(~F.coalesce(F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, keys))), F.lit(False))) if keys else ways


def mesh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (file, id from 1, values: five numbers) and triangles (file, id, nodes, type) of mesh text files: a version line,
    the number of nodes, their lines, the number of triangles, their lines."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "").alias("lines"))
    counted = lines.withColumn("n", F.trim(F.col("lines")[1]).cast("int"))
    cells = lambda x: F.split(F.trim(x), r"\s+")
    nodes = counted.select("file", F.posexplode(F.slice("lines", F.lit(3), F.col("n"))).alias("at", "line"))
    faces = counted.select("file", F.posexplode(F.slice("lines", F.col("n") + 4, F.greatest(F.size("lines") - F.col("n") - 3, F.lit(0)))).alias("at", "line"))
    numbers = lambda t: F.transform(cells(F.col("line")), lambda x: x.cast(t))
    triangles = faces.select("file", (F.col("at") + 1).cast("long").alias("id"), numbers("long").alias("values"))
    return nodes.select("file", (F.col("at") + 1).cast("long").alias("id"), numbers("double").alias("values")), triangles.select("file", "id", F.slice("values", 1, 3).alias("nodes"), F.element_at("values", 4).alias("type"))


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """(file, id, values) of .node and .ele files: a line of counts, and a numbered line for each row; # begins a comment."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    cells = lines.withColumn("cells", F.filter(F.split(F.trim(F.regexp_replace("line", "#.*$", "")), r"\s+"), lambda x: x != "")).where(F.size("cells") > 0)
    first = cells.groupBy("file").agg(F.min("at").alias("top"))
    rows = cells.join(first, "file").where("at > top")
    return rows.select("file", F.col("cells")[0].cast("long").alias("id"), F.transform(F.slice("cells", F.lit(2), F.size("cells") - 1), lambda x: x.cast("double")).alias("values"))


def heights(spark: SparkSession, path: str, kind: str, side: int | None = None, fine: bool = False) -> DataFrame:
    """(path, lat, lon, height, width, px) of height files: hgt (big-endian, the first row in the north; ``fine`` brings 1201 a
    side to 3601), raw (little-endian, the last row first) or bytes (unsigned, the last row first, 0 to 1). A degree's name in
    the path, such as N37E036, gives its place; files that are no square are all 0, as is a missing tile."""
    from . import codecs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from ..functions import kernels

        for batch in batches:
            for file, data in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                n = side or int(round((len(data) // 2) ** 0.5))
                try:
                    if kind == "hgt":
                        grid = codecs.read_hgt(data, side)
                    elif kind == "raw":
                        grid = np.flipud(np.frombuffer(data, "<i2").reshape(n, n)).astype(np.float32)
                    else:
                        grid = codecs.read_heights(data, n, n)
                except ValueError:
                    grid = np.zeros((n, n))
                if fine and len(grid) == 1201:
                    grid = kernels.upsample(grid, 3)
                values = pa.array(np.ravel(grid).astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([grid.shape[0]], pa.int32()), pa.array([grid.shape[1]], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)], ["path", "height", "width", "px"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    out = files.mapInArrow(run, "path string, height int, width int, px array<double>")
    name = F.regexp_extract(F.upper("path"), r"([NS]\d{2}[EW]\d{3})", 1)
    degree = lambda a, b, minus: F.substring(name, a, b).try_cast("int") * F.when(F.substring(name, a - 1, 1) == minus, -1).otherwise(1)
    return out.select("path", degree(2, 2, "S").alias("lat"), degree(5, 3, "W").alias("lon"), "height", "width", "px")


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """(path, lat, lon, layer, suffix) of a tree of local data: root/<lat>/<lon>/<layer>.<suffix>; other files are left out."""
    pattern = r"/([+-]?\d+)/([+-]?\d+)/([a-z_]+)\.([a-z]+)$"
    part = lambda k: F.regexp_extract("path", pattern, k)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path").where(F.col("path").rlike(pattern))
    return files.select("path", part(1).cast("int").alias("lat"), part(2).cast("int").alias("lon"), part(3).alias("layer"), part(4).alias("suffix"))


def local_heights(px: Column, scale: Column, offset: Column, nodata: Column) -> Column:
    """A local elevation tile's pixels scaled and moved; nodata and the three values that often stand for it are -32768."""
    # What elevation files use for no data.
    void = lambda v: (v == nodata) | v.isin(32767.0, 65535.0, -9999.0)
    return F.transform(px, lambda v: F.when(F.coalesce(void(v), F.lit(False)), F.lit(-32768.0)).otherwise(v * scale + offset))


IMAGE = "path string, band int, row int, col int, height int, width int, transform array<double>, epsg int, nodata double, px array<double>"


def _decode(kind: str, tile: int | None, overlap: int, fill: float, decimate: int, bands: int | None):
    from . import codecs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = [x.split()[0] for x in IMAGE.split(", ")]
        for batch in batches:
            for path, data in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                if kind == "png":
                    image = codecs.read_png(data)
                    planes, where, epsg, nodata = (image[None] if image.ndim == 2 else image.transpose(2, 0, 1)), None, None, None
                else:
                    tiff = codecs.Tiff(data)
                    planes, where, epsg, nodata = tiff.pixels, tiff.transform(), tiff.epsg, tiff.nodata
                if bands == 3:
                    if len(planes) not in (1,) and len(planes) < 3:
                        raise ValueError(f"{path}: {len(planes)} bands are neither one nor three")
                    planes = planes[2::-1] if len(planes) >= 3 else planes  # blue first
                if decimate > 1:
                    planes = planes[:, ::decimate, ::decimate]
                    where = where and (*where[:2], where[2] * decimate, where[3] * decimate)
                height, width = planes.shape[1:]
                step = tile or max(height, width)
                for r in range(0, height, step):
                    for c in range(0, width, step):
                        h, w = (step + overlap,) * 2 if tile else (height, width)
                        at = where and [where[0] + c * where[2], where[1] - r * where[3], where[2], where[3]]
                        for k, p in enumerate(planes):
                            part = np.full((h, w), fill, float)
                            cut = p[r : r + h, c : c + w]
                            part[: cut.shape[0], : cut.shape[1]] = cut
                            values = pa.array(part.ravel())
                            columns = [[path], [k], [r], [c], [h], [w], [at], [epsg], [nodata]]
                            kinds = (pa.string(), *[pa.int32()] * 5, pa.list_(pa.float64()), pa.int32(), pa.float64())
                            yield pa.RecordBatch.from_arrays([*(pa.array(v, t) for v, t in zip(columns, kinds, strict=True)), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)], names)

    return run


def images(spark: SparkSession, path: str, kind: str, *, tile: int | None = None, overlap: int = 0, fill: float = 0.0, decimate: int = 1, bands: int | None = None) -> DataFrame:
    """A row for each band of PNG or GeoTIFF files (kind: png, tiff), or for each of their windows of ``tile`` pixels, which take
    ``overlap`` more to the right and below and hold ``fill`` beyond the image. ``decimate`` takes each so-manieth pixel.
    ``bands`` 3 asks for a colour image (blue first) or a single band, and raises ValueError for any other."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_decode(kind, tile, overlap, fill, decimate, bands), IMAGE)


def image_bounds(df: DataFrame) -> DataFrame:
    """``df`` with west, south, east and north of each row's window."""
    t = F.col("transform")
    return df.withColumns({"west": t[0], "north": t[1], "east": t[0] + F.col("width") * t[2], "south": t[1] - F.col("height") * t[3]})


def occupancy(tiles: DataFrame, images_: DataFrame, keys: list[str], width: int, height: int) -> DataFrame:
    """(keys, mask): whether any channel of a tile's image (keys, content) is set, 0 or 1 a pixel, by nearest pixels where sizes
    differ; all 0 where there is no image."""
    from . import codecs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [codecs.occupancy(x, width, height).astype("int32").ravel() for x in batch["content"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), pa.array([m.tolist() for m in masks], pa.list_(pa.int32()))], [*keys, "mask"])

    both = tiles.select(*keys).distinct().join(images_.select(*keys, "content"), keys, "left")
    kinds = dict(both.dtypes)
    return both.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "mask array<int>"]))
