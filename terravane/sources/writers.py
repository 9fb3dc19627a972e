"""Writers: scenery text, JSON and CSV built as columns, and image bytes by kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import codecs


def network_text(roads: DataFrame, keys: list[str]) -> DataFrame:
    """A tile's road network as commands: (keys, text). ``roads`` has road, subtype, seq, lon, lat. A road begins at a
    junction, goes through shape points and ends at a junction; junctions are numbered in the tile from 1."""
    number = lambda c: F.format_string("%.9f", c)
    along, tile = Window.partitionBy(*keys, "road"), Window.partitionBy(*keys).orderBy("road", "seq")
    ends = roads.withColumns({"first": F.min("seq").over(along), "last": F.max("seq").over(along)}).where(F.col("first") != F.col("last"))
    place = ends.withColumn("end", (F.col("seq") == F.col("first")) | (F.col("seq") == F.col("last")))
    node = F.sum(F.col("end").cast("int")).over(tile)
    xyz = F.concat_ws(" ", number("lon"), number("lat"), F.lit("0.0"))
    line = F.when(F.col("seq") == F.col("first"), F.concat_ws(" ", F.lit("BEGIN_SEGMENT 0"), F.col("subtype").cast("string"), node.cast("string"), xyz)).when(F.col("seq") == F.col("last"), F.concat_ws(" ", F.lit("END_SEGMENT"), node.cast("string"), xyz)).otherwise(F.concat_ws(" ", F.lit("SHAPE_POINT"), xyz))
    rows = place.select(*keys, F.struct("road", "seq", line.alias("line")).alias("r"))
    # A degree tile's roads make one text, which is one value by the format.
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("text"))


def facade_text(buildings: DataFrame, keys: list[str]) -> DataFrame:
    """A tile's facades: definitions in the order of their names, then each building's ring (array of lon, lat) with the
    number of its facade and its height."""
    facade = F.dense_rank().over(Window.partitionBy(*keys).orderBy("facade")) - 1
    points = F.array_join(F.transform("ring", lambda p: F.format_string("POLYGON_POINT %.8f %.8f", p["lon"], p["lat"])), "\n")
    numbered = buildings.withColumn("n", facade)
    body = F.concat(F.format_string("BEGIN_POLYGON %d %d 2\nBEGIN_WINDING\n", F.col("n"), F.rint("height").cast("int")), points, F.lit("\nEND_WINDING\nEND_POLYGON"))
    rows = numbered.select(*keys, F.struct(F.lit(0).alias("kind"), F.col("n").cast("long").alias("at"), F.concat(F.lit("POLYGON_DEF "), "facade").alias("text")).alias("r")).distinct()
    rows = rows.unionByName(numbered.select(*keys, F.struct(F.lit(1).alias("kind"), F.col("id").cast("long").alias("at"), body.alias("text")).alias("r")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["text"]), "\n").alias("text"))


def join_overlays(definitions: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers of polygon definitions after overlays are put together: a layer's own number plus those of earlier layers."""
    layers = definitions.groupBy(*keys, "layer").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*keys).orderBy("layer").rowsBetween(Window.unboundedPreceding, -1)
    offset = layers.select(*keys, "layer", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return definitions.join(offset, [*keys, "layer"]).withColumn("joined", F.col("number") + F.col("offset")).drop("offset")


def drop_named(definitions: DataFrame, rules: list[str]) -> DataFrame:
    """Definitions (number, name) whose polygons are to go: a rule is a part of a name, or, after !, one that names must have."""
    hit = F.lit(False)
    for rule in rules:
        hit = hit | (~F.col("name").contains(rule[1:]) if rule.startswith("!") else F.col("name").contains(rule))
    return definitions.where(hit)


def drop_blocks(lines: DataFrame, begin: str, kinds: list[int]) -> DataFrame:
    """Lines (file, n, line) of scenery text without the blocks whose begin command has one of these types."""
    block = F.sum(F.col("line").startswith(begin).cast("int")).over(Window.partitionBy("file").orderBy("n"))
    kind = F.when(F.col("line").startswith(begin), F.split("line", r"\s+").getItem(1).try_cast("int"))
    marked = lines.withColumns({"block": block, "kind": kind})
    whole = marked.withColumn("kind", F.max("kind").over(Window.partitionBy("file", "block")))
    return whole.where((F.col("block") == 0) | ~F.coalesce(F.col("kind").isin(kinds), F.lit(False))).select("file", "n", "line")


def nested_json(df: DataFrame, keys: list[str], items: list[str], order: list[str], name: str) -> DataFrame:
    """(keys, json): a document for each key with its items as an ordered list and their number."""
    entry = F.struct(*order, F.struct(*items).alias("_item"))
    listed = df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_item"]).alias(name))
    return listed.select(*keys, F.to_json(F.struct(*keys, F.size(name).alias("total"), name)).alias("json"))


def metric_rows(df: DataFrame, section: str, notes: dict[str, str]) -> DataFrame:
    """One row of metrics as (section, metric, value, notes) rows."""
    long = df.unpivot([], df.columns, "metric", "value")
    note = F.lit("")
    for k, v in notes.items():
        note = F.when(F.col("metric") == k, v).otherwise(note)
    return long.select(F.lit(section).alias("section"), "metric", F.col("value").cast("double").alias("value"), note.alias("notes"))


def number_text(c: Column, decimals: int = 4) -> Column:
    """A number for a report, N/A where there is none."""
    return F.when(c.isNull() | F.isnan(c), "N/A").otherwise(F.format_string(f"%.{decimals}f", c))


def plain_number(value: float | None, decimals: int = 4) -> str:
    """The same for one number."""
    return "N/A" if value is None or value != value else str(value) if isinstance(value, int) else f"{value:.{decimals}f}"


def stamp(time: Column, file: bool = False) -> Column:
    """A time as reports show it, or as file names carry it."""
    return F.date_format(time, "yyyyMMdd_HHmmss" if file else "yyyy-MM-dd HH:mm:ss")


def write_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("errorifexists").option("header", True).csv(path)


def write_rows_csv(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """A report's rows as one CSV file, made by the driver; N/A where there is no number."""
    import csv
    import io

    from .vectors import write_text

    out = io.StringIO()
    table = csv.writer(out, lineterminator="\n")
    table.writerow(rows.columns)
    for r in rows.collect():
        table.writerow(["N/A" if v is None or v != v else v for v in r])
    write_text(spark, path, out.getvalue().encode())


def osm_rows(nodes: DataFrame, ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, lon, lat) and ways (id, refs, tags) as rows of XML elements, coordinates to seven places."""
    place = lambda c: F.format_string("%.7f", F.col(c).cast("double"))
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.struct(t["key"].alias("_k"), t["value"].alias("_v")))
    return nodes.select(F.col("id").alias("_id"), place("lat").alias("_lat"), place("lon").alias("_lon")), ways.select(F.col("id").alias("_id"), F.transform("refs", lambda r: F.struct(r.alias("_ref"))).alias("nd"), tags.alias("tag"))


def write_osm(nodes: DataFrame, ways: DataFrame, path: str) -> None:
    """Nodes and ways as XML elements, in folders of their names."""
    for name, rows in zip(("node", "way"), osm_rows(nodes, ways), strict=True):
        rows.write.format("xml").option("rowTag", name).option("rootTag", "osm").save(f"{path}/{name}")


def forest_text(forests: DataFrame, keys: list[str]) -> DataFrame:
    """A tile's forests: definitions in the order of their names, then each forest's shape (polygons of rings of lon, lat) with
    its definition's number and density (0 to 255); a winding for each ring."""
    number = F.dense_rank().over(Window.partitionBy(*keys).orderBy("forest")) - 1
    point = lambda p: F.format_string("POLYGON_POINT %.8f %.8f", p[0], p[1])
    winding = lambda ring: F.concat(F.lit("BEGIN_WINDING\n"), F.array_join(F.transform(F.slice(ring, F.lit(1), F.size(ring) - 1), point), "\n"), F.lit("\nEND_WINDING"))
    one = lambda polygon: F.array_join(F.transform(polygon, winding), "\n")
    named = forests.withColumn("n", number)
    body = F.array_join(F.transform("shape", lambda p: F.concat(F.format_string("BEGIN_POLYGON %d %d 2\n", F.col("n"), F.col("density").cast("int")), one(p), F.lit("\nEND_POLYGON"))), "\n")
    rows = named.select(*keys, F.struct(F.lit(0).alias("kind"), F.col("n").cast("long").alias("at"), F.concat(F.lit("POLYGON_DEF "), "forest").alias("text")).alias("r")).distinct()
    rows = rows.unionByName(named.select(*keys, F.struct(F.lit(1).alias("kind"), F.col("id").cast("long").alias("at"), body.alias("text")).alias("r")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["text"]), "\n").alias("text"))


def _images(kind: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grids = [np.array(v, float).reshape(-1, width) for v in batch["px"].to_pylist()]
            made = [codecs.write_png(g) if kind == "png" else codecs.write_heights(g) if kind == "heights" else codecs.write_tiff(g.astype(np.float32)[None]) for g in grids]
            yield pa.RecordBatch.from_arrays([batch["name"], pa.array(made, pa.binary())], ["name", "content"])

    return run


def image_bytes(tiles: DataFrame, kind: str, width: int) -> DataFrame:
    """(name, content) of tiles (name, px): files of kind png (pixels 0 to 255), tiff (single precision) or heights."""
    return tiles.select("name", F.col("px").cast("array<double>").alias("px")).mapInArrow(_images(kind, width), "name string, content binary")


def geojson(rings: DataFrame, key: str, ring: str) -> DataFrame:
    """A feature for each row: (key, json) of a polygon whose ring (array of x, y arrays) is closed."""
    closed = F.concat(F.col(ring), F.slice(ring, 1, 1))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col(key).alias(key)).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"))
    return rings.select(key, F.to_json(feature).alias("json"))
