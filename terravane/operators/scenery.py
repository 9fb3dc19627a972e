"""Scenery planning: lookups, quadtrees, tile plans, neighbours and meshes as joins and expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _lineage
from ._order import by_ranges, running
from .spatial import box_join, connected, intersection_area


def nearest(values: DataFrame, value: str, nodes: DataFrame, node: str) -> DataFrame:
    """Each value with the place (from 0) of the nearest of sorted distinct nodes, the lower of two as near; null without
    nodes. Values and nodes are sorted together by ranges; a range looks at its own nodes and the ones beside it."""
    ranked = running(nodes.select(F.col(node).cast("double").alias("at")).where("at is not null").distinct().withColumn("one", F.lit(1).cast("long")), ["at"], "one", "idx").select("at", "idx")
    both = values.select(F.col(value).cast("double").alias("at"), F.lit(None).cast("long").alias("idx")).distinct().unionByName(ranked)
    ranged = by_ranges(both, ["at"])
    held = ranged.where("idx is not null").groupBy(F.col("_part").alias("p")).agg(F.min("idx").alias("i0"), F.min("at").alias("a0"), F.max("idx").alias("i1"), F.max("at").alias("a1")).orderBy("p").collect()  # a row for each task

    def found(table: pa.Table, own: int) -> pa.RecordBatch:
        before = [(r["a1"], r["i1"]) for r in held if r["p"] < own][-1:]
        after = [(r["a0"], r["i0"]) for r in held if r["p"] > own][:1]
        is_node = table["idx"].is_valid().to_numpy()
        asked = table.filter(pa.array(~is_node))["at"].combine_chunks()
        places = np.array([*(a for a, _ in before), *table["at"].to_numpy()[is_node], *(a for a, _ in after)])
        numbers = np.array([*(i for _, i in before), *table["idx"].drop_null().to_numpy(), *(i for _, i in after)], np.int64)
        order = np.argsort(places, kind="stable")
        places, numbers, v = places[order], numbers[order], asked.to_numpy(zero_copy_only=False)
        if not len(places):
            return pa.RecordBatch.from_arrays([asked, pa.nulls(len(asked), pa.int64())], [value, "idx"])
        high = np.minimum(np.searchsorted(places, v), len(places) - 1)
        low = np.maximum(high - 1, 0)
        picked = np.where(np.abs(v - places[low]) <= np.abs(places[high] - v), numbers[low], numbers[high])
        return pa.RecordBatch.from_arrays([asked, pa.array(picked, mask=asked.is_null().to_numpy(zero_copy_only=False))], [value, "idx"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        for own in pc.unique(table["_part"]).to_pylist():
            yield found(table.filter(pc.equal(table["_part"], own)), own)

    return ranged.mapInArrow(run, f"`{value}` double, idx long")


def quadtree(points: DataFrame, x: str, y: str, capacity: int, depth: int = 24) -> tuple[DataFrame, DataFrame]:
    """(points with their cell and depth, cells with depth and size): cells are split in four while they hold more points
    than the capacity. Points are counted at the finest cells first; rounds then work on these counts alone, so a crowded
    upper cell is a sum and never a task's rows."""
    from ..functions.features import quad_string

    marked = points.withColumns({"_x": quad_string(F.col(x)), "_y": quad_string(F.col(y))})
    open_ = _lineage.settle(marked.groupBy("_x", "_y").agg(F.count("*").alias("_n")))
    done = None
    for level in range(depth + 1):
        named = open_.withColumn("cell", F.concat_ws("/", F.substring("_x", 1, level), F.substring("_y", 1, level)))
        sizes = named.groupBy("cell").agg(F.sum("_n").alias("size"))
        full = (F.col("size") > capacity) & F.lit(level < depth)
        placed = named.join(sizes, "cell")
        here = placed.where(~full).select("_x", "_y", "_n", "cell", F.lit(level).alias("depth"), "size")
        done = here if done is None else done.unionByName(here)
        open_ = _lineage.settle(placed.where(full).select("_x", "_y", "_n"))
        if open_.isEmpty():
            break
    done = _lineage.settle(done)
    return marked.join(done.select("_x", "_y", "cell", "depth"), ["_x", "_y"]).drop("_x", "_y"), done.select("cell", "depth", "size").distinct()


def quadtree_figures(cells: DataFrame) -> DataFrame:
    """One row: buckets, their mean depth and size, and the greatest depth."""
    return cells.agg(F.count("*").alias("buckets"), F.avg("depth").alias("mean_depth"), F.avg("size").alias("mean_size"), F.max("depth").alias("max_depth"))


def neighbours(tiles: DataFrame, x: str, y: str) -> DataFrame:
    """Each tile with those of its eight neighbours that are there, as (x, y, near_x, near_y)."""
    step = F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b))
    asked = tiles.select(x, y).distinct().withColumn("s", F.explode(step)).select(x, y, (F.col(x) + F.col("s.dx")).alias("near_x"), (F.col(y) + F.col("s.dy")).alias("near_y"))
    held = tiles.select(F.col(x).alias("near_x"), F.col(y).alias("near_y")).distinct()
    return asked.join(held, ["near_x", "near_y"], "left_semi").select(x, y, "near_x", "near_y")


def mask_tiles(x: Column, y: Column) -> Column:
    """Mask tiles that a place inside a tile (0 to 4 along both sides) concerns: its own, and in the outer quarters the
    tile beyond."""
    a, b = F.least(F.floor(x), F.lit(3)), F.least(F.floor(y), F.lit(3))
    side = lambda c: F.when(c == 0, F.array(F.lit(0), F.lit(-1))).when(c == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return F.flatten(F.transform(side(a), lambda i: F.transform(side(b), lambda j: F.struct(i.alias("dx"), j.alias("dy")))))


def slices(width: Column, height: Column, size: int) -> Column:
    """Names and pixel offsets of the tiles that cover an image, the last ones reaching beyond it."""
    rows, cols = (F.sequence(F.lit(0).cast("long"), F.ceil(n / size) - 1) for n in (height, width))
    return F.flatten(F.transform(rows, lambda r: F.transform(cols, lambda c: F.struct((r * size).alias("row"), (c * size).alias("col"), F.concat_ws("_", F.lit("tile"), (r * size).cast("string"), (c * size).cast("string")).alias("name")))))


def finest(levels: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each asked resolution the coarsest level (zoom, resolution) that is fine enough, 1.1 times what was asked at
    most; levels are the few of a tile pyramid."""
    pairs = wanted.join(F.broadcast(levels.where("zoom between 0 and 30")), F.col("resolution") <= 1.1 * F.col("asked"))
    return pairs.groupBy(*wanted.columns).agg(F.max_by("zoom", "resolution").alias("zoom"))


def with_parents(tiles: DataFrame, held: DataFrame, up: int = 5) -> DataFrame:
    """Each tile (x, y, zoom) with the first ancestor that is held, itself first: (levels up, quadrant x and y in it).
    Tiles without one within ``up`` levels have nulls. One join on all ancestors' keys."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(up)))
    asked = tiles.withColumn("levels", steps).withColumn("n", F.pow(F.lit(2), "levels").cast("long"))
    keyed = asked.select("x", "y", "zoom", "levels", "n", F.floor(F.col("x") / F.col("n")).alias("px"), F.floor(F.col("y") / F.col("n")).alias("py"), (F.col("zoom") - F.col("levels")).alias("pz"))
    found = keyed.join(held.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("zoom").alias("pz")).distinct(), ["px", "py", "pz"])
    first = found.groupBy("x", "y", "zoom").agg(F.min(F.struct("levels", (F.col("x") - F.col("px") * F.col("n")).alias("qx"), (F.col("y") - F.col("py") * F.col("n")).alias("qy"))).alias("f"))
    return tiles.join(first, ["x", "y", "zoom"], "left").select("x", "y", "zoom", "f.levels", "f.qx", "f.qy")


def triangle_textures(triangles: DataFrame, textures: DataFrame, size: float) -> DataFrame:
    """Triangles (id, x1..y3) with the texture (cell_x, cell_y, texture) of the cell of their barycentre."""
    cell = lambda a: F.floor((F.col(f"{a}1") + F.col(f"{a}2") + F.col(f"{a}3")) / 3 / size)
    return triangles.withColumns({"cell_x": cell("x"), "cell_y": cell("y")}).join(textures, ["cell_x", "cell_y"], "left")


def blend(samples: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean of overlapping predictions of a pixel; 0 where there is none."""
    return samples.groupBy(*keys).agg((F.sum(F.coalesce(value, F.lit(0.0))) / F.greatest(F.count(value), F.lit(1))).alias(value))


def large_lakes(areas: DataFrame, name: str, square_km: str, most: float, kept_names: list[str]) -> DataFrame:
    """Adds ``masked``: lakes of at least so many square kilometres, unless their name is listed."""
    listed = F.coalesce(F.col(name).isin(kept_names), F.lit(False)) if kept_names else F.lit(False)
    return areas.withColumn("masked", F.coalesce(F.col(square_km) >= most, F.lit(False)) & ~listed)


def coordinates(text: Column) -> Column:
    """(lat, lon) of "lat,lon" text within -90..90 and -180..180; null for anything else."""
    parts = F.split(text, ",")
    lat, lon = (F.trim(parts.getItem(k)).try_cast("double") for k in (0, 1))
    good = (F.size(parts) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(good, F.struct(lat.alias("lat"), lon.alias("lon")))


def tile_degrees(lat: Column, lon: Column) -> Column:
    """Whether whole degrees name a tile: latitude -90 to 89, longitude -180 to 179."""
    return lat.between(-90, 89) & lon.between(-180, 179)


def needs_mask(px: Column) -> Column:
    return F.coalesce(F.array_max(px) > 30, F.lit(False))


def power_of_two(n: Column) -> Column:
    return (n > 0) & (n.bitwiseAND(n - 1) == 0)


def fill_ratio(area: Column, width: Column, height: Column, least: float, least_area: float = 400.0) -> Column:
    """Whether a contour fills enough of its rectangle and is large enough."""
    box = width * height
    return F.coalesce((area >= least_area) & (area / F.when(box > 0, box) >= least), F.lit(False))


def vertex_steps(points: DataFrame, line: str, order: list[str]) -> DataFrame:
    """Vertices (x, y) of lines without those that repeat the one before, with their number from 1 along the line and the
    length of the step to each (null for the first)."""
    w = Window.partitionBy(line).orderBy(*order)
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    return points.withColumns({"seq": F.row_number().over(w).cast("long"), "step": step}).where("step is null or step > 0")


def edge_markers(edges: DataFrame, marker: Column) -> DataFrame:
    """(a, b, marker) of edges (a, b) between different nodes, each once whichever way it runs, its markers put together."""
    kept = edges.where("a != b")
    return kept.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.bit_or(marker).alias("marker"))


def densify(lines: DataFrame, keys: list[str], order: str, step: float) -> DataFrame:
    """Points every ``step`` along a line (x, y), corners kept: (keys, order, part, x, y)."""
    w = Window.partitionBy(*keys).orderBy(order)
    ahead = lines.withColumns({"x2": F.lead("x").over(w), "y2": F.lead("y").over(w)})
    n = F.coalesce(F.greatest(F.ceil(F.hypot(F.col("x2") - F.col("x"), F.col("y2") - F.col("y")) / step) - 1, F.lit(0)), F.lit(0))
    cut = ahead.withColumn("n", n).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    t = F.col("part") / (F.col("n") + 1)
    return cut.select(*keys, order, "part", (F.col("x") + F.coalesce(t * (F.col("x2") - F.col("x")), F.lit(0.0))).alias("x"), (F.col("y") + F.coalesce(t * (F.col("y2") - F.col("y")), F.lit(0.0))).alias("y"))


def recut(triangles: DataFrame, coast: DataFrame) -> DataFrame:
    """Water triangles (id, a, b, c) against coast edges (u < v): id, the number of the triangle's coast edges (cuts), and the
    parts it is cut into: 1, 2, 3 or 6."""
    edge = lambda p, q: F.struct(F.least(p, q).alias("u"), F.greatest(p, q).alias("v"))
    edges = triangles.select("id", F.explode(F.array(edge("a", "b"), edge("b", "c"), edge("c", "a"))).alias("e")).select("id", "e.u", "e.v")
    hit = edges.join(coast.select("u", "v").distinct(), ["u", "v"]).groupBy("id").agg(F.count("*").alias("cuts"))
    out = triangles.join(hit, "id", "left").select("id", F.coalesce("cuts", F.lit(0)).alias("cuts"))
    return out.withColumn("parts", F.element_at(F.array(*map(F.lit, (1, 2, 3, 6))), (F.col("cuts") + 1).cast("int")))


def recut_triangles(triangles: DataFrame, coast: DataFrame) -> DataFrame:
    """(id, part, corners) of the triangles that ``recut`` counts. Corners are arrays of node ids: one id is the node, two the
    middle of an edge, three the barycentre. One coast edge is halved; of two, the corner between them is cut off by both
    middles and the rest is halved; three make six parts around the barycentre."""
    flag = lambda p, q: F.exists("coast", lambda e: (e["u"] == F.least(p, q)) & (e["v"] == F.greatest(p, q)))
    near = triangles.select("id", "a", "b", "c", F.explode(F.array(F.struct(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")), F.struct(F.least("b", "c").alias("u"), F.greatest("b", "c").alias("v")), F.struct(F.least("a", "c").alias("u"), F.greatest("a", "c").alias("v")))).alias("e")).select("id", "e.u", "e.v")
    hits = near.join(coast.select("u", "v").distinct(), ["u", "v"]).groupBy("id").agg(F.collect_list(F.struct("u", "v")).alias("coast"))
    all_ = triangles.join(hits, "id", "left").withColumn("coast", F.coalesce("coast", F.array().cast("array<struct<u: bigint, v: bigint>>")))
    ab, bc, ca = flag(F.col("a"), F.col("b")), flag(F.col("b"), F.col("c")), flag(F.col("c"), F.col("a"))
    # Turned so that a single coast edge is the first one, and of two coast edges the first two are meant.
    turn = F.when((~ab & bc & ~ca) | (bc & ca & ~ab), 1).when((~ab & ~bc & ca) | (ca & ab & ~bc), 2).otherwise(0)
    p, q, r = (F.element_at(F.array("a", "b", "c"), F.pmod(turn + k, F.lit(3)) + 1) for k in range(3))
    node = lambda *xs: F.array_sort(F.array(*xs))
    tri = lambda *xs: F.array(*xs)
    n = ab.cast("int") + bc.cast("int") + ca.cast("int")
    P, Q, R, PQ, QR, RP, M = node(p), node(q), node(r), node(p, q), node(q, r), node(r, p), node(p, q, r)
    whole, halves = F.array(tri(P, Q, R)), F.array(tri(P, PQ, R), tri(PQ, Q, R))
    three = F.array(tri(PQ, Q, QR), tri(P, PQ, QR), tri(P, QR, R))
    six = F.array(tri(P, PQ, M), tri(PQ, Q, M), tri(Q, QR, M), tri(QR, R, M), tri(R, RP, M), tri(RP, P, M))
    parts = F.when(n == 0, whole).when(n == 1, halves).when(n == 2, three).otherwise(six)
    return all_.select("id", F.posexplode(parts).alias("part", "corners"))


def merge_overlapping(boxes: DataFrame, cell: float) -> DataFrame:
    """(id, root) of boxes that overlap directly or through others; root is the smallest id of the group."""
    pairs = box_join(boxes, boxes, cell).where((F.col("id") < F.col("r_id")) & (intersection_area() > 0))
    return connected(boxes, pairs.select(F.col("id").alias("a"), F.col("r_id").alias("b")))


def weight_map(rectangles: DataFrame, side: int, base: float) -> DataFrame:
    """(row, col, weight) of the nodes that rectangles (row0, row1, col0, col1, weight; both ends in) cover: the greatest
    weight; nodes outside all have ``base``, and are not listed."""
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), F.lit(side - 1))
    rows = rectangles.withColumn("row", F.explode(F.sequence(inside("row0"), inside("row1")))).withColumn("col", F.explode(F.sequence(inside("col0"), inside("col1"))))
    return rows.groupBy("row", "col").agg(F.greatest(F.max("weight"), F.lit(base)).alias("weight"))


def ortho_lines(tiles: DataFrame, zoom: int) -> DataFrame:
    """(lat, lon, axis, n, at) of the texture grid's lines inside each degree tile: axis x at longitudes, y at latitudes,
    every 16 tiles of the zoom; ``at`` is the place in the tile, 0 to 1, to nine places."""
    from ..functions.geodesy import lat_lon_to_orthogrid, tile_to_lat_lon

    z = F.lit(zoom)
    west, north = lat_lon_to_orthogrid(F.col("lat") + 1.0, F.col("lon") + 0.0, z)
    east, south = lat_lon_to_orthogrid(F.col("lat") + 0.0, F.col("lon") + 1.0, z)
    lines = lambda axis, a, b: tiles.select("lat", "lon", F.lit(axis).alias("axis"), F.explode(F.sequence(a, b, F.lit(16).cast("long"))).alias("n"))
    both = lines("x", west, east).unionByName(lines("y", north, south))
    place_lat, place_lon = tile_to_lat_lon(F.col("n"), F.col("n"), z)
    at = F.when(F.col("axis") == "x", place_lon - F.col("lon")).otherwise(place_lat - F.col("lat"))
    return both.withColumn("at", F.bround(at, 9)).where("at >= 0 and at <= 1")


def stitch_rings(ways: DataFrame) -> DataFrame:
    """(relation, ring, closed) of ways (relation, way, first, last: node ids): ways that share end nodes form rings. A
    ring is closed if every end node in it is met twice; relations whose ends do not pair have open rings. At each node
    ways are linked to the smallest one there, so a node of many ways makes no more links than it has ways."""
    ends = ways.select("relation", "way", F.explode(F.array("first", "last")).alias("node"))
    least = ends.groupBy("relation", "node").agg(F.min("way").alias("a"))
    links = ends.join(least, ["relation", "node"]).select("relation", "a", F.col("way").alias("b")).where("a != b").distinct()
    root = connected(ways.select("relation", F.col("way").alias("id")), links, ("relation",)).select("relation", F.col("id").alias("way"), F.col("root").alias("ring"))
    met = ends.join(root, ["relation", "way"]).groupBy("relation", "ring", "node").agg(F.count("*").alias("n"))
    return met.groupBy("relation", "ring").agg(F.bool_and(F.col("n") % 2 == 0).alias("closed"))


def ring_points(ways: DataFrame, points: DataFrame) -> DataFrame:
    """(relation, ring, points) of the closed rings of ways (relation, way, first, last) whose points (way, seq, lon, lat) are
    known: each ring's ways one after the other, turned where needed. A ring is one value by its nature."""
    closed = stitch_rings(ways).where("closed")
    ends = ways.select("relation", "way", F.explode(F.array("first", "last")).alias("node"))
    least = ends.groupBy("relation", "node").agg(F.min("way").alias("a"))
    links = ends.join(least, ["relation", "node"]).select("relation", "a", F.col("way").alias("b")).where("a != b").distinct()
    root = connected(ways.select("relation", F.col("way").alias("id")), links, ("relation",)).select("relation", F.col("id").alias("way"), F.col("root").alias("ring"))
    lines = points.groupBy("way").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"])).alias("line"))
    parts = ways.join(root, ["relation", "way"]).join(closed, ["relation", "ring"], "left_semi").join(lines, "way")
    rings = parts.groupBy("relation", "ring").agg(F.array_sort(F.collect_list(F.struct("way", "first", "last", "line"))).alias("parts"))

    def kernel(held: list) -> tuple:
        left, out = [dict(p.items()) if isinstance(p, dict) else p for p in held], []
        at = left[0]["first"]
        while left:
            pick = next((p for p in left if at in (p["first"], p["last"])), None)
            if pick is None:
                return (None,)
            left.remove(pick)
            line = pick["line"] if pick["first"] == at else pick["line"][::-1]
            at = pick["last"] if pick["first"] == at else pick["first"]
            out.extend(line if not out else line[1:])
        return (out,)

    from .tile_kernels import map_rows

    return map_rows(rings, ["parts"], kernel, "points array<array<double>>", ["relation", "ring"]).where("points is not null")


def node_levels(nodes: DataFrame, water: str, sea: str, mode: str = "zero") -> DataFrame:
    """Altitudes after class: sea nodes at 0, at the sea's mean, or no lower than 0, by mode; inland water at the mean of
    its body. ``nodes`` has body, kind and z."""
    mean = F.avg("z").over(Window.partitionBy("body", "kind"))
    at_sea = {"zero": F.lit(0.0), "mean": mean, "clamp": F.greatest(F.col("z"), F.lit(0.0))}[mode]
    return nodes.withColumn("level", F.when(F.col("kind") == sea, at_sea).when(F.col("kind") == water, mean).otherwise(F.col("z")))
