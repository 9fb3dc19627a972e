"""Planar graphs from polygons and lines: encoding as edges, noding, snapping, and the text files of mesh tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import polygons
from .spatial import box_join
from .tile_kernels import map_rows

PLACES = 9


def edges_of(shapes: DataFrame, marker: Column, shape: str = "shape") -> DataFrame:
    """(id, x1, y1, x2, y2, marker) of all rings' edges."""
    rings = shapes.select("id", marker.alias("marker"), F.explode(F.flatten(shape)).alias("ring"))
    points = rings.select("id", "marker", F.explode(F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1), lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))).alias("e"))
    return points.select("id", "e.x1", "e.y1", "e.x2", "e.y2", "marker")


def line_edges(lines: DataFrame, marker: Column, line: str = "line") -> DataFrame:
    """The same of lines (arrays of x, y)."""
    steps = F.zip_with(F.slice(line, F.lit(1), F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))
    return lines.select("id", marker.alias("marker"), F.explode(steps).alias("e")).select("id", "e.x1", "e.y1", "e.x2", "e.y2", "marker")


def seeds(shapes: DataFrame, shape: str = "shape") -> DataFrame:
    """(id, n, x, y): a place inside each polygon of each shape, from which a mesh tool knows the region."""
    out = map_rows(shapes, [shape], lambda s: ([list(polygons.representative_point(p)) for p in polygons.shape_of(s)],), "places array<array<double>>", ["id"])
    return out.select("id", F.posexplode("places").alias("n", "p")).select("id", "n", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def snap(edges: DataFrame, places: int = PLACES) -> DataFrame:
    """Edges (x1, y1, x2, y2, marker) with coordinates to so many places, each once whichever way it runs, its markers put
    together; edges without length go."""
    near = edges.select(*(F.bround(c, places).alias(c) for c in ("x1", "y1", "x2", "y2")), "marker").where("x1 != x2 or y1 != y2")
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    return near.groupBy(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).agg(F.bit_or(F.col("marker").cast("long")).alias("marker")).select("u.x", "u.y", F.col("v.x").alias("x2"), F.col("v.y").alias("y2"), "marker").toDF("x1", "y1", "x2", "y2", "marker")


def noded(edges: DataFrame, cell: float, near: float = 1e-8, places: int = PLACES) -> DataFrame:
    """Edges cut wherever another edge crosses them or ends on them, then snapped: no two of the result meet but at ends.

    Pairs meet by their boxes' cells. Each edge collects the shares of its length at which it is cut, so the order of
    insertion does not matter.
    """
    whole = snap(edges, places)
    keyed = whole.withColumn("id", F.xxhash64("x1", "y1", "x2", "y2"))
    boxed = keyed.withColumns({"xmin": F.least("x1", "x2") - near, "xmax": F.greatest("x1", "x2") + near, "ymin": F.least("y1", "y2") - near, "ymax": F.greatest("y1", "y2") + near})
    pairs = box_join(boxed, boxed, cell).where("id != r_id")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ex, ey = F.col("r_x2") - F.col("r_x1"), F.col("r_y2") - F.col("r_y1")
    wx, wy = F.col("r_x1") - F.col("x1"), F.col("r_y1") - F.col("y1")
    cross, square = dx * ey - dy * ex, dx * dx + dy * dy
    flat = F.abs(cross) <= near * F.sqrt(square * (ex * ex + ey * ey))
    safe = F.when(~flat, cross)
    t, s = (wx * ey - wy * ex) / safe, (wx * dy - wy * dx) / safe
    slack, other = F.lit(near) / F.sqrt(square), F.lit(near) / F.sqrt(ex * ex + ey * ey)
    crossing = F.when(t.between(-slack, 1 + slack) & s.between(-other, 1 + other), t)

    def on(x: Column, y: Column) -> Column:
        """The share at which a place lies on the edge, if it does."""
        px, py = x - F.col("x1"), y - F.col("y1")
        return F.when(F.abs(dx * py - dy * px) <= near * F.sqrt(square), (dx * px + dy * py) / square)

    shares = F.array(crossing, on(F.col("r_x1"), F.col("r_y1")), on(F.col("r_x2"), F.col("r_y2")))
    cuts = pairs.select("id", F.explode(F.filter(shares, lambda v: (v > 1e-12) & (v < 1 - 1e-12))).alias("t")).groupBy("id").agg(F.collect_set("t").alias("ts"))
    cut = keyed.join(cuts, "id", "left").withColumn("ts", F.concat(F.array(F.lit(0.0)), F.array_sort(F.coalesce("ts", F.array().cast("array<double>"))), F.array(F.lit(1.0))))
    parts = cut.select("x1", "y1", "x2", "y2", "marker", "ts", F.explode(F.sequence(F.lit(1), F.size("ts") - 1)).alias("k"))
    at = lambda k, c1, c2: F.col(c1) + F.element_at("ts", k) * (F.col(c2) - F.col(c1))
    ends = parts.select(at(F.col("k"), "x1", "x2").alias("a"), at(F.col("k"), "y1", "y2").alias("b"), at(F.col("k") + 1, "x1", "x2").alias("c"), at(F.col("k") + 1, "y1", "y2").alias("d"), "marker")
    return snap(ends.toDF("x1", "y1", "x2", "y2", "marker"), places)


def numbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes (node, x, y), edges (edge, u, v, marker)) of one tile's graph; nodes and edges are numbered from 1 in the order
    of their places, as the text files want it. A tile's graph is of bounded size, so its numbers come from one window."""
    both = edges.select(F.col("x1").alias("x"), F.col("y1").alias("y")).unionByName(edges.select(F.col("x2").alias("x"), F.col("y2").alias("y"))).distinct()
    nodes = both.select(F.row_number().over(Window.orderBy("x", "y")).alias("node"), "x", "y")
    one, two = nodes.select(F.col("node").alias("u"), F.col("x").alias("x1"), F.col("y").alias("y1")), nodes.select(F.col("node").alias("v"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    named = edges.join(one, ["x1", "y1"]).join(two, ["x2", "y2"]).select("u", "v", "marker")
    return nodes, named.select(F.row_number().over(Window.orderBy("u", "v")).alias("edge"), "u", "v", "marker")


def _lines(rows: DataFrame, order: str, line: Column) -> str:
    return "\n".join(r["line"] for r in rows.select(order, line.alias("line")).orderBy(order).collect())


def node_text(nodes: DataFrame, altitude: Column) -> str:
    """A .node file: the number of nodes, two coordinates and one attribute, and a line for each. The text is one value."""
    body = _lines(nodes, "node", F.format_string("%d %.9f %.9f %.2f", F.col("node"), F.col("x"), F.col("y"), altitude.cast("double")))
    return f"{nodes.count()} 2 1 0\n{body}\n"


def poly_text(nodes: DataFrame, edges: DataFrame, holes: list[tuple[float, float]], regions: list[tuple[float, float, int]]) -> str:
    """A .poly file whose nodes are in the .node file beside it: edges with markers, holes, and regions with theirs."""
    body = _lines(edges, "edge", F.format_string("%d %d %d %d", "edge", "u", "v", "marker"))
    out = [f"0 2 1 0\n\n{edges.count()} 1", body, f"\n{len(holes)}", *(f"{k} {x:.9f} {y:.9f}" for k, (x, y) in enumerate(holes, 1)), f"\n{len(regions)}", *(f"{k} {x:.9f} {y:.9f} {m}" for k, (x, y, m) in enumerate(regions, 1))]
    return "\n".join(out) + "\n"


def mesh_text(nodes: DataFrame, triangles: DataFrame, version: str = "1.30") -> str:
    """A .mesh file, as ``readers.mesh`` reads it: nodes (id, values: five numbers) and triangles (id, nodes, type)."""
    rows = _lines(nodes, "id", F.array_join(F.transform("values", lambda v: F.format_string("%.9f", v)), " "))
    faces = _lines(triangles, "id", F.concat_ws(" ", F.array_join(F.transform("nodes", lambda v: v.cast("string")), " "), F.col("type").cast("string")))
    return f"{version}\n{nodes.count()}\n{rows}\n{triangles.count()}\n{faces}\n"
