"""Polygons in DataFrames: a shape column holds GeoJSON's MultiPolygon coordinates (polygons, rings, points). Objects are
worked on where they lie; joins meet on grid cells by boxes, and only pairs whose boxes touch are overlaid."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import convex, polygons
from ..functions.features import ratio
from . import _lineage
from .spatial import BOX, box_join, connected
from .tile_kernels import dealt, map_rows

SHAPE = "array<array<array<array<double>>>>"


def with_boxes(df: DataFrame, shape: str = "shape") -> DataFrame:
    """Adds the sides of each shape's box; null for an empty shape."""
    points = F.flatten(F.flatten(shape))
    along = lambda k, pick: pick(F.transform(points, lambda p: p[k]))
    return df.withColumns({c: along(k, pick) for c, (k, pick) in zip(BOX, ((0, F.array_min), (1, F.array_min), (0, F.array_max), (1, F.array_max)), strict=True)})


def box_shape(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A box as a shape."""
    ring = F.array(*(F.array(x.cast("double"), y.cast("double")) for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))))
    return F.array(F.array(ring))


def clean(df: DataFrame, shape: str = "shape") -> DataFrame:
    """Rows of valid polygons, a row for each part (numbered in ``part``) of what had several; null, empty and invalid shapes
    go. A ring of less than three corners makes the whole shape invalid."""
    parts = df.where(F.size(shape) > 0)
    valid = map_rows(parts, [shape], lambda s: (polygons.is_valid(s),), "_valid boolean", parts.columns).where("_valid").drop("_valid")
    return valid.select(*(c for c in df.columns if c != shape), F.posexplode(shape).alias("part", "_one")).withColumn(shape, F.array("_one")).drop("_one")


def repair(df: DataFrame, shape: str = "shape") -> DataFrame:
    """Shapes whose outlines cross themselves, redrawn as the region that they wind around; empty ones go."""
    kept = [c for c in df.columns if c != shape]
    out = map_rows(df, [shape], lambda s: (polygons.to_lists(polygons.union(polygons.shape_of(s))),), f"_fixed {SHAPE}", kept)
    return out.withColumnRenamed("_fixed", shape).where(F.size(shape) > 0)


def measures(df: DataFrame, shape: str = "shape") -> DataFrame:
    """Adds area and centroid."""

    def kernel(s) -> tuple:
        p = polygons.shape_of(s)
        return (polygons.area(p), *polygons.centroid(p)) if p else (0.0, None, None)

    def many(column: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p in convex.single_rings(column):
            yield rows, [convex.area(p), *convex.centroid(p).T.copy()]

    return map_rows(df, [shape], kernel, "area double, cx double, cy double", df.columns, many)


def clip(df: DataFrame, region, shape: str = "shape") -> DataFrame:
    """Shapes cut to one region, which goes into the tasks' closure. What is split stays one object; objects that share no
    area with it go, as do contacts along an edge."""
    held = polygons.shape_of(region)
    kept = [c for c in df.columns if c != shape]

    def kernel(s) -> tuple:
        return (polygons.to_lists(polygons.intersection(polygons.shape_of(s), held)),)

    out = map_rows(df, [shape], kernel, f"_cut {SHAPE}", kept)
    return out.withColumnRenamed("_cut", shape).where(F.size(shape) > 0)


def overlay(df: DataFrame, first: str, second: str, how: str, out: str = "shape") -> DataFrame:
    """A row's two shapes put together: intersection, union, difference or symmetric_difference."""
    f: Callable = {k: getattr(polygons, k) for k in ("intersection", "union", "difference", "symmetric_difference")}[how]
    return map_rows(df, [first, second], lambda a, b: (polygons.to_lists(f(polygons.shape_of(a), polygons.shape_of(b))),), f"{out} {SHAPE}", [c for c in df.columns if c != out])


def buffered(df: DataFrame, distance: float, shape: str = "shape", out: str = "grown") -> DataFrame:
    """Shapes grown by a distance with round corners, or shrunk by a negative one."""

    def many(column: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p in convex.convex_rings(column) if distance else ():
            yield rows, [convex.to_shapes(convex.grown(p, distance, quarter=polygons.QUARTER) if distance > 0 else convex.shrunk(p, -distance))]

    return map_rows(dealt(df), [shape], lambda s: (polygons.to_lists(polygons.buffer(polygons.shape_of(s), distance)),), f"{out} {SHAPE}", df.columns, many)


def road_buffers(lines: DataFrame, line: str, width: str, out: str = "shape") -> DataFrame:
    """Lines (arrays of x, y) as what lies within half their width, with round ends."""
    import numpy as np

    def kernel(points, w) -> tuple:
        return (polygons.to_lists(polygons.buffer_line(np.array(points, float), w / 2)),) if len(points) > 1 and w > 0 else ([],)

    return map_rows(lines, [line, width], kernel, f"{out} {SHAPE}", lines.columns)


def split(df: DataFrame, most: float, shape: str = "shape") -> DataFrame:
    """A row for each part whose box is no longer than ``most``."""
    kept = [c for c in df.columns if c != shape]

    def many(column: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p in convex.convex_rings(column):
            row, cut = convex.parts(p, most)
            stops = np.append(0, np.cumsum(np.bincount(row, minlength=len(rows)))).astype(np.int32)
            yield rows, [pa.ListArray.from_arrays(pa.array(stops), convex.to_shapes(cut))]

    out = map_rows(dealt(df), [shape], lambda s: ([polygons.to_lists(p) for p in polygons.split(polygons.shape_of(s), most)],), f"_parts array<{SHAPE}>", kept, many)
    return out.select(*kept, F.explode("_parts").alias(shape))


def _touching(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    return box_join(with_boxes(left), with_boxes(right), cell)


def overlaps(truth: DataFrame, found: DataFrame, cell: float) -> DataFrame:
    """(gt_idx, pred_idx, iou, gt_area, pred_area, truth, found) of shapes (id, shape) that share area."""

    def kernel(a, b) -> tuple:
        both, one, two = polygons.shared_areas(polygons.shape_of(a), polygons.shape_of(b))
        return both, both + one, both + two

    pairs = _touching(truth.select("id", "shape"), found.select("id", "shape"), cell).select("id", "r_id", "shape", "r_shape")

    def many(first: pa.Array, second: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p, q in convex.convex_pairs(first, second):
            yield rows, [convex.shared(p, q), convex.area(p), convex.area(q)]

    areas = map_rows(pairs, ["shape", "r_shape"], kernel, "both double, gt_area double, pred_area double", pairs.columns, many).where("both > 0")
    return areas.select(F.col("id").alias("gt_idx"), F.col("r_id").alias("pred_idx"), ratio(F.col("both"), F.col("gt_area") + F.col("pred_area") - F.col("both")).alias("iou"), "gt_area", "pred_area", F.col("shape").alias("truth"), F.col("r_shape").alias("found"))


def match_details(matches: DataFrame, width: float) -> DataFrame:
    """Boundary scores and distances of matched pairs (truth, found). The boundary's precision, recall and F1 compare the
    truth's band with the whole found shape."""

    def kernel(a, b) -> tuple:
        p, q = polygons.shape_of(a), polygons.shape_of(b)
        band, other = polygons.boundary_band(p, width), polygons.boundary_band(q, width)
        both, one, two = polygons.shared_areas(band, other)
        tp, fn, fp = polygons.shared_areas(band, q)
        share = lambda x, y: x / y if y > 0 else 0.0
        precision, recall = share(tp, tp + fp), share(tp, tp + fn)
        (x, y), (u, v) = polygons.centroid(p), polygons.centroid(q)
        return share(both, both + one + two), precision, recall, share(2 * precision * recall, precision + recall), polygons.hausdorff(p, q), ((x - u) ** 2 + (y - v) ** 2) ** 0.5

    def many(first: pa.Array, second: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p, q in convex.convex_pairs(first, second):
            (outer, inner), (other, hole) = ((convex.grown(r, width / 2, quarter=polygons.QUARTER), convex.shrunk(r, width / 2)) for r in (p, q))
            yield rows, [*convex.band_scores(outer, inner, other, hole, q), convex.hausdorff(p, q), np.hypot(*(convex.centroid(p) - convex.centroid(q)).T)]

    names = ("boundary_iou", "boundary_precision", "boundary_recall", "boundary_f1", "hausdorff_m", "centroid_dist_m")
    kept = [c for c in matches.columns if c not in ("truth", "found")]
    return map_rows(dealt(matches), ["truth", "found"], kernel, ", ".join(f"{n} double" for n in names), kept, many)


def without_collisions(objects: DataFrame, blockers: DataFrame, cell: float) -> DataFrame:
    """Objects (id, shape) that share a place with no blocker (shape); rings of less than three corners go as well."""
    sound = objects.where(F.size(shape_rings("shape")) > 0)
    pairs = _touching(sound.select("id", "shape"), blockers.select("shape"), cell).select("id", "shape", "r_shape")
    hit = map_rows(pairs, ["shape", "r_shape"], lambda a, b: (polygons.shared_areas(polygons.shape_of(a), polygons.shape_of(b))[0] > 0,), "hit boolean", ["id"]).where("hit")
    return sound.join(hit.select("id").distinct(), "id", "left_anti")


def shape_rings(shape: str) -> Column:
    """Shells of at least three different corners, closed."""
    return F.filter(F.transform(shape, lambda p: p[0]), lambda r: F.size(F.array_distinct(r)) >= 3)


def minus(first: DataFrame, second: DataFrame, cell: float) -> DataFrame:
    """Each shape of ``first`` (id, shape) without all of ``second`` (shape) that touch it; what nothing is left of goes."""

    def kernel(a, others) -> tuple:
        p = polygons.shape_of(a)
        return (polygons.to_lists(polygons.difference(p, polygons.union(*map(polygons.shape_of, others))) if others else p),)

    near = _touching(first.select("id", "shape"), second.select("shape"), cell).groupBy("id").agg(F.collect_list("r_shape").alias("others"))
    both = first.join(near, "id", "left").withColumn("others", F.coalesce("others", F.array().cast(f"array<{SHAPE}>")))
    kept = [c for c in first.columns if c != "shape"]
    return map_rows(both, ["shape", "others"], kernel, f"_left {SHAPE}", kept).withColumnRenamed("_left", "shape").where(F.size("shape") > 0)


def dissolve(shapes: DataFrame, cell: float) -> DataFrame:
    """(id, shape): unions of shapes (id, shape) that share area directly or through others; id is the smallest of a union's.

    Shapes that are equal and have an area are one before all else. Groups are found by joins on boxes and links, so only what
    hangs together meets in a task.
    """

    def many(first: pa.Array, second: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p, q in convex.convex_pairs(first, second):
            yield rows, [convex.shared(p, q) > 0]

    sized = measures(shapes.select("id", "shape"))
    shapes = _lineage.settle(sized.where("area > 0").groupBy("shape").agg(F.min("id").alias("id")).select("id", "shape").unionByName(sized.where("area <= 0 or area is null").select("id", "shape")))
    pairs = dealt(_touching(shapes, shapes, cell).where(F.col("id") < F.col("r_id")).select("id", "r_id", "shape", "r_shape"))
    links = map_rows(pairs, ["shape", "r_shape"], lambda a, b: (polygons.shared_areas(polygons.shape_of(a), polygons.shape_of(b))[0] > 0,), "hit boolean", ["id", "r_id"], many)
    roots = connected(shapes.select("id"), links.where("hit").select(F.col("id").alias("a"), F.col("r_id").alias("b")))
    groups = shapes.join(roots, "id").groupBy("root").agg(F.collect_list("shape").alias("shapes"))
    out = map_rows(groups, ["shapes"], lambda s: (polygons.to_lists(polygons.union(*map(polygons.shape_of, s))),), f"shape {SHAPE}", ["root"])
    return out.withColumnRenamed("root", "id")


def _per_cell(cell: float):
    def areas(key: tuple, table: pa.Table) -> pa.Table:
        x, y = (k.as_py() for k in key)
        frame = polygons.box(x * cell, y * cell, (x + 1) * cell, (y + 1) * cell)
        sides = [[], []]
        for kind, shape in zip(table["kind"].to_pylist(), table["shape"].to_pylist(), strict=True):
            sides[kind].extend(polygons.rings_of(polygons.intersection(polygons.shape_of(shape), frame)))
        o = polygons.Overlay(*sides)
        return pa.table({"tp": [o.area(lambda p, q: p & q)], "fp": [o.area(lambda p, q: ~p & q)], "fn": [o.area(lambda p, q: p & ~q)]})

    return areas


def area_confusion(truth: DataFrame, found: DataFrame, cell: float) -> DataFrame:
    """One row (tp, fp, fn): areas of the unions of both sets of shapes, however these overlap among themselves. Each grid cell
    is overlaid by itself, so no task sees more than one cell's shapes."""
    both = truth.select(F.lit(0).alias("kind"), "shape").unionByName(found.select(F.lit(1).alias("kind"), "shape"))
    reach = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))
    dealt = with_boxes(both).where("xmin is not null").withColumn("cx", F.explode(reach("xmin", "xmax"))).withColumn("cy", F.explode(reach("ymin", "ymax")))
    parts = dealt.select("cx", "cy", "kind", "shape").groupBy("cx", "cy").applyInArrow(_per_cell(cell), "tp double, fp double, fn double")
    return parts.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("tp", "fp", "fn")))


def boundary_agreement(truth: DataFrame, found: DataFrame, width: float, cell: float) -> DataFrame:
    """One row (precision, recall, f1): whole layers' boundary bands compared with each other, as for forests."""
    bands = [map_rows(x.select("id", "shape"), ["shape"], lambda s: (polygons.to_lists(polygons.boundary_band(polygons.shape_of(s), width)),), f"band {SHAPE}", ["id"]).select("id", F.col("band").alias("shape")) for x in (truth, found)]
    a = area_confusion(*bands, cell)
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return a.select(precision.alias("precision"), recall.alias("recall")).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def seas(coasts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, shape): the sea of each tile from its coastlines (keys, line: array of x, y from 0 to 1 in the tile, land to the
    left). A tile's coast is one value, bounded by the tile."""
    import numpy as np

    lists = coasts.groupBy(*keys).agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return map_rows(lists, ["lines"], lambda ls: (polygons.to_lists(polygons.coast_to_sea([np.array(x, float) for x in ls])),), f"shape {SHAPE}", keys)


def check_boundary(boundary: DataFrame, epsg: int | None, metric: bool) -> list:
    """The one region of an evaluation boundary's rows (shape), or ValueError: it must have a CRS in metres, and its rows must
    be valid polygons with an area. A boundary is a footprint of bounded size."""
    if epsg is None:
        raise ValueError("Evaluation boundary must have a CRS.")
    if not metric:
        raise ValueError("Evaluation CRS must be projected in metres.")
    rows = [r["shape"] for r in boundary.select("shape").collect()]
    if not rows or any(not s for s in rows):
        raise ValueError("Evaluation boundary must contain valid polygons.")
    if not all(polygons.is_valid(s) for s in rows):
        raise ValueError("Evaluation boundary contains invalid or empty geometry.")
    out = polygons.union(*map(polygons.shape_of, rows))
    if polygons.area(out) <= 0:
        raise ValueError("Evaluation boundary must have positive area.")
    return polygons.to_lists(out)
