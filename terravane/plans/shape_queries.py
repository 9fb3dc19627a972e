"""Registered queries of polygons, vector files, placement, graphs and further kernels, each with its SQL where SQL can say it.

Boxes of whole numbers let SQL count unit cells where the operators overlay polygons.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation, graph, placement, raster, scenery, shapes, spatial, tile_kernels, tiles
from ..operators._lineage import checkpoint_folder
from ..sources import scenery_files, vectors, writers
from . import adapters, runs
from .adapters import table, with_tables
from .queries import _CELLS_OF, _MATCHES, _over_boxes, _over_groups
from .registry import register as _query
from .registry import rounded as _r

_mod = lambda c, n: F.call_function("mod", F.col(c) if isinstance(c, str) else c, F.lit(n))


def _as_shapes(boxes: DataFrame) -> DataFrame:
    return boxes.select("id", shapes.box_shape(*(F.col(c) for c in spatial.BOX)).alias("shape"))


def _areas(df: DataFrame) -> DataFrame:
    return shapes.measures(df.select("id", "shape")).select("id", _r(F.col("area"), 4).alias("area"))


def _cells(source: str) -> str:
    return f"select id, x, y from {source}, lateral (select unnest(range(xmin::bigint, xmax::bigint)) as x), lateral (select unnest(range(ymin::bigint, ymax::bigint)) as y)"


# --- polygons ---------------------------------------------------------------------------------------------------------

_REGION = [[[[30, 20], [300, 20], [300, 120], [180, 120], [180, 220], [30, 220], [30, 20]], [[100, 60], [160, 60], [160, 110], [100, 110], [100, 60]]]]
_IN_REGION = "x >= 30 and y >= 20 and (x < 300 and y < 120 or x < 180 and y < 220) and not (x >= 100 and x < 160 and y >= 60 and y < 110)"


@_query(with_tables(f"select id, count(*)::double as area from ({_cells('truth')}) where {_IN_REGION} group by 1", "truth"))
def x4_clip_to_region(spark: SparkSession, d: str) -> DataFrame:
    """Areas of objects within a region with a corner cut out and a hole."""
    return _areas(shapes.clip(_as_shapes(adapters.truth_boxes(spark, d)), _REGION))


@_query(with_tables(f"""
    select id, count(*)::double as area from ({_cells('truth')}) c
    where not exists (select 1 from roads r where c.x >= r.xmin and c.x < r.xmax and c.y >= r.ymin and c.y < r.ymax)
    group by 1
    """, "truth", "roads"))
def j7_difference(spark: SparkSession, d: str) -> DataFrame:
    return _areas(shapes.minus(_as_shapes(adapters.truth_boxes(spark, d)), _as_shapes(adapters.road_boxes(spark, d)).select("shape"), 16.0))


@_query(_over_groups(f", c as ({_cells('roads')}) select root as id, count(distinct (x, y))::double as area from c join roots using (id) group by 1"))
def a7_j8_dissolve(spark: SparkSession, d: str) -> DataFrame:
    return _areas(shapes.dissolve(_as_shapes(adapters.road_boxes(spark, d)), 16.0))


@_query(_over_boxes("select gt_idx, pred_idx, round(iou, 9) as iou, gt_area, pred_area from matches"))
def j1_polygon_matches(spark: SparkSession, d: str) -> DataFrame:
    pairs = shapes.overlaps(_as_shapes(adapters.truth_boxes(spark, d)), _as_shapes(adapters.found_boxes(spark, d)), 16.0)
    return evaluation.match_objects(pairs, 0.3).select("gt_idx", "pred_idx", F.round("iou", 9).alias("iou"), _r(F.col("gt_area")).alias("gt_area"), _r(F.col("pred_area")).alias("pred_area"))


@_query(with_tables("""
    select id, pow(2, greatest(0, ceil(log2((xmax - xmin) / 2.5))) + greatest(0, ceil(log2((ymax - ymin) / 2.5))))::bigint as parts, (xmax - xmin) * (ymax
    - ymin) as area from truth
    """, "truth"))
def f28_split(spark: SparkSession, d: str) -> DataFrame:
    parts = shapes.split(_as_shapes(adapters.truth_boxes(spark, d)), 2.5)
    return shapes.measures(parts).groupBy("id").agg(F.count("*").alias("parts"), _r(F.sum("area"), 4).alias("area"))


@_query(with_tables("""
    select id, round((xmax - xmin) * (ymax - ymin) + 2 * (xmax - xmin + ymax - ymin) + 32 * sin(pi() / 32), 4) + 0.0 as grown, round(greatest(xmax - xmin
    - 2, 0) * greatest(ymax - ymin - 2, 0), 4) + 0.0 as shrunk from truth
    """, "truth"))
def f20_buffers(spark: SparkSession, d: str) -> DataFrame:
    """Areas of boxes grown by 1, with corners of sixteen pieces, and shrunk by 1."""
    b = _as_shapes(adapters.truth_boxes(spark, d))
    both = shapes.buffered(shapes.buffered(b, 1.0, out="grown"), -1.0, out="shrunk")
    out = shapes.measures(both.select("id", F.col("grown").alias("shape"), "shrunk")).select("id", F.col("area").alias("grown"), F.col("shrunk").alias("shape"))
    return shapes.measures(out).select("id", _r(F.col("grown"), 4).alias("grown"), _r(F.col("area"), 4).alias("shrunk"))


@_query()
def a2_match_details(spark: SparkSession, d: str) -> DataFrame:
    """Boundary scores and distances of matched objects; tests hold them against sampled areas."""
    pairs = shapes.overlaps(_as_shapes(adapters.truth_boxes(spark, d)), _as_shapes(adapters.found_boxes(spark, d)), 16.0)
    return shapes.match_details(evaluation.match_objects(pairs, 0.3), 2.0)


@_query(with_tables("", "truth", "found").rstrip() + ", " + _MATCHES + """
    select gt_idx, round(iou, 9) as iou, tp, n - tp as fp, round(tp / (n + 1e-9), 6) as "precision", round(tp / (select count(*) from truth), 6) as recall
    from (select gt_idx, iou, (sum((iou >= 0.6)::int) over w)::bigint as tp, row_number() over w as n from matches window w as (order by iou desc, gt_idx rows unbounded preceding))
    """)
def w2_w3_precision_curve(spark: SparkSession, d: str) -> DataFrame:
    pairs = evaluation.overlaps(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), 16.0)
    curve = evaluation.precision_curve(evaluation.match_objects(pairs, 0.3), adapters.truth_boxes(spark, d).count(), 0.6)
    return curve.select("gt_idx", F.round("iou", 9).alias("iou"), "tp", "fp", _r(F.col("precision")).alias("precision"), _r(F.col("recall")).alias("recall"))


# --- vector files -----------------------------------------------------------------------------------------------------


@_query(with_tables("select kind, id::varchar as id, (xmax - xmin) * (ymax - ymin) as area from truth, (select unnest(['geojson', 'gpkg', 'shp']) as kind)", "truth"))
def s3_k8_vector_files(spark: SparkSession, d: str) -> DataFrame:
    """Objects written as three kinds of vector files and read again."""
    folder, out = f"{checkpoint_folder(spark)}/vectors-{uuid.uuid4().hex}", None
    rows = vectors.polygon_features(_as_shapes(adapters.truth_boxes(spark, d)))
    for kind in ("geojson", "gpkg", "shp"):
        vectors.write_features(rows, f"{folder}/{kind}/objects.{kind}", 32637)
        back = vectors.only(vectors.features(spark, f"{folder}/{kind}/objects.{kind}"), vectors.POLYGONAL)
        part = shapes.measures(back.select(F.lit(kind).alias("kind"), F.col("properties")["id"].alias("id"), "shape")).select("kind", "id", _r(F.col("area"), 4).alias("area"))
        out = part if out is None else out.unionByName(part)
    return out


@_query("""
    select id, round(lat, 7) + 0.0 as lat, round(lon, 7) + 0.0 as lon
    from (select p_partkey as id, (30 + p_partkey % 30)::double as lat, (36 + p_partkey % 6)::double as lon
    from part)
    """)
def f10_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Places to a zone's metres, to mercator's, and back to degrees."""
    from ..functions import geodesy

    k = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (30 + _mod("p_partkey", 30)).cast("double").alias("lat"), (36 + _mod("p_partkey", 6)).cast("double").alias("lon"))
    x, y = geodesy.reproject(F.col("lon"), F.col("lat"), 4326, 32637)
    moved = k.select("id", x.alias("x"), y.alias("y"))
    x, y = geodesy.reproject(F.col("x"), F.col("y"), 32637, 3857)
    moved = moved.select("id", x.alias("x"), y.alias("y"))
    lon, lat = geodesy.reproject(F.col("x"), F.col("y"), 3857, 4326)
    return moved.select("id", _r(lat, 7).alias("lat"), _r(lon, 7).alias("lon"))


# --- placement --------------------------------------------------------------------------------------------------------

_TRANSFORM = (0.0001, 0.0, 29.0, 0.0, -0.0001, 41.0)


@_query("""
    select p_partkey as id, round_even(41.0::double - 0.0001 * r, 8) + 0.0 as center_lat, round_even(29.0::double + 0.0001 * c, 8) + 0.0 as center_lon,
    corners from (select p_partkey, least(greatest(p_size % 4 * 512 + p_partkey % 600 + 0.5, 0), 1999) as c, least(greatest(p_partkey % 3 * 512 + p_size *
    9 + 0.25, 0), 1499) as r, 4::int as corners from part)
    """)
def f17_to_world(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    x, y = _mod("p_partkey", 600) + 0.5, F.col("p_size") * 9 + 0.25
    corner = lambda a, b: F.array(x + a, y + b)
    b = p.select(_mod("p_size", 4).alias("tile_x"), _mod("p_partkey", 3).alias("tile_y"), F.col("p_partkey").alias("id"), x.alias("center_x"), y.alias("center_y"), F.array(corner(-2, -2), corner(2, -2), corner(2, 2), corner(-2, 2)).alias("corner_points"))
    out = placement.convert_buildings(b, 512, 2000, 1500, _TRANSFORM)
    return out.select("id", (F.col("center_lat") + 0.0).alias("center_lat"), (F.col("center_lon") + 0.0).alias("center_lon"), F.size("corner_points_wgs84").alias("corners"))


@_query("""
    select p_partkey as id, (ty * 4 + tx)::bigint as tile_index, round(tx * 100 + x * 100 / 512.0, 6) + 0.0 as world_x, round(ty * -90 + (512 - y) * 90 /
    512.0, 6) + 0.0 as world_z from (select p_partkey, p_size % 6 as tx, p_partkey % 5 as ty, p_partkey % 512 as x, p_size * 10 as y
    from part) where tx < 4 and ty < 3
    """)
def f18_in_scene(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), _mod("p_size", 6).cast("long").alias("tile_x"), _mod("p_partkey", 5).alias("tile_y"), _mod("p_partkey", 512).alias("x"), (F.col("p_size") * 10).alias("y"))
    grid = spark.range(12).select((F.col("id") % 4).alias("tile_x"), F.floor(F.col("id") / 4).alias("tile_y"))
    held = grid.select("tile_x", "tile_y", F.lit(512).alias("width"), F.lit(512).alias("height"), F.lit(100.0).alias("ground_width"), F.lit(90.0).alias("ground_height"), (F.col("tile_x") * 100).alias("origin_x"), (F.col("tile_y") * -90).alias("origin_z"))
    return placement.in_scene(p, held, 4, 12).select("id", "tile_index", _r(F.col("world_x")).alias("world_x"), _r(F.col("world_z")).alias("world_z"))


@_query("""
    select tile_x, tile_y, name, case when tile_x > 0 then 't' || (tile_x - 1) || '_' || tile_y end as "left", case when tile_y > 0 then 't' || tile_x ||
    '_' || (tile_y - 1) end as top, case when tile_x < 9 then 't' || (tile_x + 1) || '_' || tile_y end as "right", case when tile_y < 4 then 't' || tile_x
    || '_' || (tile_y + 1) end as bottom from (select distinct p_partkey % 10 as tile_x, p_partkey // 10 % 5 as tile_y, 't' || p_partkey % 10 || '_' ||
    p_partkey // 10 % 5 as name from part)
    """)
def f18_scene_neighbours(spark: SparkSession, d: str) -> DataFrame:
    x, y = _mod("p_partkey", 10), _mod(F.floor(F.col("p_partkey") / 10), 5)
    grid = table(spark, d, "part").select(x.alias("tile_x"), y.alias("tile_y"), F.concat(F.lit("t"), x.cast("string"), F.lit("_"), y.cast("string")).alias("name")).distinct()
    return placement.scene_neighbours(grid)


@_query()
def f15_f40_choices(spark: SparkSession, d: str) -> DataFrame:
    """Facades as Python's seeded generator chooses them, and materials by chains of hashes; tests hold both to their rules."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    out = placement.seeded_choice(p, "p_partkey", ["a.fac", "b.fac", "c.fac"], "facade")
    return out.select("p_partkey", "facade", placement.material_index(F.col("p_name"), F.col("p_size") / 7.0, F.col("p_partkey") / 3.0, 12).alias("material"))


@_query("""
    select p_partkey, n::int as n, confidence, corner_points from (select p_partkey, n, (p_size / 100.0)::double as confidence, case when n = 0 then [[x -
    2, y - 1], [x + 2, y - 1], [x + 2, y + 1], [x - 2, y + 1]] else [[x, y], [x + 1, y], [x, y + 1]] end as corner_points
    from (select p_partkey, p_size, (p_partkey % 50)::double as x, p_size::double as y
    from part), range(2) r(n))
    """)
def f59_predictions(spark: SparkSession, d: str) -> DataFrame:
    """A detector's answers: one prediction by its box, one by its points."""
    x, y = _mod("p_partkey", 50).cast("double"), F.col("p_size").cast("double")
    none = F.lit(None).cast("array<struct<x: double, y: double>>")
    point = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    one = lambda points: F.struct(x.alias("x"), y.alias("y"), F.lit(4.0).alias("width"), F.lit(2.0).alias("height"), (F.col("p_size") / 100.0).alias("confidence"), points.alias("points"))
    json = F.to_json(F.struct(F.array(one(none), one(F.array(point(0, 0), point(1, 0), point(0, 1)))).alias("predictions")))
    return placement.prediction_rows(table(spark, d, "part").select("p_partkey", json.alias("json")), "json").select("p_partkey", "n", "confidence", "corner_points")


@_query("select p_partkey, p_retailprice * 2 + p_size as z from part where p_size % 3 = 0")
def u1_user_rules(spark: SparkSession, d: str) -> DataFrame:
    kept = placement.keep_where(table(spark, d, "part"), lambda df: df["p_size"] % 3 == 0)
    return placement.with_altitude(kept, lambda x, y: x * 2 + y, "p_retailprice", "p_size").select("p_partkey", "z")


@_query(with_tables("select vec_id as tile, count(*) as detections from rasters where list_max(px) >= 0.3 group by 1", "rasters"))
def u2_detectors(spark: SparkSession, d: str) -> DataFrame:
    """A detector that is registered by name: bright tiles."""
    placement.register_detector("bright", lambda rows, limit: rows.where(F.array_max("px") >= limit).groupBy(F.col("vec_id").alias("tile")).agg(F.count("*").alias("detections")))
    return placement.detect("bright", adapters.rasters(spark, d), limit=0.3)


# --- graphs -----------------------------------------------------------------------------------------------------------

_EDGES = "select round_even(x1 / 7, 3) as a, round_even(y1 / 7, 3) as b, round_even(x2 / 7, 3) as c, round_even(y2 / 7, 3) as e, 1 << (l_linenumber % 4)::int as m from segments"


@_query(with_tables(f"""
    select case when (a, b) < (c, e) then a else c end + 0.0 as x1, case when (a, b) < (c, e) then b else e end + 0.0 as y1, case when (a, b) < (c, e)
    then c else a end + 0.0 as x2, case when (a, b) < (c, e) then e else b end + 0.0 as y2, bit_or(m)::bigint as marker
    from ({_EDGES}) where (a, b) <> (c, e) group by 1, 2, 3, 4
    """, "segments"))
def f30_snapped_edges(spark: SparkSession, d: str) -> DataFrame:
    s = adapters.segments(spark, d).select(*((F.col(c) / 7).alias(c) for c in ("x1", "y1", "x2", "y2")), F.expr("shiftleft(1L, cast(l_linenumber % 4 as int))").alias("marker"))
    return graph.snap(s, 3).select(*((F.col(c) + 0.0).alias(c) for c in ("x1", "y1", "x2", "y2")), "marker")


@_query()
def j13_f31_noded(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of the graph of all road boxes' outlines, cut where they cross; tests hold the nodes against all pairs."""
    edges = graph.edges_of(_as_shapes(adapters.road_boxes(spark, d)), F.lit(1).cast("long"))
    cut = graph.noded(edges, 16.0)
    return cut.agg(F.count("*").alias("edges"), _r(F.sum(F.when(F.col("y1") == F.col("y2"), F.abs(F.col("x2") - F.col("x1")))), 4).alias("across"))


@_query("""
    select t.id, (case coalesce(c.n, 0) when 0 then 1 when 1 then 2 when 2 then 3 else 6 end)::bigint as parts
    from (select p_partkey as id from part) t left join (select id, count(*) as n
    from (select p_partkey as id, unnest([[p_partkey, p_partkey + 1], [p_partkey + 1, p_partkey + 2], [p_partkey, p_partkey + 2]]) as e
    from part) where (e[1], e[2]) in (select (s_suppkey * 2, s_suppkey * 2 + 1 + s_suppkey % 2)
    from supplier) group by 1) c using (id)
    """)
def f34_recut_triangles(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    triangles = table(spark, d, "part").select(k.alias("id"), k.alias("a"), (k + 1).alias("b"), (k + 2).alias("c"))
    cut = scenery.recut_triangles(triangles, table(spark, d, "supplier").select((s * 2).alias("u"), (s * 2 + 1 + _mod("s_suppkey", 2)).alias("v")))
    return cut.groupBy("id").agg(F.count("*").alias("parts"))


# --- tiles and kernels ------------------------------------------------------------------------------------------------


@_query(with_tables("select vec_id, count(*)::double as area from pixels where v >= 0.03 and vec_id % 7 <> 0 group by 1", "rasters", "pixels"))
def j5_f23_f26_vectorised(spark: SparkSession, d: str) -> DataFrame:
    """Areas of the outlines, holes taken off, of tiles that have a reference."""
    t = adapters.rasters(spark, d)
    held, _ = tiles.with_reference(t, t.where(_mod("vec_id", 7) != 0).select("vec_id"), "vec_id")
    found = tile_kernels.vectorise(held, ["vec_id"], "px", 8, 0.03).select(F.col("vec_id").alias("id"), "shape").where(F.size("shape") > 0)
    return _areas(found).withColumnRenamed("id", "vec_id")


@_query(with_tables("""
    select id, (select count(*) from range(40) a(x), range(30) c(y)
    where x + 0.5 > x0 and x + 0.5 < x1 and y + 0.5 > y0 and y + 0.5 < y1)::bigint as n
    from (select id, id % 30 + 0.25 as x0, id % 30 + 0.25 + (xmax - xmin) as x1, id % 20 + 0.75 as y0, id % 20 + 0.75 + (ymax - ymin) as y1
    from truth)
    """, "truth"))
def f27_rasterised(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    left, low = _mod("id", 30) + 0.25, _mod("id", 20) + 0.75
    moved = b.select("id", shapes.box_shape(left, low, left + (F.col("xmax") - F.col("xmin")), low + (F.col("ymax") - F.col("ymin"))).alias("shape"))
    return tile_kernels.rasterise(moved, ["id"], "shape", 30, 40).select("id", F.aggregate("mask", F.lit(0).cast("long"), lambda a, v: a + v).alias("n"))


@_query(with_tables("select vec_id, list_transform(px, lambda v: (v >= 0.04)::int) as above from rasters", "rasters"))
def f48_level_sets(spark: SparkSession, d: str) -> DataFrame:
    return tile_kernels.level_sets(adapters.rasters(spark, d), ["vec_id"], "px", 8, 0.04)


@_query(with_tables("""
    select vec_id, list_transform(range(64), lambda i: round((px[(i + 63) % 64 + 1] + 2 * px[i + 1] + px[(i + 1) % 64 + 1]) / 4, 6) + 0.0) as smooth
    from rasters
    """, "rasters"))
def w8_smooth_ways(spark: SparkSession, d: str) -> DataFrame:
    out = tile_kernels.smooth_ways(adapters.rasters(spark, d), ["vec_id"], "px", [0.25, 0.5, 0.25])
    return out.select("vec_id", F.transform("smooth", lambda v: _r(v)).alias("smooth"))


@_query(with_tables("select vec_id, list_transform(range(64), lambda i: round(px[i // 8 * 8 + 8 - i % 8], 6) + 0.0) as warped from rasters", "rasters"))
def f51_warp(spark: SparkSession, d: str) -> DataFrame:
    """A mesh that turns each row round."""
    rows, cols = [[0.0, 0.0], [7.0, 7.0]], [[7.0, 0.0], [7.0, 0.0]]
    out = tile_kernels.warp(adapters.rasters(spark, d), ["vec_id"], "px", 8, rows, cols, (8, 8))
    return out.select("vec_id", F.transform("warped", lambda v: _r(v)).alias("warped"))


@_query()
def f48_f49_shores_and_normals(spark: SparkSession, d: str) -> DataFrame:
    """Shores blurred for sand and rocks, and normals; tests hold them against plain formulas."""
    t = adapters.rasters(spark, d)
    mask = t.select("vec_id", raster.threshold_mask(F.col("px"), 0.02).alias("px"))
    sand, rocks = (tile_kernels.shore_blur(mask, ["vec_id"], "px", 8, 2, p).withColumnRenamed("soft", p) for p in ("sand", "rocks"))
    return sand.join(rocks, "vec_id").join(tile_kernels.normals(t, ["vec_id"], "px", 8), "vec_id")


@_query()
def f57_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Raw detections of each order, decoded; tests hold the rule against a plain loop."""
    li = table(spark, d, "lineitem")
    row = F.array(_mod("l_partkey", 40).cast("double"), _mod("l_suppkey", 40).cast("double"), F.lit(9.0), F.lit(7.0), F.col("l_quantity") / 50, F.col("l_discount"), F.col("l_tax"))
    raw = li.groupBy("l_orderkey").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("r")))), lambda s: s["r"])).alias("raw"))
    return tile_kernels.decode_detections(raw, ["l_orderkey"], "raw", 7, (40, 40))


@_query(with_tables("""
    select vec_id, k, case when m = 0 then 0.1 else least(1.0, greatest(0.1, round(10 * 0.03 * m / 255, 9))) end as depth
    from (select vec_id, k::int as k, trunc(least(1.0, greatest(0.0, (px[(floor(y * 8) * 8 + floor(x * 8))::int + 1] + 0.25) / 0.5)) * 255)::int as m
    from (select vec_id, px, k, (vec_id * 7 + k * 13) % 100 / 100.0 as x, (vec_id * 11 + k * 17) % 100 / 100.0 as y
    from rasters, range(5) t(k)))
    """, "rasters"))
def f36_depths(spark: SparkSession, d: str) -> DataFrame:
    """Depth ratios of nodes by their mask's value."""
    from ..functions import features

    t = adapters.rasters(spark, d)
    place = lambda a, b: _mod(F.col("vec_id") * a + F.col("k") * b, 100) / 100.0
    nodes = t.select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select("vec_id", "k", place(7, 13).alias("x"), place(11, 17).alias("y"))
    masks = t.select("vec_id", F.lit(8).alias("width"), F.lit(8).alias("height"), raster.stretch(F.col("px"), F.lit(-0.25), F.lit(0.25)).alias("px"))
    return tiles.mask_values(nodes, masks, ["vec_id"]).select("vec_id", "k", F.round(features.depth_ratio(F.lit(False), F.lit(0.03), F.col("mask")), 9).alias("depth"))


@_query("""
    select p_partkey, coalesce((select s_acctbal from supplier where s_suppkey = p_partkey % 400), (select s_acctbal
    from supplier where s_suppkey = p_size % 3 + 1)) as balance from part
    """)
def j6_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", _mod("p_partkey", 400).alias("first"), (_mod("p_size", 3) + 1).cast("long").alias("second"))
    out = tiles.with_fallback(p, table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), ["first", "second"], "s_suppkey")
    return out.select("p_partkey", F.col("asset.s_acctbal").alias("balance"))


@_query(with_tables("""
    select id, exists (select 1 from roads r where r.id % 3 = 0 and t.xmin < r.xmax and r.xmin < t.xmax and t.ymin < r.ymax and r.ymin < t.ymax) as has,
    not exists (select 1 from roads r where r.id % 3 = 1 and t.xmin < r.xmax and r.xmin < t.xmax and t.ymin < r.ymax and r.ymin < t.ymax) as without
    from truth t
    """, "truth", "roads"))
def p20_covered(spark: SparkSession, d: str) -> DataFrame:
    extents = adapters.road_boxes(spark, d).withColumn("code", F.concat(F.lit("c"), _mod("id", 3).cast("string"))).drop("id")
    one = tiles.covered(adapters.truth_boxes(spark, d), extents, "c0", 16.0).select("id", "has")
    return one.join(tiles.covered(adapters.truth_boxes(spark, d), extents, "!c1", 16.0).select("id", F.col("has").alias("without")), "id")


@_query("""
    select p_partkey, (h * w)::bigint as tiles, (70 * p_size + h + (100 * p_size + w)) as edge
    from (select p_partkey, p_size, ceil(p_size * 100 / 512.0)::bigint as w, ceil(p_size * 70 / 512.0)::bigint as h
    from part)
    """)
def f42_overlapped(spark: SparkSession, d: str) -> DataFrame:
    """Height tiles with a shared row and column: their number, and the lengths along both sides, overlaps counted twice."""
    s = raster.overlapped(F.col("p_size") * 100, F.col("p_size") * 70, 512)
    p = table(spark, d, "part").select("p_partkey", s.alias("s"))
    side = lambda axis, other: F.aggregate(F.filter("s", lambda t: t[other] == 0), F.lit(0).cast("long"), lambda a, t: a + t[axis])
    return p.select("p_partkey", F.size("s").cast("long").alias("tiles"), (side("height", "col") + side("width", "row")).alias("edge"))


# --- texts ------------------------------------------------------------------------------------------------------------


@_query("select min(p_retailprice) as low, max(p_retailprice) as high, count(*) as tiles, min(p_partkey % 50 * 1000 + p_size) as first from part")
def k4_tile_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A metadata document of all tiles, read again."""
    p = table(spark, d, "part").select(F.col("p_size").alias("tile_x"), _mod("p_partkey", 50).alias("tile_y"), F.col("p_retailprice").alias("tile_max_height"))
    doc = scenery_files.tile_metadata(p, F.col("tile_max_height"), F.col("tile_max_height"))
    back = doc.select(F.from_json("json", "global_min_elevation double, global_max_elevation double, tiles array<struct<tile_x: int, tile_y: bigint>>").alias("j")).select("j.*")
    return back.select(F.col("global_min_elevation").alias("low"), F.col("global_max_elevation").alias("high"), F.size("tiles").cast("long").alias("tiles"), (F.col("tiles")[0]["tile_y"] * 1000 + F.col("tiles")[0]["tile_x"]).alias("first"))


@_query("""
    select p_partkey, coalesce(nullif(substr(regexp_replace(upper(p_name), '[^A-Z]', '', 'g'), 1, 4), ''), 'BLDG') as code, case when p_size % 5 = 0 then
    'N/A' else printf('%.4f', p_retailprice / 7) end as shown from part
    """)
def k15_f60_texts(spark: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice") / 7)
    return table(spark, d, "part").select("p_partkey", scenery_files.airport_code(F.col("p_name")).alias("code"), writers.number_text(value).alias("shown"))


@_query(f"select buckets, max_depth from (select count(*) as buckets, max(depth) as max_depth from ({_CELLS_OF}))")
def k16_benchmark_json(spark: SparkSession, d: str) -> DataFrame:
    """A run's figures as one document with those of its terrain, read again."""
    from .queries import _tree_points

    figures = scenery.quadtree_figures(scenery.quadtree(_tree_points(spark, d), "x", "y", 200)[1])
    doc = scenery_files.benchmark_json(spark.range(1).select(F.lit("run").alias("name")), figures)
    return doc.select(F.from_json("json", "name string, terrain struct<buckets: bigint, max_depth: int>").alias("j")).select("j.terrain.buckets", "j.terrain.max_depth")


@_query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as shown, strftime(ts, '%Y%m%d_%H%M%S') as file from events")
def f61_stamps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", writers.stamp(F.col("ts")).alias("shown"), writers.stamp(F.col("ts"), file=True).alias("file"))



@_query("select p_partkey, 'osm/' || folder || '/' || tile || '/' || tile || '_water.osm.bz2' as cached, 'Data' || tile || '.2.node' as nodes, p_size || '_' || p_partkey || '_ZL16.png' as mask from (select p_partkey, p_size, '+' || lpad((p_size % 60)::varchar, 2, '0') || '+' || lpad((p_partkey % 170)::varchar, 3, '0') as tile, '+' || lpad((p_size % 60 // 10 * 10)::varchar, 2, '0') || '+' || lpad((p_partkey % 170 // 10 * 10)::varchar, 3, '0') as folder from part)")
def f12_file_names(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import geodesy

    lat, lon = _mod("p_size", 60), _mod("p_partkey", 170)
    folder = geodesy.build_folder("tiles", lat, lon)
    nodes = F.substring_index(geodesy.build_file(folder, lat, lon, "nodes", 2), "/", -1)
    return table(spark, d, "part").select("p_partkey", geodesy.cached_file("osm", lat, lon, "water").alias("cached"), nodes.alias("nodes"), geodesy.mask_file(F.col("p_partkey"), F.col("p_size"), F.lit(16)).alias("mask"))


@_query(with_tables("select vec_id, list_transform(range(64), lambda i: round(px[i + 1], 6) + 0.0) as fine from rasters", "rasters"))
def f44_resampled(spark: SparkSession, d: str) -> DataFrame:
    """Cubic convolution at the pixels' own places gives the pixels."""
    out = tile_kernels.resampled(adapters.rasters(spark, d), ["vec_id"], "px", 8, (8, 8), "cubic")
    return out.select("vec_id", F.transform("fine", lambda v: _r(v)).alias("fine"))


@_query("select p_partkey, round(case when near < 1 then near * p_retailprice + (1 - near) * 7 else p_retailprice end, 6) as z from (select *, least(x, 1 - x, y, 1 - y) / 0.25 as near from (select p_partkey, p_retailprice, p_size / 50.0::double as x, p_partkey % 100 / 100.0::double as y from part))")
def j10_border_blend(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("p_size") / 50.0, _mod("p_partkey", 100) / 100.0
    return table(spark, d, "part").select("p_partkey", F.round(spatial.blended_at_border(F.col("p_retailprice"), F.lit(7.0), x, y, 0.25), 6).alias("z"))


@_query(with_tables("""
    select count(*) as tiles, sum(n)::bigint as tree_pixels, sum(case when n > 0 then greatest(1, floor(n * 0.25)) else 0 end)::bigint as trees
    from (select vec_id, sum((v >= 0.02 and not (v >= 0.08 and vec_id % 3 <> 0))::int) as n from pixels group by 1)
    """, "rasters", "pixels"))
def u4_trees(spark: SparkSession, d: str) -> DataFrame:
    """A run from green tiles and road masks, of which every third is missing, to trees; its counters."""
    t = adapters.rasters(spark, d).select(F.col("vec_id").alias("tile"), "px")
    roads = t.where(_mod("tile", 3) != 0).select("tile", raster.threshold_mask(F.col("px"), 0.08).alias("px"))
    return runs.plant_trees(t, roads, 8, 8, limit=0.02, density=0.25).counters


@_query(with_tables("""
    select id, c0 as col, r0 as "row", c1 - c0 as width, r1 - r0 as height
    from (
        select id, least(greatest(round_even((xmin - 20) / 0.5, 0)::bigint, 0), 500) as c0, least(greatest(round_even((xmax - 20) / 0.5, 0)::bigint, 0), 500) as c1,
            least(greatest(round_even((200 - ymax) / 0.5, 0)::bigint, 0), 300) as r0, least(greatest(round_even((200 - ymin) / 0.5, 0)::bigint, 0), 300) as r1
        from truth
    )
    where c1 > c0 and r1 > r0
    """, "truth"))
def p13_pixel_windows(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import features

    window = features.pixel_window(*(F.col(c) for c in spatial.BOX), 20.0, 200.0, 0.5, 500, 300)
    return adapters.truth_boxes(spark, d).select("id", window.alias("w")).where("w is not null").select("id", "w.*")


@_query(with_tables("select vec_id, \"row\", col, round(v + (v - m) * 0.5, 6) + 0.0 as v from (select vec_id, \"row\", col, v, (select sum(q.v) from (select unnest([-1, 0, 1]) as a), (select unnest([-1, 0, 1]) as b), pixels q where q.vec_id = p.vec_id and q.\"row\" = least(greatest(p.\"row\" + a, 0), 7) and q.col = least(greatest(p.col + b, 0), 7)) / 9 as m from pixels p)", "rasters", "pixels"))
def f52_sharpened(spark: SparkSession, d: str) -> DataFrame:
    out = raster.pixels(tile_kernels.sharpen(adapters.rasters(spark, d), ["vec_id"], "px", 8, 1.5), "px", 8)
    return out.select("vec_id", "row", "col", _r(F.col("v")).alias("v"))
