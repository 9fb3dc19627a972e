"""Polygons, vector files, the evaluation of the survey's fixtures, graphs, placement and scenery files."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.functions import convex, kernels, polygons
from terravane.operators import _order, frames, graph, placement, raster, scenery, shapes, spatial, tile_kernels, tiles
from terravane.plans import evaluate, runs
from terravane.sources import readers, scenery_files, vectors, writers


def _star(r):
    t = np.sort(r.uniform(0, 2 * np.pi, r.integers(6, 14)))
    while np.diff(t, append=t[0] + 2 * np.pi).max() > 2.5:
        t = np.sort(r.uniform(0, 2 * np.pi, r.integers(6, 14)))
    size = r.uniform(1, 5, len(t))
    return polygons.shape_of([[np.column_stack([size * np.cos(t), size * np.sin(t)]) + r.uniform(-2, 2, 2)]])


def test_overlay_by_sampling():
    r = np.random.default_rng(0)
    for _ in range(25):
        a, b, p = _star(r), _star(r), r.uniform(-8, 8, (4000, 2))
        one, two = polygons.inside(a, p), polygons.inside(b, p)
        for how, expected in ((polygons.intersection, one & two), (polygons.union, one | two), (polygons.difference, one & ~two), (polygons.symmetric_difference, one ^ two)):
            out = how(a, b)
            assert ((polygons.inside(out, p) if out else np.zeros(len(p), bool)) == expected).mean() > 0.999
        both, left, right = polygons.shared_areas(a, b)
        assert both + left == pytest.approx(polygons.area(a)) and both + left + right == pytest.approx(polygons.area(polygons.union(a, b)))


def test_buffers_by_sampling():
    r = np.random.default_rng(1)
    for k in range(8):
        a = _star(r)
        a = polygons.difference(a, polygons.box(-0.7, -0.7, 0.9, 0.8)) if k % 2 else a
        p = r.uniform(-9, 9, (1500, 2))
        away = np.minimum.reduce([kernels.segment_distance(p, u, v) for ring in polygons.rings_of(a) for u, v in zip(ring, np.roll(ring, -1, axis=0), strict=True)])
        held = polygons.inside(a, p)
        for by in (0.3, 1.2):
            clear = np.abs(away - by) > 0.02
            assert (polygons.inside(polygons.buffer(a, by), p) == (held | (away < by)))[clear].all()
            small = polygons.buffer(a, -by)
            assert ((polygons.inside(small, p) if small else np.zeros(len(p), bool)) == (held & (away > by)))[clear].all()


def test_measures():
    square = polygons.box(0, 0, 10, 10)
    assert polygons.hausdorff(square, polygons.shape_of([[[[0, 0], [5, 0], [10, 0], [10, 10], [0, 10]]]])) == 0
    assert polygons.hausdorff(square, polygons.box(3, 4, 13, 14)) == 5
    ring = polygons.difference(square, polygons.box(2, 2, 4, 4))
    assert polygons.centroid(ring) == pytest.approx(((500 - 12) / 96, (500 - 12) / 96))
    assert polygons.is_valid(polygons.to_lists(ring)) and not polygons.is_valid([[[[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]]])
    assert len(polygons.split(ring, 5)) == 4 and polygons.inside(ring, np.array([polygons.representative_point(ring[0])]))[0]
    line = polygons.buffer_line(np.array([[0.0, 0], [4, 0]]), 1)
    assert polygons.area(line) == pytest.approx(8 + np.pi, abs=0.02)
    assert polygons.area(polygons.grow_then_shrink(polygons.union(polygons.box(0, 0, 2, 2), polygons.box(2.5, 0, 4, 2)), 0.5)) > 7.9
    sea = polygons.coast_to_sea([np.array([[0.3, 1.0], [0.3, 0.0]]), np.array([[0.6, 0.0], [0.6, 1.0]])])
    assert polygons.area(sea) == pytest.approx(0.7) or polygons.area(sea) == pytest.approx(0.3)
    island = np.array([[0.4, 0.4], [0.6, 0.4], [0.6, 0.6], [0.4, 0.6], [0.4, 0.4]])
    assert polygons.area(polygons.coast_to_sea([island])) == pytest.approx(0.96)


SHAPE = f"id long, shape {shapes.SHAPE}"


def _shapes(spark, *rows):
    return spark.createDataFrame([(i, polygons.to_lists(s)) for i, s in enumerate(rows)], SHAPE)


def test_fixed_boundary(spark):
    roi = polygons.to_lists(polygons.box(0, 0, 10, 10))
    out = evaluate.compare(_shapes(spark, polygons.box(1, 1, 3, 3)), _shapes(spark, polygons.box(1, 1, 3, 3), polygons.box(100, 100, 110, 110)), roi)
    assert out.objects["n_pred"] == 1 and out.areas["tn"] == pytest.approx(96) and out.areas["accuracy"] == pytest.approx(1)
    clipped = shapes.clip(_shapes(spark, polygons.box(-2, 1, 2, 3), polygons.box(10, 1, 11, 2)), roi)
    assert [round(r.area, 9) for r in shapes.measures(clipped).collect()] == [4.0]
    holed = polygons.to_lists(polygons.difference(polygons.box(0, 0, 10, 10), polygons.box(4, 0, 6, 10)))
    split = shapes.measures(shapes.clip(_shapes(spark, polygons.box(1, 1, 9, 2)), holed)).collect()
    assert [(len(r["shape"]), round(r.area, 9)) for r in split] == [(2, 6.0)]


def test_evaluation_from_files(spark, tmp_path):
    for name, s in (("roi", polygons.box(0, 0, 10, 10)), ("gt", polygons.box(1, 1, 3, 3)), ("pred", polygons.box(2, 1, 4, 3))):
        vectors.write_features(vectors.polygon_features(_shapes(spark, s)), f"{tmp_path}/{name}.geojson", 32637)
    paths = [f"{tmp_path}/{n}.geojson" for n in ("gt", "pred", "roi")]
    out = evaluate.evaluate(spark, *paths, 32637, output=f"{tmp_path}/report")
    assert out.areas["iou"] == pytest.approx(1 / 3) and out.areas["accuracy"] == pytest.approx(0.96) and out.areas["miou"] == pytest.approx((1 / 3 + 94 / 98) / 2)
    assert out.objects["tp"] == 0 and "Explicit evaluation boundary" in (tmp_path / "report.csv").read_text()
    assert (tmp_path / "report_boundary.geojson").exists() and "END OF REPORT" in (tmp_path / "report.txt").read_text() and (tmp_path / "report_per_building.csv").exists()
    with pytest.raises(ValueError, match="metres"):
        evaluate.evaluate(spark, *paths, 4326)
    hit = evaluate.evaluate(spark, *paths, 32637, iou_threshold=0.3)
    m = hit.matches.first()
    assert (m.gt_idx, round(m.iou, 6), round(m.centroid_dist_m, 6), round(m.hausdorff_m, 6)) == (0, 0.333333, 1.0, 1.0) and hit.ap50 == 0


def test_match_details_by_sampling(spark):
    a, b = polygons.box(0, 0, 10, 8), polygons.difference(polygons.box(1, 1, 12, 8), polygons.box(4, 3, 6, 5))
    df = spark.createDataFrame([(0, 0, polygons.to_lists(a), polygons.to_lists(b))], f"gt_idx long, pred_idx long, truth {shapes.SHAPE}, found {shapes.SHAPE}")
    got = shapes.match_details(df, 2.0).first()
    p = np.random.default_rng(3).uniform(-2, 14, (200_000, 2))
    away = lambda s: np.minimum.reduce([kernels.segment_distance(p, u, v) for ring in polygons.rings_of(s) for u, v in zip(ring, np.roll(ring, -1, axis=0), strict=True)])
    band, other, whole = away(a) < 1, away(b) < 1, polygons.inside(b, p)
    assert got.boundary_iou == pytest.approx((band & other).sum() / (band | other).sum(), abs=0.01)
    assert got.boundary_precision == pytest.approx((band & whole).sum() / whole.sum(), abs=0.01) and got.boundary_recall == pytest.approx((band & whole).sum() / band.sum(), abs=0.01)


def test_cleaning(spark):
    bow, ring = [[[[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 2.0], [0.0, 0.0]]]], polygons.to_lists(polygons.box(0, 0, 1, 1))
    df = spark.createDataFrame([(1, bow), (2, ring + polygons.to_lists(polygons.box(5, 5, 6, 6))), (3, None), (4, []), (5, [[[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]])], SHAPE)
    assert sorted((r.id, r.part) for r in shapes.clean(df).collect()) == [(2, 0), (2, 1)]
    fixed = {r.id: r.area for r in shapes.measures(shapes.repair(df)).collect()}
    assert fixed[1] == pytest.approx(1) and set(fixed) == {1, 2}
    with pytest.raises(ValueError):
        shapes.check_boundary(df, 32637, True)
    blockers = _shapes(spark, polygons.box(0.5, 0.5, 0.6, 0.6)).select("shape")
    assert [r.id for r in shapes.without_collisions(df.where("id in (2, 5)"), blockers, 4.0).collect()] == []
    scores = shapes.boundary_agreement(_shapes(spark, polygons.box(0, 0, 4, 4)), _shapes(spark, polygons.box(0, 0, 4, 4)), 1.0, 8.0).first()
    assert scores.f1 == pytest.approx(1)


@pytest.mark.parametrize("kind", ["geojson", "gpkg", "shp"])
def test_vector_files(spark, tmp_path, kind):
    ring = polygons.difference(polygons.box(0, 0, 4, 4), polygons.box(1, 1, 2, 2))
    rows = [(0, "Polygon", polygons.to_lists(ring), None, {"name": "é1"}), (1, "MultiPolygon", polygons.to_lists(ring + polygons.box(9, 9, 10, 10)), None, {}), (2, None, None, None, {"name": "x"})]
    df = spark.createDataFrame([("", *r[:1], None, *r[1:]) for r in rows], vectors.FEATURE)
    vectors.write_features(df, f"{tmp_path}/layer.{kind}", 32637)
    back = {r.fid: r for r in vectors.features(spark, f"{tmp_path}/layer.{kind}").collect()}
    for fid, held, shape, _, properties in rows:
        got = back[fid]
        assert got.kind == held and got.epsg == 32637 and dict(got.properties) == properties
        assert polygons.area(polygons.shape_of(got["shape"])) == pytest.approx(polygons.area(polygons.shape_of(shape))) if shape else got["shape"] is None
    assert not vectors.needs_reprojection(vectors.features(spark, f"{tmp_path}/layer.{kind}"), 32637)


def test_vector_folders_and_lines(spark, tmp_path):
    line = [[0.0, 0.0], [1.0, 2.0]]
    rows = [("", 0, None, "LineString", None, [line], {}), ("", 1, None, "MultiLineString", None, [line, line[::-1]], {})]
    vectors.write_features(spark.createDataFrame(rows, vectors.FEATURE), f"{tmp_path}/roads.shp", 4326)
    (tmp_path / "bad.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Blob", "coordinates": []}}, {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2, 3]}}]}))
    got = vectors.features(spark, str(tmp_path)).collect()
    assert sorted(r.kind for r in got) == ["LineString", "MultiLineString", "Point"] and {r.epsg for r in got} == {4326}
    assert vectors.first_shapefile(spark, str(tmp_path)).endswith("roads.shp") and vectors.missing_parts(spark, f"{tmp_path}/roads.*").first().missing == []
    (tmp_path / "roads.dbf").unlink()
    assert vectors.missing_parts(spark, f"{tmp_path}/roads.*").first().missing == [".dbf"]
    with pytest.raises(Exception, match="lacks .dbf"):
        vectors.features(spark, f"{tmp_path}/roads.shp").collect()
    lines = vectors.only(vectors.features(spark, f"{tmp_path}/bad.geojson"), vectors.LINEAR)
    assert lines.count() == 0
    plan = vectors.chunk_plan(0, 0, 1, 1)
    assert len(plan) == 4 and plan[-1] == (0.5, 0.5, 1.0, 1.0) and vectors.chunk_plan(0, 0, 0.5, 0.5) == [(0, 0, 0.5, 0.5)]
    twice = spark.createDataFrame(rows, vectors.FEATURE)
    assert vectors.merged_chunks([twice, twice]).count() == 2


def test_junctions_in_order(spark):
    r = random.Random(0)
    points = [(i, r.randint(0, 60) / 10, r.randint(0, 60) / 10) for i in range(300)]
    found = []
    expected = {}
    for i, x, y in points:
        first = next((j for j, u, v in found if abs(x - u) < 0.35 and abs(y - v) < 0.35), None)
        if first is None:
            found.append((i, x, y))
        expected[i] = i if first is None else first
    got = {p.id: p.junction for p in spatial.merge_junctions(spark.createDataFrame(points, "id long, lon double, lat double"), 0.35).collect()}
    assert got == expected


def test_groups_begin_beyond_their_heads(spark):
    values = [0.0, 0.4, 0.8, 5.0, 5.5, 5.6, 6.1, 20.0]
    got = sorted((r.v, r.group) for r in tiles.dedupe_coordinates(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), "v", 0.5).collect())
    assert got == list(zip(values, [0, 0, 1, 2, 2, 3, 3, 4], strict=True))


def test_tile_names(spark):
    names = {"tile_r3_c5.png": (3, 5), "R03c05": (3, 5), "tile_3_5": (3, 5), "a-12-7_x": (12, 7), "tile_7": None, "river3x": None, "xr1_c2": (1, 2)}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: (r.rc.a, r.rc.b) for r in df.select("n", tiles.row_col(F.col("n")).alias("rc")).collect()}
    assert got == {k: v or (None, None) for k, v in names.items()}
    flat = {"tile_0007.png": 7, "a.b_12": 12, "tile-3": 3, "tile_7.tar.gz": None, "tile7": None, "t_1_": None}
    df = spark.createDataFrame([(n,) for n in flat], "n string")
    assert {r.n: r.f for r in df.select("n", tiles.flat_index(F.col("n")).alias("f")).collect()} == flat
    assert tuple(spark.range(1).select(tiles.x_y(F.lit("tile_x512_y1024.tif")).alias("p")).first().p) == (512, 1024)


def test_boxes_of_very_different_sizes(spark):
    r = random.Random(2)
    make = lambda n, k: [(i, x := r.uniform(0, 1000), y := r.uniform(0, 1000), x + r.choice([0.5, 5, 400]) * k, y + r.choice([0.5, 5, 400])) for i in range(n)]  # noqa: E731, F841
    kind = "id long, xmin double, ymin double, xmax double, ymax double"
    one, two = make(80, 1), [*make(80, 2), (99, None, None, None, None)]
    got = sorted((x.id, x.r_id) for x in spatial.box_join(spark.createDataFrame(one, kind), spark.createDataFrame(two, kind), 2.0).collect())
    assert got == sorted((a[0], b[0]) for a in one for b in two[:-1] if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4])


def test_nodes_of_a_graph(spark):
    r = random.Random(4)
    edges = [(float(r.randint(0, 9)), float(r.randint(0, 9)), float(r.randint(0, 9)), float(r.randint(0, 9)), 1 << (i % 3)) for i in range(25)]
    cut = [tuple(x) for x in graph.noded(spark.createDataFrame(edges, "x1 double, y1 double, x2 double, y2 double, marker long"), 4.0).collect()]
    length = lambda es: sum(np.hypot(e[2] - e[0], e[3] - e[1]) for e in es)
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    for i, a in enumerate(cut):  # no two edges meet but at ends
        for b in cut[:i]:
            p, q, u, v = a[:2], a[2:4], b[:2], b[2:4]
            assert not (cross(p, q, u) * cross(p, q, v) < -1e-9 and cross(u, v, p) * cross(u, v, q) < -1e-9)
    assert length(cut) <= length(edges) + 1e-6 and len(cut) > 25
    nodes, named = graph.numbered(graph.noded(spark.createDataFrame(edges[:4], "x1 double, y1 double, x2 double, y2 double, marker long"), 4.0))
    assert graph.node_text(nodes, F.lit(1.0)).startswith(f"{nodes.count()} 2 1 0\n1 ") and graph.poly_text(nodes, named, [(0.5, 0.5)], [(1, 1, 7)]).rstrip().endswith("1 1.000000000 1.000000000 7")
    seeds = graph.seeds(_shapes(spark, polygons.box(0, 0, 4, 4))).first()
    assert 0 < seeds.x < 4 and 0 < seeds.y < 4


def test_mesh_text_reads_back(spark, tmp_path):
    nodes = spark.createDataFrame([(1, [0.0] * 5), (2, [1.0, 0.0, 0.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.5, 0.0, 0.0])], "id long, values array<double>")
    triangles = spark.createDataFrame([(1, [1, 2, 3], 6)], "id long, nodes array<long>, type long")
    (tmp_path / "a.mesh").write_text(graph.mesh_text(nodes, triangles))
    back, faces = readers.mesh(spark, f"{tmp_path}/a.mesh")
    assert [r["values"] for r in back.orderBy("id").collect()] == [r["values"] for r in nodes.collect()] and faces.first().nodes == [1, 2, 3]


def test_recut_triangles_cover(spark):
    triangles = spark.createDataFrame([(i, 10 * i, 10 * i + 1, 10 * i + 2) for i in range(8)], "id long, a long, b long, c long")
    sides = lambda i: [(10 * i, 10 * i + 1), (10 * i + 1, 10 * i + 2), (10 * i, 10 * i + 2)]
    coast = spark.createDataFrame([s for i in range(8) for k, s in enumerate(sides(i)) if i >> k & 1], "u long, v long")
    at = {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (0.0, 1.0)}
    place = lambda ids: np.mean([at[n % 10] for n in ids], axis=0)
    for i in range(8):
        parts = [r.corners for r in scenery.recut_triangles(triangles.where(f"id = {i}"), coast).collect()]
        areas = [abs(kernels.signed_area(np.array([place(c) for c in p]))) for p in parts]
        assert len(parts) == (1, 2, 3, 6)[bin(i).count("1")] and sum(areas) == pytest.approx(0.5) and min(areas) > 0.01
        cut = {tuple(c) for p in parts for c in p if len(c) == 2}
        assert all(s in cut for k, s in enumerate(sides(i)) if i >> k & 1)


def test_ring_points(spark):
    ways = spark.createDataFrame([(1, 10, 1, 2), (1, 11, 3, 2), (1, 12, 3, 1), (2, 20, 5, 6)], "relation long, way long, first long, last long")
    at = {1: (0.0, 0.0), 2: (2.0, 0.0), 3: (1.0, 2.0), 5: (9.0, 9.0), 6: (8.0, 8.0)}
    points = spark.createDataFrame([(w, s, *at[n]) for w, ns in ((10, (1, 2)), (11, (3, 2)), (12, (3, 1)), (20, (5, 6))) for s, n in enumerate(ns)], "way long, seq int, lon double, lat double")
    got = scenery.ring_points(ways, points).collect()
    assert len(got) == 1 and [tuple(p) for p in got[0].points] == [at[1], at[2], at[3], at[1]]


def test_kernels_on_tiles(spark):
    grid = np.zeros((6, 6))
    grid[1:5, 1:5] = 1
    grid[2:4, 2:4] = 0
    t = spark.createDataFrame([(1, grid.ravel().tolist()), (2, None)], "id int, px array<double>")
    out = {r.id: r["shape"] for r in tile_kernels.vectorise(t, ["id"], "px", 6, 0.5).collect()}
    assert polygons.area(polygons.shape_of(out[1])) == 12 and len(out[1]) == 1 and len(out[1][0]) == 2 and out[2] is None
    back = tile_kernels.rasterise(spark.createDataFrame([(1, out[1])], f"id int, shape {shapes.SHAPE}"), ["id"], "shape", 6, 6).first().mask
    assert back == grid.ravel().astype(int).tolist()
    slope = spark.createDataFrame([(1, [float(c) for _ in range(4) for c in range(5)])], "id int, px array<double>")
    n = np.array(tile_kernels.normals(slope, ["id"], "px", 5).first().normal).reshape(4, 5, 3)
    assert (n[..., 0] == round(127.5 * (1 - 2**-0.5))).all() and (n[..., 1] == 128).all()
    soft = np.array(tile_kernels.shore_blur(t.where("id = 1"), ["id"], "px", 6, 1).first().soft).reshape(6, 6)
    assert soft.max() <= 255 and soft[0, 0] < soft[1, 1]
    with pytest.raises(ValueError):
        tile_kernels.shore_blur(t, ["id"], "px", 6, 1, "mud")
    raw = [[10, 10, 4, 4, 0.9, 0.0], [10.5, 10, 4, 4, 0.8, 1.0], [30, 30, 40, 4, 0.7, 2.0], [5, 5, 2, 2, 0.1, 3.0]]
    d = tile_kernels.decode_detections(spark.createDataFrame([(1, [float(v) for r in raw for v in r])], "id int, raw array<double>"), ["id"], "raw", 6, (40, 40)).first()
    assert d.scores == [0.9, 0.7] and d.boxes[1] == [10.0, 28.0, 40.0, 32.0] and d.factors == [[0.0], [2.0]]
    mask = tile_kernels.detection_masks([[0, 0, 4, 4]], [[1.0]], np.full((1, 2, 2), 3.0), (8, 8))
    assert mask[:4, :4].min() > 0.9 and mask[4:].max() == 0
    way = spark.createDataFrame([(1, [float(k * k) for k in range(9)])], "id int, z array<double>")
    assert np.allclose(tile_kernels.smooth_ways(way, ["id"], "z", [1.0], degree=2).first().smooth, [k * k for k in range(9)])
    long = raster.pixels(spark.createDataFrame([(1, [0.0, 1.0, 2.0, -1.0])], "id int, px array<double>"), "px", 2)
    p = spark.createDataFrame([(1, 0.4, 0.6), (1, 0.9, 0.9)], "id int, x double, y double")
    assert sorted(r.value or 0 for r in raster.sample_nearest(p, long, ["id"], -1.0).collect()) == [0, 2.0]


def test_choices_and_placement(spark):
    df = spark.createDataFrame([(3, "a"), (None, "b"), (7, "c")], "id long, name string")
    got = {r.id: r.f for r in placement.seeded_choice(df, "id", ["x", "y", "z"], "f").collect()}
    assert got == {None: None, 3: random.Random(3).choice(["x", "y", "z"]), 7: random.Random(7).choice(["x", "y", "z"])}
    m = [r.m for r in df.select(placement.material_index(F.col("name"), F.lit(1.25), F.lit(-3.5), 5).alias("m")).collect()]
    assert all(0 <= x < 5 for x in m)
    faces = spark.range(1).select(placement.box_faces(F.lit(4.0), F.lit(3.0), F.lit(2.0), 0.5).alias("f")).first().f
    assert [(f.face, f.u, f.v) for f in faces][:3] == [("front", 2.0, 1.5), ("back", 2.0, 1.5), ("left", 1.0, 1.5)]
    line = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)],)], "line array<struct<x: double, y: double>>")
    edges = line.select(placement.ribbon(F.col("line"), 1.0).alias("e")).first().e
    assert [tuple(round(v, 6) for v in e) for e in edges] == [(0, 1, 0, -1), (3, 1, 5, -1), (3, 4, 5, 4)]
    with pytest.raises(ValueError):
        placement.detect("none", df)


def test_recorder_and_memory(spark):
    f = spark.createDataFrame([(0.01 * (k % 7 + 1), k * 2**20) for k in range(250)], "dt double, used long")
    s = frames.recorder_summary(f, "dt", memory=("used",)).first()
    times = sorted((0.01 * (k % 7 + 1) for k in range(250)), reverse=True)
    assert s.frames == 250 and s.one_percent_low_fps == pytest.approx(3 / sum(times[:3])) and s.used_mb == 249.0
    late = frames.after_warm_up(f.withColumn("n", F.monotonically_increasing_id()), "dt", ("n",), 1.0, 2.0)
    expected, total = 0, 0.0
    for k in range(250):
        total += 0.01 * (k % 7 + 1)
        expected += 1.0 - 1e-9 <= total < 3.0 - 1e-9
    assert abs(late.count() - expected) <= 1


def test_scenery_files(spark, tmp_path):
    s = scenery_files.Scenery({"sim/west": "36", "sim/planet": "earth"}, ["a.ter", "b.ter"], {"elevation": np.arange(6, dtype=np.int16).reshape(2, 3), "bathymetry": np.full((2, 3), 3, np.int16)}, [np.array([[0, 1, 65535], [7, 8, 9]], np.uint16), np.zeros((1, 2), np.uint16)], [[(1.0, 36.0), (1.0, 37.0), (100.0, 0.0)], [(1.0, 0.0), (1.0, 0.0)]], [(1, [(0, k % 2) for k in range(300)]), (0, [(0, 0), (1, 0), (0, 1)])])
    data = scenery_files.write_scenery(s)
    back = scenery_files.read_scenery(data)
    assert back.properties == s.properties and back.terrains == s.terrains and back.patches == s.patches and all((a == b).all() for a, b in zip(back.pools, s.pools, strict=True))
    assert back.points(0)[0].tolist() == pytest.approx([36.0, 37 + 1 / 65535, 100.0])
    for bad in (b"7z" + data, data[:-1] + b"x", data[:40]):
        with pytest.raises(ValueError):
            scenery_files.read_scenery(bad)
    (tmp_path / "t.dsf").write_bytes(data)
    assert {r.name: r.px for r in scenery_files.scenery_rasters(spark, f"{tmp_path}/t.dsf").collect()} == {"elevation": [0, 1, 2, 3, 4, 5], "bathymetry": [-2, -1, 0, 1, 2, 3]}
    (tmp_path / "o.obj").write_text("I\n800\nOBJ\nVT 0 0 0 0 1 0 0 0\nVT 10 0 0 0 1 0 0 0\nVT 0 2 10 0 1 0 0 0\nIDX10 0 1 2 2 1 0 0 1 2 0\nTRIS 0 6\n")
    corners = scenery_files.object_triangles(spark, f"{tmp_path}/o.obj")
    assert [(r.triangle, r.corner, r.x, r.y, r.z) for r in corners.orderBy("triangle", "corner").collect()][:4] == [(0, 0, 0, 0, 0), (0, 1, 10, 0, 0), (0, 2, 0, 2, 10), (1, 0, 0, 2, 10)]
    placed = scenery_files.placed_object(corners, 37.5, 36.5, 100.0, 90.0, 37, 36).where("triangle = 0 and corner = 1").first()
    assert placed.tile_z == 100.0 and placed.tile_y == pytest.approx(0.5 - 10 / 111120, abs=1e-6) and placed.tile_x == pytest.approx(0.5, abs=1e-6)
    (tmp_path / "m.xml").write_text('<a xmlns:ows="u"><TileMatrixSet><ows:Identifier>s</ows:Identifier><TileMatrix><ows:Identifier>0</ows:Identifier><ScaleDenominator>5</ScaleDenominator></TileMatrix></TileMatrixSet></a>')
    m = scenery_files.tile_matrices(spark, f"{tmp_path}/m.xml").first()
    assert (m.matrix_set, m.identifier, m.fields) == ("s", "0", {"ScaleDenominator": "5"})
    assert scenery_files.settings("zoom=17\nname = 'x'\nmask=True\nlist=[1, 2]\nother=__import__('os')\n", {"zoom": int, "name": str, "mask": bool, "list": list}) == {"zoom": 17, "name": "x", "mask": True, "list": [1, 2]}
    with pytest.raises(ValueError):
        scenery_files.settings("mask=perhaps", {"mask": bool})


def test_packages_and_texts(spark, tmp_path):
    for name in ("tiles_rgb", "tiles_height"):
        (tmp_path / "src" / name).mkdir(parents=True)
        (tmp_path / "src" / name / "a").write_text("x")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old").write_text("y")
    assert scenery_files.export_package(spark, f"{tmp_path}/src", f"{tmp_path}/out", ["tiles_rgb"], ["tiles_height", "none"]) == ["tiles_rgb", "tiles_height"]
    assert (tmp_path / "out" / "tiles_rgb" / "a").exists() and not (tmp_path / "out" / "old").exists()
    with pytest.raises(FileNotFoundError):
        scenery_files.export_package(spark, f"{tmp_path}/src", f"{tmp_path}/out", ["missing"])
    assert (tmp_path / "out" / "tiles_rgb" / "a").exists()
    (tmp_path / "packs.ini").write_text("I\n1000 Version\nSCENERY\n\nSCENERY_PACK Custom Scenery/b/\n")
    for _ in range(2):
        text = scenery_files.install_package(spark, f"{tmp_path}/packs.ini", "a")
    assert [x for x in text.split("\n") if x.startswith("SCENERY_PACK")] == ["SCENERY_PACK Custom Scenery/a/", "SCENERY_PACK Custom Scenery/b/"]
    texts = scenery_files.package_texts("Old Town 7", 37.0, 36.0, ["f/b.fac", "f/a.fac"])
    assert " OLDT Old Town 7" in texts["Earth nav data/apt.dat"] and texts["library.txt"].index("a.fac") < texts["library.txt"].index("b.fac")
    assert "LOAD_CENTER 37.00000" in scenery_files.terrain_text("a.dds", 37.0, 36.0, 16, 2000)
    forest = spark.createDataFrame([("t", 1, "x.for", 200, polygons.to_lists(polygons.difference(polygons.box(0, 0, 4, 4), polygons.box(1, 1, 2, 2))))], f"tile string, id long, forest string, density int, shape {shapes.SHAPE}")
    body = writers.forest_text(forest, ["tile"]).first().text.split("\n")
    assert body[:3] == ["POLYGON_DEF x.for", "BEGIN_POLYGON 0 200 2", "BEGIN_WINDING"] and body.count("BEGIN_WINDING") == 2 and body[-1] == "END_POLYGON"
    nodes = spark.createDataFrame([(1, 1.5, 2.25)], "id long, lon double, lat double")
    ways = spark.createDataFrame([(9, [1, 1], {"b": "2", "a": "1"})], "id long, refs array<long>, tags map<string, string>")
    n, w = writers.osm_rows(nodes, ways)
    assert n.first()._lon == "1.5000000" and [t._k for t in w.first().tag] == ["a", "b"]
    writers.write_osm(nodes, ways, f"{tmp_path}/osm")
    assert readers.osm(spark, f"{tmp_path}/osm/node")[0].first().lon == 1.5
    defs = spark.createDataFrame([(0, "lib/forest.for"), (1, "lib/road.net")], "number int, name string")
    assert [r.number for r in writers.drop_named(defs, ["forest"]).collect()] == [0] and [r.number for r in writers.drop_named(defs, ["!forest"]).collect()] == [1]
    pts = spark.createDataFrame([(1, 2, 0, "dirt", 3.0, s, s / 2.0, 0.5) for s in (1, 0)], "tile_x int, tile_y int, road int, type string, width_m double, seq int, u double, v double")
    doc = json.loads(scenery_files.road_documents(pts, F.lit(100.0), F.lit(90.0)).first().json)
    assert doc["roads"][0]["points"] == [{"u": 0.0, "v": 0.5}, {"u": 0.5, "v": 0.5}] and doc["width_m"] == 100.0


def test_levels_by_triangles(spark):
    mesh = spark.createDataFrame([(1, [3.0, 6.0, 9.0, -4.0, 5.0], [0.0, 0.0, 0.0, 0.0, 50.0], [[0, 1, 2], [1, 2, 3], [2, 3, 4]], ["water", "sea", "drawn"])], "id int, z array<double>, drawn array<double>, triangles array<array<int>>, kinds array<string>")
    assert tile_kernels.leveled(mesh, ["id"], 1).first().levels == [6.0, 0.0, 0.0, 0.0, 50.0]
    assert tile_kernels.leveled(mesh, ["id"], 1, "clamp").first().levels == [6.0, 6.0, 0.0, 0.0, 50.0]
    assert tile_kernels.leveled(mesh, ["id"], 0, "mean").first().levels == pytest.approx([3.0, 11 / 3, 0.0, 0.0, 50.0])


def test_resampling(spark):
    ramp = spark.createDataFrame([(1, [float(r * 2 + c) for r in range(5) for c in range(5)])], "id int, px array<double>")
    for how in ("bilinear", "cubic"):
        fine = np.array(tile_kernels.resampled(ramp, ["id"], "px", 5, (9, 9), how).first().fine).reshape(9, 9)
        assert np.allclose(fine[2:7, 2:7], [[r + c / 2 for c in range(2, 7)] for r in range(2, 7)])
    near = np.array(tile_kernels.resampled(ramp, ["id"], "px", 5, (3, 3), "nearest").first().fine).reshape(3, 3)
    assert near.tolist() == [[0, 2, 4], [4, 6, 8], [8, 10, 12]]


def test_running_sums_and_percentiles(spark):
    r = random.Random(9)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, r.randint(0, 9), r.random() if i % 11 else float("nan")) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i int, n int, v double").repartition(5)
    got = {x.i: x.before for x in _order.running(df, ["i"], "n", "before", ("k",)).collect()}
    sums: dict = {}
    for k, i, n, _ in rows:
        assert got[i] == sums.get(k, 0)
        sums[k] = sums.get(k, 0) + n
    for x in _order.percentiles(df, "v", [0.0, 0.3, 0.5, 1.0], ("k",)).collect():
        own = [v for k, _, _, v in rows if k == x.k and v == v]
        assert x.n == len(own) and np.allclose(x.q, np.percentile(own, [0, 30, 50, 100]))


def test_documents_and_runs(spark, tmp_path):
    b = spark.createDataFrame([(1, 2, 7, 1.5, "Building"), (1, 2, 3, 2.5, "Building"), (4, 4, 1, 0.5, "Hut")], "tile_x int, tile_y int, id int, center_x double, class string")
    docs = [json.loads(x.json) for x in scenery_files.building_documents(b, ["tile_x", "tile_y"]).orderBy("tile_x").collect()]
    (tmp_path / "b.json").write_text(json.dumps({"tileBuildingsList": docs}))
    assert docs[0]["total_buildings"] == 2 and [x["id"] for x in docs[0]["buildings"]] == [3, 7]
    assert sorted((x.tile_x, x.id, x.center_x) for x in readers.buildings(spark, f"{tmp_path}/b.json").collect()) == [(1, 3, 2.5), (1, 7, 1.5), (4, 1, 0.5)]
    green = spark.createDataFrame([("a", [0.9, 0.1, 0.8, 0.7]), ("b", [0.0] * 4)], "tile string, px array<double>")
    out = runs.plant_trees(green, spark.createDataFrame([("a", [1, 0, 0, 0])], "tile string, px array<int>"), 2, 2, limit=0.5, density=1.0)
    assert tuple(out.counters.first()) == (2, 2, 2) and sorted((p.x, p.y) for p in out.positions.collect()) == [(0.25, 0.75), (0.75, 0.75)]
    assert json.loads(out.documents.first().json)["a"][0] == {"x": 0.25, "y": 0.75}
    assert runs.for_each(green, lambda t: t.select("tile"), 3).count() == 2


def test_nearest_over_several_ranges(spark):
    """Numbers of nodes go on from range to range, also where ranges are read as part of a union."""
    r = random.Random(3)
    nodes, values = sorted({r.randint(0, 40_000) / 4 for _ in range(3000)}), sorted({r.randint(0, 40_000) / 4 for _ in range(3000)})
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scenery.nearest(spark.createDataFrame([(v,) for v in [*values, None]], "v double"), "v", spark.createDataFrame([(v,) for v in [*nodes, None]], "at double"), "at").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {x.v: x.idx for x in out} == {None: None} | {v: min(range(len(nodes)), key=lambda k: (abs(nodes[k] - v), k)) for v in values}


def test_junctions_of_many_points_at_few_places(spark, monkeypatch):
    """Places that all points share, chains that cross blocks, and points without a place."""
    monkeypatch.setattr(spatial, "_BLOCK", 2)
    r = random.Random(5)
    points = [(i, r.randint(0, 30) / 10, r.randint(0, 3) / 10) for i in range(400)] + [(400 + i, 5 + i / 10, 0.0) for i in range(60)]
    found, expected = [], {}
    for i, x, y in points:
        first = next((j for j, u, v in found if abs(x - u) < 0.15 and abs(y - v) < 0.15), None)
        if first is None:
            found.append((i, x, y))
        expected[i] = i if first is None else first
    odd = [(900, None, 0.0), (901, float("nan"), 0.0), (902, float("inf"), 0.0), (903, float("inf"), 0.0)]
    asked = []
    settle = spatial._lineage.settle
    monkeypatch.setattr(spatial._lineage, "settle", lambda df: asked.append(df) or settle(df))
    same = [(1000 + k, *points[k % 460][1:]) for k in range(4600)]
    got = {p.id: p.junction for p in spatial.merge_junctions(spark.createDataFrame(points + odd + same, "id long, lon double, lat double"), 0.15).collect()}
    assert got == expected | {i: i for i, *_ in odd} | {i: expected[(i - 1000) % 460] for i, *_ in same}
    assert all("to" not in df.columns for df in asked)  # pairs of points are never made


def test_warp_on_whole_places_is_exact():
    grid = np.array([[0.0078125, -0.0234375, 3.0000005, 0.1, 0.2, 0.3, 1.0078125, np.inf]] * 2)
    cols = np.linspace(0, 1, 8)
    mesh = kernels.resample(np.array([[7.0, 0.0], [7.0, 0.0]]), np.zeros((1, 8)), cols[None])
    assert (kernels.resample(grid, np.zeros((1, 8)), mesh)[0] == grid[0][::-1]).all()


def _convex(n, seed):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        t = np.sort(r.uniform(0, 2 * np.pi, r.integers(3, 8)))
        out.append(polygons.shape_of([[np.column_stack([5 * np.cos(t), 3 * np.sin(t)]) + r.uniform(-2, 2, 2)]]))
    return out + [polygons.box(x, y, x + 4, y + 5) for x, y in r.integers(0, 4, (6, 2)).astype(float)]


@pytest.mark.parametrize("name", ["boundary_scores", "match_details", "buffered", "split", "dissolve"])
def test_convex_shapes_are_worked_on_together(spark, name):
    """Batches of convex shapes fare as each by itself does; the other shapes go the general way."""
    one, two = _convex(12, 1), _convex(12, 2)
    holed = polygons.difference(polygons.box(0, 0, 9, 9), polygons.box(2, 2, 4, 4))
    if name == "boundary_scores":
        p, q = (np.array([[0.0, 0], [5, 0], [6, 4], [1, 5]]), np.array([[1.0, 1], [6, 0], [7, 6]]))
        assert convex.band_scores(convex.grown(p[None], 0.5, steps=8), convex.shrunk(p[None], 0.5), convex.grown(q[None], 0.5, steps=8), convex.shrunk(q[None], 0.5), q[None])[0][0] > 0
        df = spark.createDataFrame([(1, p.tolist(), q.tolist()), (2, p[::-1].tolist(), q.tolist())], "id long, truth array<array<double>>, found array<array<double>>")
        a, b = tile_kernels.boundary_scores(df, ["id"], "truth", "found", 1.0).collect()
        assert tuple(a)[1:] == pytest.approx(tuple(b)[1:]) and 0 < a.boundary_iou < 1
    elif name == "match_details":
        rows = [(k, polygons.to_lists(a), polygons.to_lists(b)) for k, (a, b) in enumerate(zip([*one, holed], [*two, holed], strict=True))]
        got = {r.id: r for r in shapes.match_details(spark.createDataFrame(rows, f"id long, truth {shapes.SHAPE}, found {shapes.SHAPE}"), 1.0).collect()}
        for k, (a, b) in enumerate(zip([*one, holed], [*two, holed], strict=True)):
            both, left, right = polygons.shared_areas(polygons.boundary_band(a, 1.0), polygons.boundary_band(b, 1.0))
            assert got[k].boundary_iou == pytest.approx(both / (both + left + right)) and got[k].hausdorff_m == pytest.approx(polygons.hausdorff(a, b))
    elif name == "dissolve":
        import pyarrow as pa

        a, b = (pa.array([polygons.to_lists(s) for s in x], pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))) for x in (one, two))
        hits = {int(k): v for rows, p, q in convex.convex_pairs(a, b) for k, v in zip(rows, convex.shared(p, q), strict=True)}
        assert hits == {k: pytest.approx(polygons.shared_areas(x, y)[0]) for k, (x, y) in enumerate(zip(one, two, strict=True))}
        same = _shapes(spark, *[polygons.box(0, 0, 2, 2)] * 40, polygons.box(1, 1, 3, 3), polygons.box(3, 1, 4, 2), [])
        assert {r.id: polygons.area(polygons.shape_of(r["shape"])) for r in shapes.dissolve(same, 4.0).collect()} == {0: 7.0, 41: 1.0, 42: 0.0}
    else:
        df = _shapes(spark, *one, holed, polygons.box(0, 0, 1, 1), [])
        for by in (1.0, -0.5):
            if name == "buffered":
                out = shapes.buffered(df, by).collect()
                got, expected = {r.id: polygons.area(polygons.shape_of(r["grown"])) for r in out}, [polygons.area(polygons.buffer(s, by)) for s in [*one, holed, polygons.box(0, 0, 1, 1), []]]
                assert [got[k] for k in range(len(expected))] == pytest.approx(expected)
        if name == "split":
            got = [(r.id, polygons.bounds(polygons.shape_of(r["shape"]))) for r in shapes.split(df, 1.5).collect()]
            for k, s in enumerate([*one, holed]):
                assert np.array([b for i, b in got if i == k]) == pytest.approx(np.array([polygons.bounds(p) for p in polygons.split(s, 1.5)]))


def _many_features(n):
    """Features whose bytes are of all kinds, among them line feeds (10.0 and 2570.0 hold none, whole numbers as 10 do as sizes)."""
    rng = np.random.default_rng(7)
    rows = []
    for k in range(n):
        x, y = rng.integers(0, 5000, 2)
        shape = polygons.to_lists(polygons.box(float(x), float(y), float(x + 1 + k % 7), float(y + 2))) + (polygons.to_lists(polygons.box(9000.1, 9000.3, 9001.0, 9002.0)) if k % 5 == 0 else [])
        rows.append(("", k, None, "MultiPolygon" if k % 5 == 0 else "Polygon", shape, None, {"id": str(k), "name": f"é\n{k}"} if k % 3 else {"id": str(k)}) if k % 11 else ("", k, None, None, None, None, {"id": str(k)}))
    return rows


@pytest.mark.parametrize("kind", ["geojson", "gpkg", "shp"])
def test_vector_files_by_stretches(spark, tmp_path, monkeypatch, kind):
    rows = _many_features(3000)
    df = spark.createDataFrame(rows, vectors.FEATURE).repartition(5)
    monkeypatch.setattr(vectors, "STRETCH", 5000)
    # No row of the layer may come to the driver by a collect(): only figures of stretches do.
    collect, most = type(df).collect, []
    monkeypatch.setattr(type(df), "collect", lambda self: most.append(collect(self)) or most[-1])
    vectors.write_features(df, f"{tmp_path}/layer.{kind}", 32637)
    assert max(map(len, most), default=0) < 10
    whole = vectors.features(spark, f"{tmp_path}/layer.{kind}")
    held = {r.fid: r for r in collect(whole)}
    for fid, kept, shape, properties in ((r[1], r[3], r[4], r[6]) for r in rows):
        got = held[fid]
        assert (got.kind, got["shape"] and len(got["shape"]), dict(got.properties), got.epsg) == (kept, shape and len(shape), properties, 32637)
        assert shape is None or polygons.area(polygons.shape_of(got["shape"])) == pytest.approx(polygons.area(polygons.shape_of(shape)))
    monkeypatch.setattr(vectors, "WHOLE_BYTES", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        assert sorted(map(str, collect(vectors.features(spark, f"{tmp_path}/layer.{kind}")))) == sorted(map(str, held.values()))
        assert sorted(map(str, collect(vectors.features(spark, str(tmp_path))))) == sorted(map(str, held.values()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_geojson_of_other_layouts(spark, tmp_path, monkeypatch):
    one = lambda k: {"type": "Feature", "properties": {"n": k}, "geometry": {"type": "Point", "coordinates": [k, 1]}}
    features = [one(0), {"type": "Feature", "geometry": {"type": "Blob", "coordinates": []}}, *map(one, range(2, 300))]
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "features": features}
    lines = ",\n".join(map(json.dumps, features))
    texts = {"line": json.dumps(doc), "pretty": json.dumps(doc, indent=1), "rows": '{\n"type": "FeatureCollection",\n"crs": ' + json.dumps(doc["crs"]) + ',\n"features": [\n' + lines.replace("\n", "\n\n", 3) + "\n]\n}\n", "late": '{"type": "FeatureCollection", "features": [\n' + lines + '\n],\n"crs": ' + json.dumps(doc["crs"]) + "}"}
    for name, text in texts.items():
        (tmp_path / f"{name}.geojson").write_text(text)
    whole = sorted(map(str, vectors.features(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(vectors, "WHOLE_BYTES", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = vectors.features(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(str, got)) == whole and len(got) == 4 * 299 and {r.epsg for r in got} == {3857}
