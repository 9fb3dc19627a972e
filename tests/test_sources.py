"""Readers and writers on small files, and the evaluation cases of the survey."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.functions import features, geodesy
from terravane.operators import evaluation, frames, spatial, tiles
from terravane.sources import codecs, readers, writers
from terravane.streaming import frames as stream_frames


def _write(path, text):
    path.write_text(text if isinstance(text, str) else json.dumps(text))
    return str(path)


def test_json_sources(spark, tmp_path):
    b = {"id": 1, "center_x": 1.5, "confidence": 0.9, "class": "building", "corner_points": [[0, 0], [1, 0], [1, 1]]}
    path = _write(tmp_path / "b.json", {"tileBuildingsList": [{"tile_x": 3, "tile_y": 4, "buildings": [b, {"id": 2}]}, {"tile_x": 5, "tile_y": 6, "buildings": []}]})
    rows = readers.buildings(spark, path).collect()
    assert [(r.tile_x, r.id, r.center_x) for r in rows] == [(3, 1, 1.5), (3, 2, None)]
    ring = [[0, 0], [1, 0], [1, 1]]
    path = _write(tmp_path / "s.json", {"tiles": [{"source_file": "a", "buildings": [{"id": 1, "confidence": 0.91237, "polygon_wgs84": ring}, {"id": 2, "confidence": 0.9, "polygon_wgs84": ring[:2]}]}, {"group_id": "g", "source_files": ["b", "c"], "buildings": [{"id": 3, "confidence": 0.2, "polygon_wgs84": ring}]}]})
    assert [r.source for r in readers.segmentation(spark, path).collect()] == ["a", "a", "b+c"]
    assert [(r.id, r.confidence) for r in readers.confident(readers.segmentation(spark, path), 0.5).collect()] == [(1, 0.9124)]
    path = _write(tmp_path / "r.json", {"tile_x": 1, "tile_y": 2, "roads": [{"type": "dirt", "width_m": 3, "points": [{"u": 0, "v": 0.5}, {"u": 1, "v": 0.5}]}]})
    assert [(r.road, r.seq, r.u) for r in readers.roads(spark, path).collect()] == [(0, 0, 0.0), (0, 1, 1.0)]
    path = _write(tmp_path / "p.json", {"tile_0_0": [{"x": 0.5, "y": 0.25}], "tile_0_1": []})
    assert [tuple(r) for r in readers.positions(spark, path).collect()] == [("tile_0_0", 0.5, 0.25)]
    path = _write(tmp_path / "m.json", {"global_min_elevation": 1.0, "tiles": [{"tile_x": 7, "tile_y": 8}]})
    assert readers.tile_metadata(spark, path).first().name == "7_8"


def test_frame_data(spark, tmp_path):
    path = _write(tmp_path / "Data.txt", "f-act,_/sec | _time |\n\n 30.0 | 1 |\n bad | 2 |\n 40 | 3 | 4 |\n 50 | 5 |\n0|6|\n")
    rows = readers.frame_data(spark, path)
    headers = rows.first().headers
    assert headers == ["f-act,_/sec", "_time"] and frames.fps_column(headers) == headers[0]
    s = frames.fps_summary(frames.positive_rates(rows, headers), "fps").first()
    assert (s.sample_count, s.average_fps, s.one_percent_low_fps, s.min_fps, s.max_fps) == (2, 40.0, 30.0, 30.0, 50.0)
    with pytest.raises(ValueError):
        frames.fps_column(["time"])
    assert frames.fps_column(["disk,_KB/sec", "f-act,_/sec"]) == "f-act,_/sec" and frames.fps_column(["fpsx", "Frame  time rate"]) == "Frame  time rate" and frames.fps_column(["my_FPS"]) == "my_FPS"
    _write(tmp_path / "Data2.txt", "_time | frame rate |\n1 | 20 |\n")
    both = readers.frame_data(spark, str(tmp_path / "Data*.txt")).select("headers").distinct().collect()
    assert sorted(r.headers for r in both) == [["_time", "frame rate"], ["f-act,_/sec", "_time"]]


def test_osm(spark, tmp_path):
    path = _write(tmp_path / "o.osm", '<osm><node id="1" lon="1.5" lat="2.5"/><node id="2" lon="3" lat="4"/><node id="3" lon="1.5" lat="2.5"/><way id="9"><nd ref="1"/><nd ref="2"/><nd ref="7"/><tag k="highway" v="path"/></way><way id="8"><nd ref="2"/></way><relation id="5"><member type="way" ref="9" role="outer"/></relation></osm>')
    nodes, ways, relations = readers.osm(spark, path)
    assert sorted((r.id, r.first_id) for r in nodes.collect()) == [(1, 1), (2, 2), (3, 1)]
    assert sorted(tuple(r) for r in readers.way_points(ways, nodes).collect()) == [(8, 0, 3.0, 4.0), (9, 0, 1.5, 2.5), (9, 1, 3.0, 4.0)]
    assert [r.id for r in readers.without_tags(ways, ["highway"]).collect()] == [8]
    assert relations.first().members[0]._role == "outer"


def test_mesh(spark, tmp_path):
    path = _write(tmp_path / "t.mesh", "1.3\n3\n0 0 0 0 0\n1 0 0 0 0\n0 1 0.5 0 0\n1\n1 2 3 6\n")
    nodes, triangles = readers.mesh(spark, path)
    assert [r["values"][2] for r in nodes.orderBy("id").collect()] == [0.0, 0.0, 0.5]
    assert [tuple(r)[1:] for r in triangles.collect()] == [(1, [1, 2, 3], 6)]
    _write(tmp_path / "u.mesh", "1.3\n2\n5 5 1 0 0\n6 6 2 0 0\n1\n1 2 1 7\n")
    nodes, triangles = readers.mesh(spark, str(tmp_path / "*.mesh"))
    assert sorted((r.file[-6:], r.id, r["values"][2]) for r in nodes.collect()) == [("t.mesh", 1, 0.0), ("t.mesh", 2, 0.0), ("t.mesh", 3, 0.5), ("u.mesh", 1, 1.0), ("u.mesh", 2, 2.0)]
    path = _write(tmp_path / "t.1.ele", "# made\n2 3 0\n1 7 8 9\n2 8 9 10 # end\n")
    assert [(r.id, r["values"]) for r in readers.node_table(spark, path).orderBy("id").collect()] == [(1, [7.0, 8.0, 9.0]), (2, [8.0, 9.0, 10.0])]


def test_images(spark, tmp_path):
    image = np.arange(12, dtype=np.uint8).reshape(3, 4)
    (tmp_path / "a.png").write_bytes(codecs.write_png(image))
    (tmp_path / "a.tif").write_bytes(codecs.write_tiff(image[None].astype(np.int16), (1.0, 2.0, 0.5, 0.5), 4326))
    for kind in ("png", "tiff"):
        r = readers.images(spark, str(tmp_path / f"a.{kind[:3]}"), kind).first()
        assert (r.height, r.width, r.px) == (3, 4, list(map(float, range(12))))
    assert r.epsg == 4326 and r.transform == [1.0, 2.0, 0.5, 0.5]
    windows = readers.images(spark, str(tmp_path / "a.tif"), "tiff", tile=2, overlap=1, fill=-1.0).orderBy("row", "col").collect()
    assert [(w.row, w.col, w.height, w.width) for w in windows] == [(0, 0, 3, 3), (0, 2, 3, 3), (2, 0, 3, 3), (2, 2, 3, 3)]
    assert windows[0].px == [0, 1, 2, 4, 5, 6, 8, 9, 10] and windows[3].px == [10, 11, -1, -1, -1, -1, -1, -1, -1] and windows[3].transform == [2.0, 1.0, 0.5, 0.5]
    few = readers.images(spark, str(tmp_path / "a.tif"), "tiff", decimate=2).first()
    assert few.px == [0, 2, 8, 10] and few.transform[2] == 1.0
    b = readers.image_bounds(readers.images(spark, str(tmp_path / "a.tif"), "tiff", bands=3)).first()
    assert (b.west, b.north, b.east, b.south) == (1.0, 2.0, 3.0, 0.5)
    (tmp_path / "two.tif").write_bytes(codecs.write_tiff(np.zeros((2, 2, 2), np.uint8)))
    with pytest.raises(Exception, match="neither one nor three"):
        readers.images(spark, str(tmp_path / "two.tif"), "tiff", bands=3).collect()
    tiles_ = spark.createDataFrame([(0,), (1,)], "tile int")
    masks = readers.occupancy(tiles_, spark.createDataFrame([(0, codecs.write_png(image))], "tile int, content binary"), ["tile"], 4, 3).orderBy("tile").collect()
    assert [m.mask for m in masks] == [[0] + [1] * 11, [0] * 12]


def test_heights_and_catalogue(spark, tmp_path):
    grid = np.arange(9, dtype=">i2").reshape(3, 3)
    (tmp_path / "N37E036.hgt").write_bytes(grid.tobytes())
    (tmp_path / "S01W002.hgt").write_bytes(b"123")
    rows = {(r.lat, r.lon): r.px for r in readers.heights(spark, str(tmp_path / "*.hgt"), "hgt").collect()}
    assert rows[(37, 36)] == list(map(float, range(9))) and set(rows[(-1, -2)]) <= {0.0}
    (tmp_path / "a.raw").write_bytes(grid.astype("<i2").tobytes())
    assert readers.heights(spark, str(tmp_path / "a.raw"), "raw").first().px == [6, 7, 8, 3, 4, 5, 0, 1, 2]
    for layer in ("dem.tif", "water.shp", "notes"):
        (tmp_path / "root" / "37" / "-36").mkdir(parents=True, exist_ok=True)
        (tmp_path / "root" / "37" / "-36" / layer).write_bytes(b"x")
    assert sorted(tuple(r)[1:] for r in readers.catalogue(spark, str(tmp_path / "root")).collect()) == [(37, -36, "dem", "tif"), (37, -36, "water", "shp")]
    px = spark.createDataFrame([([1.0, -9999.0, 32767.0, 5.0],)], "px array<double>")
    assert px.select(readers.local_heights(F.col("px"), F.lit(2.0), F.lit(1.0), F.lit(5.0)).alias("h")).first().h == [3.0, -32768.0, -32768.0, -32768.0]


def test_scenery_text(spark):
    roads = spark.createDataFrame([("t", 1, 50, 1, 29.0, 41.0), ("t", 1, 50, 2, 29.1, 41.0), ("t", 1, 50, 3, 29.2, 41.0), ("t", 2, 30, 1, 29.5, 41.5), ("t", 3, 30, 1, 1.0, 1.0), ("t", 3, 30, 2, 2.0, 2.0)], "tile string, road int, subtype int, seq int, lon double, lat double")
    lines = writers.network_text(roads, ["tile"]).first().text.split("\n")
    assert [x.split()[0] for x in lines] == ["BEGIN_SEGMENT", "SHAPE_POINT", "END_SEGMENT", "BEGIN_SEGMENT", "END_SEGMENT"]
    assert lines[0].startswith("BEGIN_SEGMENT 0 50 1 29.000000000") and lines[3].split()[3] == "3"
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(["A", "BEGIN_POLYGON 3 0", "p", "BEGIN_POLYGON 4 0", "q"])], "file string, n int, line string")
    assert [r.line for r in writers.drop_blocks(lines, "BEGIN_POLYGON", [3]).orderBy("n").collect()] == ["A", "BEGIN_POLYGON 4 0", "q"]
    ring = spark.createDataFrame([(1, [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]])], "id int, ring array<array<double>>")
    assert json.loads(writers.geojson(ring, "id", "ring").first().json)["geometry"]["coordinates"][0][-1] == [0.0, 0.0]
    assert [r[0] for r in spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double").select(writers.number_text(F.col("v"))).collect()] == ["1.5000", "N/A", "N/A"]


BOX = "id long, xmin double, ymin double, xmax double, ymax double"


def test_evaluation_cases(spark):
    gt = spark.createDataFrame([(0, 1.0, 1.0, 3.0, 3.0)], BOX)
    pred = spark.createDataFrame([(0, 2.0, 1.0, 4.0, 3.0), (1, 100.0, 100.0, 110.0, 110.0), (2, None, None, None, None)], BOX)
    pairs = evaluation.overlaps(gt, pred, 4.0).collect()
    assert [(r.gt_idx, r.pred_idx, round(r.iou, 9)) for r in pairs] == [(0, 0, round(1 / 3, 9))]
    assert evaluation.match_objects(evaluation.overlaps(gt, pred, 4.0), 0.5).count() == 0
    m = spark.range(1).select(*(c.alias(n) for n, c in evaluation.area_metrics(F.lit(2.0), F.lit(2.0), F.lit(2.0), F.lit(100.0)).items())).first()
    assert m.accuracy == pytest.approx(0.96) and m.miou == pytest.approx((1 / 3 + 94 / 98) / 2)
    assert evaluation.average_precision(evaluation.match_objects(evaluation.overlaps(gt, pred, 4.0), 0.3), 1, [0.3]).first().ap == pytest.approx(1.0)
    assert spatial.without_collisions(pred, gt, "id", 4.0).select("id").collect()[0].id == 1


def test_claimed_predictions_have_no_second_choice(spark):
    pairs = spark.createDataFrame([(1, 7, 0.6), (2, 7, 0.9), (2, 8, 0.8), (3, 9, 0.5), (3, 6, 0.5)], "gt_idx long, pred_idx long, iou double")
    assert sorted((r.gt_idx, r.pred_idx) for r in evaluation.match_objects(pairs, 0.5).collect()) == [(1, 7), (3, 6)]


def test_segments_cut_by_tiles(spark):
    s = spark.createDataFrame([(1, 1.0, 1.0, 25.0, 1.0), (2, 5.0, 5.0, 5.0, 15.0), (3, 0.0, 0.0, 0.0, 0.0)], "id int, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.id, r.tile_x, r.tile_y, round(r.ax, 6), round(r.bx, 6), round(r.ay, 6), round(r["by"], 6)) for r in spatial.clip_segments(s, 10.0).collect())
    assert got == [(1, 0, 0, 1, 10, 1, 1), (1, 1, 0, 10, 20, 1, 1), (1, 2, 0, 20, 25, 1, 1), (2, 0, 0, 5, 5, 5, 10), (2, 0, 1, 5, 5, 10, 15)]


def test_functions(spark):
    row = spark.range(1).select(geodesy.tile_name(F.lit(-0.5), F.lit(36.2)).alias("t"), geodesy.hemisphere_name(F.lit(37.9), F.lit(-3.0)).alias("h"), geodesy.quadkey(F.lit(3), F.lit(5), F.lit(3)).alias("q"), features.bytes_text(F.lit(1536)).alias("b"), *(c.alias(n) for n, c in zip(("e", "n"), geodesy.to_utm(F.lit(37.0), F.lit(39.0), 37), strict=True))).first()
    assert (row.t, row.h, row.q, row.b) == ("-01+036", "N37W003", "213", "1.5 KB")
    assert row.e == pytest.approx(500000.0) and row.n == pytest.approx(4094872.37, abs=0.01)
    assert tiles.flat_columns(12) == 4 and tiles.flat_columns(7) == 7 and tiles.flat_columns(0) == 0


def test_stream_equals_batch(spark, tmp_path, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    e.write.parquet(str(tmp_path / "in"))
    stream = stream_frames.windowed_rates(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")), "ts", "value", "6 hours", "1 day")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("rates").start()
    q.processAllAvailable()
    q.stop()
    rows = lambda df: sorted((r.start, r.samples, round(r.average_fps, 6)) for r in df.collect())
    assert rows(spark.table("rates")) == rows(stream_frames.windowed_rates(e, "ts", "value", "6 hours"))
