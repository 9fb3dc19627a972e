"""Registered queries of the geospatial operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import colours, features, geodesy
from ..operators import evaluation, frames, raster, scenery, shapes, spatial, tile_kernels, tiles
from ..sources import writers
from ..streaming import frames as stream_frames
from . import adapters
from .adapters import table, with_tables
from .registry import oracle_sql, queries  # noqa: F401  the registered ones, for the driver's entry
from .registry import register as _query
from .registry import rounded as _r

KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_K = ", ".join(KEY)
_R = 6378137.0

# --- geodesy and names ------------------------------------------------------------------------------------------------


@_query(with_tables(f"""
    select {_K}, round(0.5 * pi() * {_R} / 180 * cos(radians(lat)), 4) + 0.0 as east, round(0.25 * pi() * {_R} / 180, 4) + 0.0 as north, round(0.5 *
    111320.0 * cos(radians(lat)), 4) + 0.0 as road_east, (round(0.25 * 110540.0, 4) + 0.0)::double as road_north
    from places
    """, "places"))
def f1_f2_metres(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d)
    e, n = geodesy.degrees_to_metres(F.col("lat"), F.lit(0.5), F.lit(0.25))
    re, rn = geodesy.road_metres(F.col("lat"), F.lit(0.5), F.lit(0.25))
    return p.select(*KEY, _r(e, 4).alias("east"), _r(n, 4).alias("north"), _r(re, 4).alias("road_east"), _r(rn, 4).alias("road_north"))


@_query(with_tables(f"""
    select {_K}, round(2 * {_R} * atan2(sqrt(a), sqrt(greatest(1 - a, 0.0))), 3) + 0.0 as metres
    from (select *, pow(sin(radians(41.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(41.0)) * pow(sin(radians(29.0 - lon) / 2), 2) as a
    from places)
    """, "places"))
def f3_haversine(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d)
    return p.select(*KEY, _r(geodesy.haversine(F.col("lat"), F.col("lon"), F.lit(41.0), F.lit(29.0)), 3).alias("metres"))


@_query(with_tables(f"select {_K}, round(2 * pi() * {_R} * cos(radians(lat)) / pow(2, 8 + 10 + l_linenumber), 6) + 0.0 as metres from places", "places"))
def f4_pixel_size(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d)
    return p.select(*KEY, _r(geodesy.mercator_pixel_size(F.col("lat"), F.col("l_linenumber") + 10)).alias("metres"))


@_query(with_tables(f"""
    select {_K}, l_partkey % 4096 as x, l_suppkey % 4096 as y, round(degrees(2 * atan(exp(pi() * (1 - 2 * (l_suppkey % 4096) / 4096.0))) - pi() / 2), 7) +
    0.0 as lat, round((l_partkey % 4096) / 4096.0 * 360 - 180, 7) + 0.0 as lon
    from places
    """, "places"))
def f5_tile_to_lat_lon(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d).withColumns({"x": F.call_function("mod", F.col("l_partkey"), F.lit(4096)), "y": F.call_function("mod", F.col("l_suppkey"), F.lit(4096))})
    lat, lon = geodesy.tile_to_lat_lon(F.col("x"), F.col("y"), F.lit(12))
    return p.select(*KEY, "x", "y", _r(lat, 7).alias("lat"), _r(lon, 7).alias("lon"))


_UY = "(1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2"


@_query(with_tables(f"""
    select {_K}, px as pixel_x, py as pixel_y, px // 256 as tile_x, py // 256 as tile_y, trunc((lon + 180) / 360 * pow(2, 10))::bigint * 16 as ortho_x,
    trunc(uy * pow(2, 10))::bigint * 16 as ortho_y from (select *, round_even((lon + 180) / 360 * pow(2, 22), 0)::bigint as px, round_even(uy * pow(2,
    22), 0)::bigint as py from (select *, {_UY} as uy from places))
    """, "places"))
def f6_lat_lon_to_tile(spark: SparkSession, d: str) -> DataFrame:
    p, z = adapters.places(spark, d), F.lit(14)
    px, py = geodesy.lat_lon_to_pixel(F.col("lat"), F.col("lon"), z)
    tx, ty = geodesy.lat_lon_to_tile(F.col("lat"), F.col("lon"), z)
    ox, oy = geodesy.lat_lon_to_orthogrid(F.col("lat"), F.col("lon"), z)
    return p.select(*KEY, px.alias("pixel_x"), py.alias("pixel_y"), tx.alias("tile_x"), ty.alias("tile_y"), ox.alias("ortho_x"), oy.alias("ortho_y"))


@_query("select p_partkey, " + " || ".join(f"((p_partkey // {1 << k}) % 2 + 2 * ((p_partkey * 7 % 1024 // {1 << k}) % 2))::int::varchar" for k in range(9, -1, -1)) + " as quadkey from part")
def f7_quadkey(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", geodesy.quadkey(F.col("p_partkey"), F.call_function("mod", F.col("p_partkey") * 7, F.lit(1024)), F.lit(10)).alias("quadkey"))


@_query(with_tables(f"""
    select {_K}, round(least(1.0, greatest(0.0, ((lon + 180) / 360 * 16384 - 8192) / 16)), 6) + 0.0 as s, round(least(1.0, greatest(0.0, 1 - ({_UY} *
    16384 - 8192) / 16)), 6) + 0.0 as t from places
    """, "places"))
def f8_texture_coordinate(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d)
    s, t = geodesy.texture_coordinate(F.col("lat"), F.col("lon"), F.lit(8192), F.lit(8192), F.lit(14))
    return p.select(*KEY, _r(s).alias("s"), _r(t).alias("t"))


@_query("""
    select p_partkey, round_even(41.5::double - 0.0005::double * p_size, 8) + 0.0 as lat, round_even(29.25::double + 0.0005::double * (p_partkey % 1000),
    8) + 0.0 as lon from part
    """)
def f9_affine(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    lat, lon = geodesy.affine_to_world(F.call_function("mod", F.col("p_partkey"), F.lit(1000)), F.col("p_size"), F.lit(0.0005), F.lit(0.0), F.lit(29.25), F.lit(0.0), F.lit(-0.0005), F.lit(41.5))
    return p.select("p_partkey", (lat + 0.0).alias("lat"), (lon + 0.0).alias("lon"))


@_query(with_tables(f"""
    select {_K}, round(radians(lon) * {_R}, 3) + 0.0 as x, round(ln(tan(radians(lat)) + 1 / cos(radians(lat))) * {_R}, 3) + 0.0 as y, round(lat, 6) + 0.0
    as lat, round(lon, 6) + 0.0 as lon from places
    """, "places"))
def f10_mercator(spark: SparkSession, d: str) -> DataFrame:
    p = adapters.places(spark, d)
    x, y = geodesy.to_mercator(F.col("lat"), F.col("lon"))
    lat, lon = geodesy.from_mercator(x, y)
    return p.select(*KEY, _r(x, 3).alias("x"), _r(y, 3).alias("y"), _r(lat).alias("lat"), _r(lon).alias("lon"))


_A1, _A2, _A3 = "(n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16)", "(13 * n * n / 48 - 3 * n * n * n / 5)", "(61 * n * n * n / 240)"
_UTM = f"""
    select {_K}, lat, lon,
        round(500000 + k * (eta + {_A1} * cos(2 * xi) * sinh(2 * eta) + {_A2} * cos(4 * xi) * sinh(4 * eta) + {_A3} * cos(6 * xi) * sinh(6 * eta)), 2) + 0.0 as east,
        round(k * (xi + {_A1} * sin(2 * xi) * cosh(2 * eta) + {_A2} * sin(4 * xi) * cosh(4 * eta) + {_A3} * sin(6 * xi) * cosh(6 * eta)), 2) + 0.0 as north
    from (
        select *, atan2(t, cos(away)) as xi, atanh(sin(away) / sqrt(1 + t * t)) as eta
        from (
            select *, sinh(atanh(sin(radians(lat))) - e * atanh(e * sin(radians(lat)))) as t, radians(lon - 39) as away
            from (
                select {_K}, lat, 36 + l_linenumber / 8.0 as lon, 2 * sqrt(n) / (1 + n) as e, n,
                    0.9996 * {_R} / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) as k
                from places, (select 1 / (2 * 298.257223563 - 1) as n)
            )
        )
    )
"""


@_query(with_tables(_UTM, "places"))
def f10_utm(spark: SparkSession, d: str) -> DataFrame:
    """Every place's latitude in zone 37."""
    p = adapters.places(spark, d).withColumn("lon", 36 + F.col("l_linenumber") / 8.0)
    e, n = geodesy.to_utm(F.col("lat"), F.col("lon"), 37)
    return p.select(*KEY, "lat", "lon", _r(e, 2).alias("east"), _r(n, 2).alias("north"))



_SIGNED = lambda v, n: f"(case when {v} < 0 then '-' else '+' end || lpad(abs({v})::int::varchar, {n}, '0'))"


@_query(with_tables(f"""
    select {_K}, {_SIGNED('floor(lat)', 2)} || {_SIGNED('floor(lon)', 3)} as tile, {_SIGNED('floor(lat / 10) * 10', 2)} ||
    {_SIGNED('floor(lon / 10) * 10', 3)} as folder, (case when floor(lat) < 0 then 'S' else 'N' end) || lpad(abs(floor(lat))::int::varchar, 2, '0') ||
    (case when floor(lon) < 0 then 'W' else 'E' end) || lpad(abs(floor(lon))::int::varchar, 3, '0') as hemisphere, {_SIGNED('floor(lat / 10) * 10', 2)} ||
    {_SIGNED('floor(lon / 10) * 10', 3)} || '/' || {_SIGNED('floor(lat)', 2)} || {_SIGNED('floor(lon)', 3)} || '.dsf' as path
    from places
    """, "places"))
def f11_f12_names(spark: SparkSession, d: str) -> DataFrame:
    p, lat, lon = adapters.places(spark, d), F.col("lat"), F.col("lon")
    return p.select(*KEY, geodesy.tile_name(lat, lon).alias("tile"), geodesy.folder_name(lat, lon).alias("folder"), geodesy.hemisphere_name(lat, lon).alias("hemisphere"), geodesy.tile_path(lat, lon).alias("path"))


@_query("""
    select p_partkey, least(12.0, greatest(1.0, round_even(p_size / 1.5 / 10, 0))) * 3.5 as height, case when p_retailprice < 100 then 'small' when
    p_retailprice < 800 then 'medium' else 'large' end as bucket from part
    """)
def f14_p3_buildings(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", geodesy.building_height(F.col("p_size") / 1.5, F.lit(None).cast("double")).alias("height"), features.size_bucket(F.col("p_retailprice")).alias("bucket"))


_KINDS = [*(k for k, _ in features.ROAD_SUBTYPES), "alley"]
_NAMES = str(_KINDS)


def _roads(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array(*map(F.lit, _KINDS))
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", F.element_at(kinds, (F.call_function("mod", k, F.lit(15)) + 1).cast("int")).alias("highway"), F.when(F.call_function("mod", k, F.lit(5)) == 0, F.concat(F.col("p_size").cast("string"), F.lit(",5 m"))).alias("width"), F.when(F.call_function("mod", k, F.lit(3)) == 0, F.concat(F.call_function("mod", k, F.lit(4)).cast("string"), F.lit(";2"))).alias("lanes"))


_ROADS = f"select p_partkey, {_NAMES}[p_partkey % 15 + 1] as highway, case when p_partkey % 5 = 0 then p_size::varchar || ',5 m' end as width, case when p_partkey % 3 = 0 then (p_partkey % 4)::varchar || ';2' end as lanes from part"


@_query("select p_partkey, (case " + " ".join(f"when contains(highway, '{k}') then {v}" for k, v in features.ROAD_SUBTYPES) + " else -1 end)::bigint as subtype, case when " + " or ".join(f"contains(highway, '{k}')" for k in features.PAVED) + " then 'asphalt' else 'dirt' end as surface, coalesce(try_cast(trim(replace(replace(width, 'm', ''), ',', '.')) as double), greatest(try_cast(split_part(lanes, ';', 1) as int) * 3.5, case when lanes is not null then 4.0 end)::double, case " + " ".join(f"when highway = '{k}' then {v}" for k, v in features.ROAD_WIDTHS) + f" end::double, 6.0) as metres from ({_ROADS})")
def p4_p5_roads(spark: SparkSession, d: str) -> DataFrame:
    return _roads(spark, d).select("p_partkey", features.first_match(F.col("highway"), (*features.ROAD_SUBTYPES, ("", -1))).cast("long").alias("subtype"), features.road_surface(F.col("highway")).alias("surface"), features.road_width(F.col("width"), F.col("lanes"), F.col("highway")).alias("metres"))


@_query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(least(1.0, greatest(0.0, (l_quantity - 5) / 40.0)), 6) + 0.0 as u from lineitem")
def f16_unit_position(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*KEY, (geodesy.unit_position(F.col("l_quantity"), F.lit(5.0), F.lit(45.0)) + 0.0).alias("u"))


# --- evaluation -------------------------------------------------------------------------------------------------------

_PAIRS = "pairs as (select t.id as gt_idx, f.id as pred_idx, i / (ta + fa - i) as iou, ta as gt_area, fa as pred_area from (select t.id, f.id as fid, (least(t.xmax, f.xmax) - greatest(t.xmin, f.xmin)) * (least(t.ymax, f.ymax) - greatest(t.ymin, f.ymin)) as i, (t.xmax - t.xmin) * (t.ymax - t.ymin) as ta, (f.xmax - f.xmin) * (f.ymax - f.ymin) as fa from truth t join found f on t.xmin < f.xmax and f.xmin < t.xmax and t.ymin < f.ymax and f.ymin < t.ymax) t join (select id from found) f on f.id = t.fid)"
_MATCHES = _PAIRS + ", best as (select * from pairs qualify row_number() over (partition by gt_idx order by iou desc, pred_idx) = 1), matches as (select * from best where iou >= 0.3 qualify row_number() over (partition by pred_idx order by gt_idx) = 1)"


def _over_boxes(query: str) -> str:
    return with_tables("", "truth", "found").rstrip() + ", " + _MATCHES + " " + query


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.overlaps(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), 16.0)


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.match_objects(_pairs(spark, d), 0.3)


@_query(_over_boxes("select gt_idx, pred_idx, round(iou, 9) as iou, gt_area, pred_area from matches"))
def j1_w1_matches(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("gt_idx", "pred_idx", F.round("iou", 9).alias("iou"), "gt_area", "pred_area")


@_query(_over_boxes("""
    select g as n_gt, p as n_pred, m as tp, p - m as fp, g - m as fn, round(m / g, 9) as completeness, round(m / p, 9) as correctness, round(m / (g + p -
    m), 9) as quality from (select (select count(*) from truth) as g, (select count(*)
    from found) as p, (select count(*) from matches) as m)
    """))
def a3_object_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = evaluation.object_metrics(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), _matches(spark, d))
    return m.select("n_gt", "n_pred", "tp", "fp", "fn", *(F.round(c, 9).alias(c) for c in ("completeness", "correctness", "quality")))


@_query(_over_boxes("""
    select round(th, 2) as threshold, round(sum(best) / 101, 6) as ap
    from (select th, s, coalesce((select max(pr) from (select tp / g as rc, tp / (n + 1e-9) as pr
    from (select sum((m.iou >= th)::int) over (order by iou desc, gt_idx) as tp, row_number() over (order by iou desc, gt_idx) as n, (select count(*)
    from truth)::double as g from matches m)) where rc * 100 + 1e-9 >= s), 0) as best
    from (select unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8])::double as th), (select unnest(range(101)) as s))
    group by th
    """))
def a4_w2_w3_average_precision(spark: SparkSession, d: str) -> DataFrame:
    n = adapters.truth_boxes(spark, d).count()
    ap = evaluation.average_precision(_matches(spark, d), n, [0.3, 0.4, 0.5, 0.6, 0.7, 0.8])
    return ap.select(F.round("threshold", 2).alias("threshold"), _r(F.col("ap")).alias("ap"))


@_query(_over_boxes("""
    select round(avg(iou), 6) as mean, round(quantile_cont(iou, 0.5), 6) as median, round(stddev_pop(iou), 6) as std, round(quantile_cont(iou, 0.75) -
    quantile_cont(iou, 0.25), 6) as iqr, round(stddev_pop(iou) / avg(iou), 6) as cv, round(min(iou), 6) as min, round(max(iou), 6) as max, round(min(iou),
    6) as worst from matches
    """))
def a5_stats_summary(spark: SparkSession, d: str) -> DataFrame:
    s = evaluation.stats_summary(_matches(spark, d), "iou")
    return s.select(*(_r(F.col(c)).alias(c) for c in s.columns))


@_query(_over_boxes("""
    select round(avg(e), 6) as mean_abs, round(quantile_cont(e, 0.5), 6) as median_abs, round(avg(e / (gt_area + 1e-9)), 6) as mean_rel,
    round(stddev_pop(s), 6) as std from (select abs(pred_area - gt_area) as e, pred_area - gt_area as s, gt_area
    from matches)
    """))
def a6_area_errors(spark: SparkSession, d: str) -> DataFrame:
    s = evaluation.area_errors(_matches(spark, d))
    return s.select(*(_r(F.col(c)).alias(c) for c in s.columns))


_CELLS = """
    wide as (select id, xmin, ymin, xmax + 9 as xmax, ymax from truth),
    t as (select distinct x, y from wide, lateral (select unnest(range(xmin::bigint, xmax::bigint)) as x), lateral (select unnest(range(ymin::bigint, ymax::bigint)) as y)),
    p as (select distinct x, y from roads, lateral (select unnest(range(xmin::bigint, xmax::bigint)) as x), lateral (select unnest(range(ymin::bigint, ymax::bigint)) as y))
"""


@_query(
    with_tables("", "truth", "roads").rstrip() + "," + _CELLS + """
    , c as (select (select count(*) from t join p using (x, y))::double as tp, (select count(*) from p)::double as p, (select count(*) from t)::double as g),
    b as (select tp, p - tp as fp, g - tp as fn, 1e9 - p - g + tp as tn from c)
    select tp, fp, fn, tn, round(tp / (tp + fp), 6) as "precision", round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1, round(tp / (tp + fp + fn), 6) as iou,
        round((tp + tn) / 1e9, 6) as accuracy, round((tp / (tp + fp + fn) + tn / (tn + fn + fp)) / 2, 6) as miou
    from b
    """
)
def a1_a7_area_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Areas of the unions of boxes that overlap among themselves, against each other."""
    wide = adapters.truth_boxes(spark, d).withColumn("xmax", F.col("xmax") + 9)
    truth, found = (x.select(shapes.box_shape(*(F.col(c) for c in spatial.BOX)).alias("shape")) for x in (wide, adapters.road_boxes(spark, d)))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    metrics = evaluation.area_metrics(tp, fp, fn, F.lit(1e9))
    a = shapes.area_confusion(truth, found, 96.0)
    return a.select(*(_r(c, 4).alias(n) for n, c in (("tp", tp), ("fp", fp), ("fn", fn), ("tn", metrics.pop("tn")))), *(_r(c).alias(n) for n, c in metrics.items()))



@_query(with_tables("", "truth", "found").rstrip() + ", " + _MATCHES + " select 'fp' as kind, id from found where id not in (select pred_idx from matches) union all select 'fn', id from truth where id not in (select gt_idx from matches)")
def x2_false_objects(spark: SparkSession, d: str) -> DataFrame:
    m = _matches(spark, d)
    return evaluation.false_objects(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), m)


@_query(with_tables("""
    select id, xmin, ymin, xmax, ymax from truth t where not exists (select 1
    from roads r where least(t.xmax, r.xmax) > greatest(t.xmin, r.xmin) and least(t.ymax, r.ymax) > greatest(t.ymin, r.ymin))
    """, "truth", "roads"))
def j2_without_collisions(spark: SparkSession, d: str) -> DataFrame:
    return spatial.without_collisions(adapters.truth_boxes(spark, d), adapters.road_boxes(spark, d), "id", 16.0)


@_query(with_tables("""
    select id, greatest(xmin, 30.0) as xmin, greatest(ymin, 20.0) as ymin, least(xmax, 300.0) as xmax, least(ymax, 200.0) as ymax
    from truth where least(xmax, 300.0) > greatest(xmin, 30.0) and least(ymax, 200.0) > greatest(ymin, 20.0)
    """, "truth"))
def x4_p13_clip(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    cut = b.select("id", F.greatest("xmin", F.lit(30.0)).alias("xmin"), F.greatest("ymin", F.lit(20.0)).alias("ymin"), F.least("xmax", F.lit(300.0)).alias("xmax"), F.least("ymax", F.lit(200.0)).alias("ymax"))
    return cut.where("xmax > xmin and ymax > ymin")


@_query(with_tables("select id, (xmax - xmin) * 0.3 * ((ymax - ymin) * 0.3) as area from truth where (xmax - xmin) * 0.3 * ((ymax - ymin) * 0.3) >= 2.0", "truth"))
def p2_area_filter(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    return b.select("id", features.footprint(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), 0.3).alias("area")).where("area >= 2.0")


@_query(with_tables("select id from truth where floor(xmin / 100) = floor(xmax / 100) and floor(ymin / 100) = floor(ymax / 100)", "truth"))
def p12_inside_tile(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    corners = F.array(F.struct(F.col("xmin").alias("x"), F.col("ymin").alias("y")), F.struct(F.col("xmax").alias("x"), F.col("ymax").alias("y")))
    return b.where(features.in_one_tile(corners, 100.0)).select("id")


# --- frames -----------------------------------------------------------------------------------------------------------


@_query(with_tables("""
    select event_type, count(*) as sample_count, round(avg(fps), 6) as average_fps, list_sort(list(fps))[greatest(0, least(count(*) - 1, floor(count(*) *
    0.01::double)))::int + 1] as one_percent_low_fps, min(fps) as min_fps, max(fps) as max_fps
    from frames where fps > 0 group by 1
    """, "frames"))
def a13_p14_fps_summary(spark: SparkSession, d: str) -> DataFrame:
    s = frames.fps_summary(adapters.frames(spark, d), "fps", ("event_type",))
    return s.withColumn("average_fps", _r(F.col("average_fps")))


@_query(with_tables("""
    select event_type, count(*) as frames, round(count(*) / sum(dt), 6) as average_fps, round(1 / avg(case when k <= ceil(n * 0.01) then dt end), 6) as
    one_percent_low_fps, round(1 / max(dt), 6) as min_fps, round(1 / min(dt), 6) as max_fps
    from (select event_type, dt, row_number() over (partition by event_type order by dt desc, ts, event_id) as k, count(*) over (partition by event_type)
    as n from frames where dt > 0) group by 1
    """, "frames"))
def a14_o2_recorder(spark: SparkSession, d: str) -> DataFrame:
    s = frames.recorder_summary(adapters.frames(spark, d), "dt", ("event_type",))
    return s.select("event_type", "frames", *(_r(F.col(c)).alias(c) for c in ("average_fps", "one_percent_low_fps", "min_fps", "max_fps")))


@_query(with_tables("""
    select event_type, count(*) as frames, round(sum(fps), 4) as total
    from (select *, sum(dt) over (partition by event_type order by ts, event_id rows unbounded preceding) as elapsed
    from frames) where elapsed >= 3 and elapsed < 13 group by 1
    """, "frames"))
def t2_t3_after_warm_up(spark: SparkSession, d: str) -> DataFrame:
    kept = frames.after_warm_up(adapters.frames(spark, d), "dt", ("ts", "event_id"), 3.0, 10.0, ("event_type",))
    return kept.groupBy("event_type").agg(F.count("*").alias("frames"), _r(F.sum("fps"), 4).alias("total"))


# --- tiles ------------------------------------------------------------------------------------------------------------


def _named(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(F.call_function("mod", k, F.lit(4)) == 0, F.concat(F.lit("tile_r"), F.col("p_size").cast("string"), F.lit("_c"), F.call_function("mod", k, F.lit(50)).cast("string"), F.lit(".png")))
    name = name.when(F.call_function("mod", k, F.lit(4)) == 1, F.concat(F.lit("tile_"), F.col("p_size").cast("string"), F.lit("_"), F.call_function("mod", k, F.lit(50)).cast("string"), F.lit(".png")))
    name = name.when(F.call_function("mod", k, F.lit(4)) == 2, F.concat(F.lit("tile_x"), (F.col("p_size") * 512).cast("string"), F.lit("_y"), (F.call_function("mod", k, F.lit(50)) * 512).cast("string"), F.lit(".png")))
    return table(spark, d, "part").select("p_partkey", name.otherwise(F.concat(F.lit("tile_"), F.lpad(k.cast("string"), 7, "0"), F.lit(".png"))).alias("name"))


_NAMED = "select p_partkey, case p_partkey % 4 when 0 then 'tile_r' || p_size || '_c' || p_partkey % 50 || '.png' when 1 then 'tile_' || p_size || '_' || p_partkey % 50 || '.png' when 2 then 'tile_x' || p_size * 512 || '_y' || (p_partkey % 50) * 512 || '.png' else 'tile_' || lpad(p_partkey::varchar, 7, '0') || '.png' end as name from part"


@_query("select p_partkey, name, coalesce(case p_partkey % 4 when 0 then nullif(regexp_extract(name, 'r(\\d+)_c(\\d+)', 1), '')::bigint when 1 then nullif(regexp_extract(name, '_(\\d+)_(\\d+)', 1), '')::bigint end, -1) as \"row\", coalesce(case p_partkey % 4 when 0 then nullif(regexp_extract(name, 'r(\\d+)_c(\\d+)', 2), '')::bigint when 1 then nullif(regexp_extract(name, '_(\\d+)_(\\d+)', 2), '')::bigint end, -1) as col, coalesce(nullif(regexp_extract(name, 'x(\\d+)_y(\\d+)', 1), '')::bigint, -1) as x, coalesce(nullif(regexp_extract(name, 'x(\\d+)_y(\\d+)', 2), '')::bigint, -1) as y, coalesce(case when p_partkey % 4 in (1, 3) then nullif(regexp_extract(name, '_(\\d+)\\.\\w+$', 1), '')::bigint end, -1) as flat from (" + _NAMED + ")")
def p8_tile_names(spark: SparkSession, d: str) -> DataFrame:
    """What each parser finds in a name, -1 where it finds nothing."""
    n = F.col("name")
    rc, xy = tiles.row_col(n), tiles.x_y(n)
    found = {"row": rc["a"], "col": rc["b"], "x": xy["a"], "y": xy["b"], "flat": tiles.flat_index(n)}
    return _named(spark, d).select("p_partkey", "name", *(F.coalesce(c, F.lit(-1).cast("long")).alias(k) for k, c in found.items()))


_GRID = "select p_partkey, p_size as r, p_partkey % 50 as c from part"


@_query(f"""
    select p_partkey, r, c from ({_GRID}), (select min(p_size) as r0, max(p_size) as r1, min(p_partkey % 50) as c0, max(p_partkey % 50) as c1
    from part) where c < c0 + (c1 - c0 + 1) / 2 and r >= r0 + (r1 - r0 + 1) / 2
    """)
def p9_south_west(spark: SparkSession, d: str) -> DataFrame:
    grid = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("r"), F.call_function("mod", F.col("p_partkey"), F.lit(50)).alias("c"))
    return tiles.south_west(grid, "r", "c")


@_query("""
    select g.tile_x, g.tile_y, coalesce(n, 0) as buildings, coalesce(q, 0.0) as pixels
    from (select distinct p_size::bigint as tile_x, p_partkey % 10 as tile_y
    from part) g left join (select l_partkey % 60 as tile_x, l_suppkey % 12 as tile_y, count(*) as n, sum(l_quantity) as q
    from lineitem where l_returnflag = 'R' group by 1, 2) e using (tile_x, tile_y)
    """)
def j4_f65_complete(spark: SparkSession, d: str) -> DataFrame:
    grid = table(spark, d, "part").select(F.col("p_size").cast("long").alias("tile_x"), F.call_function("mod", F.col("p_partkey"), F.lit(10)).alias("tile_y"))
    li = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    entries = li.groupBy(F.call_function("mod", F.col("l_partkey"), F.lit(60)).alias("tile_x"), F.call_function("mod", F.col("l_suppkey"), F.lit(12)).alias("tile_y")).agg(F.count("*").alias("buildings"), F.sum("l_quantity").alias("pixels"))
    return tiles.complete(grid, entries, ["tile_x", "tile_y"], {"buildings": 0, "pixels": 0.0})


@_query("select p_partkey, dense_rank() over (order by p_partkey % 50 * 512) - 1 as tile_x, dense_rank() over (order by p_size * 512) - 1 as tile_y from part")
def j18_grid_indices(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 512).alias("raw_row"), (F.call_function("mod", F.col("p_partkey"), F.lit(50)) * 512).alias("raw_col"))
    return tiles.grid_indices(raw, "raw_row", "raw_col").select("p_partkey", F.col("tile_x").cast("long").alias("tile_x"), F.col("tile_y").cast("long").alias("tile_y"))


@_query("""
    select b::int as bin, count(x) as n from (select unnest(range(6)) as b)
    left join (select case when v < 0 then null when v < .5 then 0 when v < .6 then 1 when v < .7 then 2 when v < .8 then 3 when v < .9 then 4 when v <
    1.01 then 5 end as x from (select l_quantity / 50.0 as v from lineitem)) on x = b
    group by 1
    """)
def a12_histogram(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select((F.col("l_quantity") / 50.0).alias("confidence"))
    return tiles.histogram(li, "confidence", [0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.01])


@_query(with_tables("select floor(lat)::bigint as lat, floor(lon)::bigint as lon, count(*) as n from places group by 1, 2", "places"))
def a15_degree_groups(spark: SparkSession, d: str) -> DataFrame:
    return tiles.groups_of_features(adapters.places(spark, d), "lat", "lon")


@_query("""
    select p_size as tile, p_brand as facade, dense_rank() over (partition by p_size order by p_brand) - 1 as idx
    from (select distinct p_size, p_brand from part)
    """)
def a16_facade_index(spark: SparkSession, d: str) -> DataFrame:
    return tiles.facade_indices(table(spark, d, "part"), "p_size", "p_brand")


@_query(with_tables("""
    select round((min(lat) + max(lat)) / 2, 6) as lat, round((min(lon) + max(lon)) / 2, 6) as lon, round(min(lat) - 0.001, 6) as south, round(max(lat) +
    0.001, 6) as north, round(min(lon) - 0.001, 6) as west, round(max(lon) + 0.001, 6) as east
    from places
    """, "places"))
def a8_a17_exclusion(spark: SparkSession, d: str) -> DataFrame:
    out = tiles.exclusion(adapters.places(spark, d), "lat", "lon")
    return out.select(*(_r(F.col(c)).alias(c) for c in out.columns))


@_query("""
    select p_partkey, case when p_size * 100 <= 512 then [0::bigint] else list_sort(list_distinct(list_transform(range(ceil((p_size * 100 - 512) /
    487.0)::bigint + 1), lambda k: least(k * 487, p_size * 100 - 512)))) end as starts
    from part
    """)
def f58_inference_starts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", tiles.inference_starts((F.col("p_size") * 100).cast("long"), 512, 25).alias("starts"))


@_query("""
    select c_custkey, lon, lat from (select c_custkey, c_custkey % 300 - 150 + 0.3 as l, c_custkey % 100 - 50 + 0.6 as b
    from customer), lateral (select unnest(range(floor(l)::bigint, ceil(l + 2.5)::bigint)) as lon), lateral (select unnest(range(floor(b)::bigint, ceil(b
    + 1.5)::bigint)) as lat)
    """)
def f63_degree_tiles(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    left, bottom = F.call_function("mod", k, F.lit(300)) - 150 + 0.3, F.call_function("mod", k, F.lit(100)) - 50 + 0.6
    boxes = table(spark, d, "customer").select("c_custkey", left.alias("left"), bottom.alias("bottom"), (left + 2.5).alias("right"), (bottom + 1.5).alias("top"))
    return tiles.degree_tiles(boxes).select("c_custkey", "lon", "lat")


@_query(
    """
    with recursive vs as (select distinct p_retailprice as v from part),
    heads as (
        select min(v) as h, 0 as grp from vs
        union all
        select (select min(v) from vs where v - heads.h > 2.5), grp + 1 from heads where exists (select 1 from vs where v - heads.h > 2.5)
    )
    select v, (select max(grp) from heads where h <= v)::bigint as grp from vs
    """
)
def w4_dedupe_coordinates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_retailprice").alias("v"))
    return tiles.dedupe_coordinates(p, "v", 2.5).select("v", F.col("group").alias("grp"))



@_query("""
    select b.building, count(*) as pixels, count(k.x) as blocked, case when count(k.x) = count(*) then 'removed' when count(k.x) > 0 then 'mask_only' else
    'kept' end as fate from (select l_orderkey % 500 as building, l_partkey as x, l_suppkey as y
    from lineitem) b left join (select distinct l_partkey as x, l_suppkey as y
    from lineitem where l_returnflag = 'R') k using (x, y) group by 1
    """)
def a22_a23_clean_buildings(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    px = li.select(F.call_function("mod", F.col("l_orderkey"), F.lit(500)).alias("building"), F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"))
    return tiles.clean_buildings(px, li.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y")))


@_query(with_tables("select vec_id, greatest(1, floor(count(*) * 0.3))::bigint as n, count(*) as candidates from pixels where v >= 0.05 group by 1", "rasters", "pixels"))
def o4_density_sample(spark: SparkSession, d: str) -> DataFrame:
    """How many of each tile's pixels are drawn, and of how many; only such pixels are, each once."""
    px = raster.pixels(adapters.rasters(spark, d), "px", 8).where("v >= 0.05").select("vec_id", "row", "col")
    drawn = tiles.density_sample(px, ["vec_id"], ["row", "col"], 0.3, 42).join(px, ["vec_id", "row", "col"], "left_semi").distinct()
    return drawn.groupBy("vec_id").agg(F.count("*").alias("n")).join(px.groupBy("vec_id").agg(F.count("*").alias("candidates")), "vec_id")



@_query(with_tables("select vec_id, \"row\", col from pixels where v >= 0.05 and \"row\" % 2 = 0 and col % 2 = 0", "rasters", "pixels"))
def o5_grid_sample(spark: SparkSession, d: str) -> DataFrame:
    px = raster.pixels(adapters.rasters(spark, d), "px", 8)
    return tiles.grid_sample(px, "v", 2, 0.05).select("vec_id", "row", "col")


# --- rasters ----------------------------------------------------------------------------------------------------------


@_query(with_tables("select vec_id, round(list_min(px), 6) as min, round(list_max(px), 6) as max, round(list_sum(px) / 64, 6) as mean from rasters", "rasters"))
def a10_tile_stats(spark: SparkSession, d: str) -> DataFrame:
    s = raster.tile_stats(adapters.rasters(spark, d), "px", ["vec_id"])
    return s.select("vec_id", *(_r(F.col(c)).alias(c) for c in ("min", "max", "mean")))


@_query(with_tables("select round(min(v), 6) as min, round(max(v), 6) as max, round(max(v) - min(v), 6) as range from pixels", "rasters", "pixels"))
def a9_global_stats(spark: SparkSession, d: str) -> DataFrame:
    s = raster.global_stats(adapters.rasters(spark, d), "px", -32768.0)
    return s.select(*(_r(F.col(c)).alias(c) for c in s.columns))


@_query(with_tables("""
    select vec_id, list_transform(px, lambda x: (x >= 0.05)::int) as mask, list_transform(px, lambda x: (x > -0.02)::int) as low,
    list_sum(list_transform(px, lambda x: (x >= 0.05)::int))::bigint as n, 100.0 * list_sum(list_transform(px, lambda x: (x >= 0.05)::int)) / 64 as share
    from rasters
    """, "rasters"))
def p10_a11_masks(spark: SparkSession, d: str) -> DataFrame:
    t = adapters.rasters(spark, d)
    mask = raster.threshold_mask(F.col("px"), 0.05)
    n, share = raster.mask_share(mask)
    return t.select("vec_id", mask.alias("mask"), raster.threshold_mask(F.col("px"), -0.02, low_is_set=True, invert=True).alias("low"), n.cast("long").alias("n"), share.cast("double").alias("share"))


@_query(with_tables("""
    select vec_id, list_transform(px, lambda x: (x >= 0.05 and not x >= 0.1)::int) as trees, list_transform(px, lambda x: (x >= 0.1 or x <= -0.1)::int) as
    blocked from rasters
    """, "rasters"))
def x3_mask_algebra(spark: SparkSession, d: str) -> DataFrame:
    px = F.col("px")
    tree, road, low = raster.threshold_mask(px, 0.05), raster.threshold_mask(px, 0.1), raster.threshold_mask(px, -0.1, low_is_set=True)
    return adapters.rasters(spark, d).select("vec_id", raster.and_not(tree, road).alias("trees"), raster.either(road, low).alias("blocked"))


@_query(with_tables("select label, round(quantile_cont(v, 0.02), 6) as lo, round(quantile_cont(v, 0.98), 6) as hi from pixels where v <> 0 group by 1", "rasters", "pixels"))
def a18_band_stretch(spark: SparkSession, d: str) -> DataFrame:
    s = raster.band_stretch(raster.pixels(adapters.rasters(spark, d), "px", 8), "label", "v", -32768.0)
    return s.select("label", _r(F.col("lo")).alias("lo"), _r(F.col("hi")).alias("hi"))


@_query(with_tables("""
    select vec_id, list_transform(px, lambda x: trunc(least(1.0, greatest(0.0, (x + 0.25) / 0.5)) * 255)::int) as bytes, list_transform(px, lambda x:
    least(65535.0, greatest(0.0, round_even((x + 0.6) / 1.2 * 65535, 0)))::int) as heights
    from rasters
    """, "rasters"))
def f42_f45_f54_stretch(spark: SparkSession, d: str) -> DataFrame:
    px = F.col("px")
    return adapters.rasters(spark, d).select("vec_id", raster.stretch(px, F.lit(-0.25), F.lit(0.25)).alias("bytes"), raster.to_uint16(px, F.lit(-0.6), F.lit(1.2)).alias("heights"))


@_query(with_tables("""
    select vec_id, "row", col, round((select sum(q.v) from (select unnest([-1, 0, 1]) as a), (select unnest([-1, 0, 1]) as b), pixels q
    where q.vec_id = p.vec_id and q."row" = least(greatest(p."row" + a, 0), 7) and q.col = least(greatest(p.col + b, 0), 7)) / 9, 6) + 0.0 as v
    from pixels p
    """, "rasters", "pixels"))
def w6_box_blur(spark: SparkSession, d: str) -> DataFrame:
    out = raster.pixels(tile_kernels.blur(adapters.rasters(spark, d), ["vec_id"], "px", 8), "px", 8)
    return out.select("vec_id", "row", "col", _r(F.col("v")).alias("v"))


@_query(with_tables("""
    select vec_id, "row", col, round(coalesce((lead(v) over x - lag(v) over x) / 2, lead(v) over x - v, v - lag(v) over x, 0), 6) + 0.0 as dx,
    round(coalesce((lead(v) over y - lag(v) over y) / 2, lead(v) over y - v, v - lag(v) over y, 0), 6) + 0.0 as dy
    from pixels window x as (partition by vec_id, "row" order by col), y as (partition by vec_id, col order by "row")
    """, "rasters", "pixels"))
def f48_slopes(spark: SparkSession, d: str) -> DataFrame:
    out = tile_kernels.slopes(adapters.rasters(spark, d), ["vec_id"], "px", 8).withColumn("d", F.arrays_zip("dx", "dy")).select("vec_id", "d")
    long = raster.pixels(out, "d", 8)
    return long.select("vec_id", "row", "col", _r(F.col("v.dx")).alias("dx"), _r(F.col("v.dy")).alias("dy"))


@_query(
    with_tables(
        """
        select vec_id, k, round(case when fx >= fy then a + fx * (b - a) + fy * (e - b) else a + fy * (c - a) + fx * (e - c) end, 6) + 0.0 as value
        from (
            select vec_id, k, x - floor(x) as fx, y - floor(y) as fy, px[i] as a, px[i + 1] as b, px[i + 8] as c, px[i + 9] as e
            from (select *, (floor(y) * 8 + floor(x) + 1)::int as i from (select vec_id, k, 0.5 + k * 0.75 as x, 0.25 + k * 0.7 as y, px from rasters, range(8) r(k)))
        )
        """,
        "rasters",
    )
)
def f46_sample(spark: SparkSession, d: str) -> DataFrame:
    t = adapters.rasters(spark, d)
    pts = t.select("vec_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("k")).withColumns({"x": F.lit(0.5) + F.col("k") * 0.75, "y": F.lit(0.25) + F.col("k") * 0.7})
    got = raster.sample(pts, raster.pixels(t, "px", 8), ["vec_id"])
    return got.select("vec_id", "k", _r(F.col("value")).alias("value"))



# --- roads, graphs, colours -------------------------------------------------------------------------------------------


_CLIPPED = f"""
    select {_K}, tile_x, tile_y, round(x1 + t0 * dx, 6) + 0.0 as ax, round(y1 + t0 * dy, 6) + 0.0 as ay, round(x1 + t1 * dx, 6) + 0.0 as bx, round(y1 + t1 * dy, 6) + 0.0 as by
    from (
        select *, greatest(0.0, case when dx = 0 then 0 when dx > 0 then (tile_x * 10 - x1) / dx else (tile_x * 10 + 10 - x1) / dx end, case when dy = 0 then 0 when dy > 0 then (tile_y * 10 - y1) / dy else (tile_y * 10 + 10 - y1) / dy end) as t0,
            least(1.0, case when dx = 0 then 1 when dx > 0 then (tile_x * 10 + 10 - x1) / dx else (tile_x * 10 - x1) / dx end, case when dy = 0 then 1 when dy > 0 then (tile_y * 10 + 10 - y1) / dy else (tile_y * 10 - y1) / dy end) as t1
        from (select *, x2 - x1 as dx, y2 - y1 as dy from segments where x1 <> x2 or y1 <> y2),
            lateral (select unnest(range(floor(least(x1, x2) / 10)::bigint, floor(greatest(x1, x2) / 10)::bigint + 1)) as tile_x),
            lateral (select unnest(range(floor(least(y1, y2) / 10)::bigint, floor(greatest(y1, y2) / 10)::bigint + 1)) as tile_y)
    )
    where t1 > t0 and sqrt(pow((t1 - t0) * dx, 2) + pow((t1 - t0) * dy, 2)) >= 1e-9
"""


@_query(with_tables(_CLIPPED, "segments"))
def j3_clip_segments(spark: SparkSession, d: str) -> DataFrame:
    s = spatial.clip_segments(adapters.segments(spark, d).where("x1 != x2 or y1 != y2"), 10.0)
    return s.select(*KEY, "tile_x", "tile_y", *(_r(F.col(c)).alias(c) for c in ("ax", "ay", "bx", "by")))



@_query(with_tables(f"""
    select {_K}, seq, round(step, 6) as step from (select *, row_number() over w as seq, sqrt(pow(x1 - lag(x1) over w, 2) + pow(y1 - lag(y1) over w, 2))
    as step from segments window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, x2))
    where step is null or step > 0
    """, "segments"))
def w5_w7_vertex_steps(spark: SparkSession, d: str) -> DataFrame:
    """Vertices of an order's line without those that repeat the one before, with the length of the step to each."""
    points = adapters.segments(spark, d).withColumns({"x": F.col("x1"), "y": F.col("y1")})
    out = scenery.vertex_steps(points, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "x2"])
    return out.select(*KEY, "seq", F.round("step", 6).alias("step"))


@_query("""
    select least(l_partkey % 50, l_suppkey % 50) as a, greatest(l_partkey % 50, l_suppkey % 50) as b, bit_or(1 << (l_linenumber % 6)::int)::bigint as
    marker from lineitem where l_partkey % 50 <> l_suppkey % 50 group by 1, 2
    """)
def a19_f30_edge_markers(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.call_function("mod", F.col("l_partkey"), F.lit(50)), F.call_function("mod", F.col("l_suppkey"), F.lit(50))
    edges = table(spark, d, "lineitem").select(a.alias("a"), b.alias("b"), "l_linenumber")
    return scenery.edge_markers(edges, F.expr("shiftleft(1L, cast(l_linenumber % 6 as int))"))


@_query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(h, 6) + 0.0 as h, round(case when m > 0 then (m - n) / m else 0 end, 6) + 0.0 as s,
    round(m, 6) + 0.0 as v from (select *, case when m = n then 0 else x - floor(x) end as h
    from (select *, case when m = n then 0 when m = r then (g - b) / (m - n) when m = g then (b - r) / (m - n) + 2 else (r - g) / (m - n) + 4 end / 6 as x
    from (select *, greatest(r, g, b) as m, least(r, g, b) as n from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50.0 as r,
    (l_partkey % 256) / 255.0 as g, (l_suppkey % 256) / 255.0 as b
    from lineitem))))
    """)
def f53_hsv(spark: SparkSession, d: str) -> DataFrame:
    r, g, b = F.col("l_quantity") / 50.0, F.call_function("mod", F.col("l_partkey"), F.lit(256)) / 255.0, F.call_function("mod", F.col("l_suppkey"), F.lit(256)) / 255.0
    h, s, v = features.hue_saturation_value(r, g, b)
    return table(spark, d, "lineitem").select(*KEY, _r(h).alias("h"), _r(s).alias("s"), _r(v).alias("v"))


@_query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when t > 0 then a / t else 0 end, 6) + 0.0 as grass, round(case when t > 0 then b /
    t else 0 end, 6) + 0.0 as rock from (select *, a + b as t from (select *, greatest(0.0, 1 - greatest(0.2 - x, x - 0.5, 0) / 0.1) * greatest(0.0, 1 -
    greatest(least(abs(y - 0.33), 1 - abs(y - 0.33)) - 0.1, 0 - least(abs(y - 0.33), 1 - abs(y - 0.33)), 0) / 0.2) as a, 0.1 as b
    from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50.0 as x, (l_partkey % 100) / 100.0 as y
    from lineitem)))
    """)
def f53_splat_weights(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("l_quantity") / 50.0, F.call_function("mod", F.col("l_partkey"), F.lit(100)) / 100.0
    a = features.soft_range(x, F.lit(0.2), F.lit(0.5), F.lit(0.1)) * features.soft_hue(y, F.lit(0.33), F.lit(0.1), F.lit(0.2))
    total = a + 0.1
    return table(spark, d, "lineitem").select(*KEY, _r(features.ratio(a, total)).alias("grass"), _r(features.ratio(F.lit(0.1), total)).alias("rock"))


@_query("""
    select p_partkey, lpad(bin((p_size / 64.0 * 16777216)::bigint), 24, '0') as quad, (case when p_retailprice < 771 then 771 when p_retailprice < 1285
    then 1285 when p_retailprice < 4369 then 4369 else 13107 end)::int as scale, case when p_size % 7 = 0 then 0.0 else least(1.0, greatest(0.1, 10 * 0.02
    * p_size / 255)) end as depth from part
    """)
def f35_f37_depth_and_quads(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", features.quad_string(F.col("p_size") / 64.0).alias("quad"), features.altitude_scale(F.col("p_retailprice")).alias("scale"), features.depth_ratio(F.col("p_size") % 7 == 0, F.lit(0.02), F.col("p_size")).alias("depth"))


@_query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1 / (1 + exp(-(l_quantity - 25) / 10)), 6) as p, round(1 / (1 + exp(l_quantity / 10 -
    2.5)), 6) as q from lineitem
    """)
def f56_sigmoid(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("l_quantity")
    return table(spark, d, "lineitem").select(*KEY, F.round(features.sigmoid((x - 25) / 10), 6).alias("p"), F.round(features.second_of_two(x / 10, F.lit(2.5)), 6).alias("q"))


@_query("""
    select id, round(case when w > 1e-6 then v / w else -1.0 end, 6) as altitude
    from (select p.id, coalesce(sum(exp(-sqrt(pow(p.x - s.sx, 2) + pow(p.y - s.sy, 2)) / 6.0)), 0) as w, coalesce(sum(s.value * exp(-sqrt(pow(p.x - s.sx,
    2) + pow(p.y - s.sy, 2)) / 6.0)), 0) as v from (select p_partkey as id, (p_partkey % 200)::double as x, (p_partkey % 150)::double as y
    from part) p left join (select (s_suppkey * 3 % 200)::double as sx, (s_suppkey * 7 % 150)::double as sy, s_acctbal as value
    from supplier) s on abs(p.x - s.sx) <= 3 and abs(p.y - s.sy) <= 3
    group by p.id)
    """)
def j10_band_weighted(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    points = table(spark, d, "part").select(k.alias("id"), F.call_function("mod", k, F.lit(200)).cast("double").alias("x"), F.call_function("mod", k, F.lit(150)).cast("double").alias("y"))
    samples = table(spark, d, "supplier").select(F.call_function("mod", s * 3, F.lit(200)).cast("double").alias("sx"), F.call_function("mod", s * 7, F.lit(150)).cast("double").alias("sy"), F.col("s_acctbal").alias("value"))
    return spatial.band_weighted(points, samples, 3.0, F.lit(-1.0)).withColumn("altitude", F.round("altitude", 6))


@_query()
def j11_junctions(spark: SparkSession, d: str) -> DataFrame:
    """Tests hold the rule against a plain loop: it goes from point to point, which SQL does not."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 1000.0).alias("lon"), (F.col("p_size") / 100.0).alias("lat"))
    return spatial.merge_junctions(p, 0.005)



@_query("select distinct p_brand || '.dds' as texture from part where p_brand || '.dds' not in (select distinct p_brand || '.dds' from part where p_size > 48)")
def j19_unused_textures(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.concat("p_brand", F.lit(".dds")).alias("texture"), "p_size")
    return tiles.unused(p, p.where("p_size > 48"), "texture")


@_query("""
    select l_partkey, l_suppkey, l_linenumber, l_orderkey from lineitem
    where l_returnflag = 'N' and (l_partkey % 64, l_suppkey % 64) in (select (l_partkey % 64, l_suppkey % 64)
    from lineitem where l_returnflag = 'R' and l_quantity > 45)
    """)
def j20_inland_water(spark: SparkSession, d: str) -> DataFrame:
    m = F.call_function("mod", F.col("l_partkey"), F.lit(64)), F.call_function("mod", F.col("l_suppkey"), F.lit(64))
    li = table(spark, d, "lineitem").withColumns({"til_x": m[0], "til_y": m[1]})
    sea = li.where("l_returnflag = 'R' and l_quantity > 45")
    return tiles.on_tiles_of(li.where("l_returnflag = 'N'"), sea, ["til_x", "til_y"]).select("l_partkey", "l_suppkey", "l_linenumber", "l_orderkey")


@_query("""
    select c_custkey as id, c_acctbal as value from customer where c_mktsegment = 'BUILDING'
    union select c_custkey, c_acctbal from customer where c_acctbal > 5000
    """)
def x1_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), "c_mktsegment")
    return c.where("c_mktsegment = 'BUILDING'").drop("c_mktsegment").unionByName(c.where("value > 5000").drop("c_mktsegment")).dropDuplicates(["id", "value"])


@_query("""
    select o_orderkey, coalesce(nullif(o_totalprice, 100000.0), nullif(c_acctbal, 0.0), -1.0) as altitude
    from orders left join customer on c_custkey = o_custkey
    """)
def j16_f66_priority(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    base, layer = o.select("o_orderkey", F.lit(-1.0).alias("altitude")), o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", F.coalesce(F.nullif("c_acctbal", F.lit(0.0)), F.lit(100000.0)).alias("altitude"))
    return raster.composite([layer, o.select("o_orderkey", F.col("o_totalprice").alias("altitude"))], base, ["o_orderkey"], "altitude", 100000.0)


# --- kernels, files and streams ---------------------------------------------------------------------------------------


def _rings(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of matched boxes as rings."""
    ring = lambda p: F.array(*(F.array(F.col(f"{p}{x}"), F.col(f"{p}{y}")) for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))))
    pairs = spatial.box_join(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), 16.0).where("id = r_id")
    return pairs.select("id", ring("").alias("truth"), ring("r_").alias("found"))


@_query(with_tables("""
    select id, (xmax - xmin) * (ymax - ymin) as area, round((xmin + xmax) / 2, 6) as cx, round((ymin + ymax) / 2, 6) as cy, round(sqrt(pow(dx, 2) +
    pow(dy, 2)), 6) as hausdorff, round(sqrt(pow(dx, 2) + pow(dy, 2)), 6) as centroid_distance, round((xmax - xmin - dx) * (ymax - ymin - dy), 6) as
    common_area from (select t.*, f.xmin - t.xmin as dx, f.ymin - t.ymin as dy
    from truth t join found f using (id)) where dx <= xmax - xmin and dy <= ymax - ymin
    """, "truth", "found"))
def f13_f19_ring_measures(spark: SparkSession, d: str) -> DataFrame:
    out = tile_kernels.ring_measures(_rings(spark, d), ["id"], "truth", "found")
    return out.select("id", "area", *(_r(F.col(c)).alias(c) for c in ("cx", "cy", "hausdorff", "centroid_distance", "common_area")))


@_query()
def a2_f20_boundary_scores(spark: SparkSession, d: str) -> DataFrame:
    return tile_kernels.boundary_scores(_rings(spark, d), ["id"], "truth", "found", 1.0)


@_query()
def f22_f24_f25_mask_objects(spark: SparkSession, d: str) -> DataFrame:
    return tile_kernels.mask_objects(adapters.rasters(spark, d), ["vec_id"], "px", 8, 0.02, 0, 1, 3)


@_query()
def w6_f47_f50_refine(spark: SparkSession, d: str) -> DataFrame:
    return tile_kernels.refine(adapters.rasters(spark, d), ["vec_id"], "px", 8, -32768.0)


@_query()
def f57_suppression(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    x, y = F.call_function("mod", F.col("l_partkey"), F.lit(20)).cast("double"), F.call_function("mod", F.col("l_suppkey"), F.lit(20)).cast("double")
    box = F.struct(F.col("l_linenumber").alias("n"), F.array(x, y, x + 8, y + 8).alias("box"), (F.col("l_quantity") / 50).alias("score"))
    grouped = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("b")).select("l_orderkey", F.transform("b", lambda v: v["box"]).alias("boxes"), F.transform("b", lambda v: v["score"]).alias("scores"))
    return tile_kernels.keep_best_boxes(grouped, ["l_orderkey"], "boxes", "scores")


@_query("select l_orderkey, count(*) as total, sum(l_quantity) as quantity, min(l_partkey) as first_part from lineitem group by 1")
def s5_s8_k5_nested_json(spark: SparkSession, d: str) -> DataFrame:
    """Items of an order to one JSON document and back."""
    li = table(spark, d, "lineitem")
    docs = writers.nested_json(li, ["l_orderkey"], ["l_partkey", "l_quantity"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "items")
    back = docs.select(F.from_json("json", "l_orderkey long, total long, items array<struct<l_partkey: long, l_quantity: double>>").alias("j")).select("j.*")
    return back.select("l_orderkey", "total", F.explode("items").alias("i")).groupBy("l_orderkey", "total").agg(F.sum("i.l_quantity").alias("quantity"), F.min("i.l_partkey").alias("first_part"))


@_query(
    with_tables("", "segments").rstrip() + """
    , v as (select l_orderkey, row_number() over w as seq, count(*) over (partition by l_orderkey) as n, printf('%.9f %.9f 0.0', 29 + x1 / 100, 41 + y1 / 100) as xyz from segments window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, x2)),
    m as (select *, sum((seq = 1 or seq = n)::int) over (partition by l_orderkey // 100 order by l_orderkey, seq rows unbounded preceding) as node from v where n > 1)
    select (l_orderkey // 100)::bigint as tile, string_agg(case when seq = 1 then 'BEGIN_SEGMENT 0 50 ' || node::bigint || ' ' || xyz when seq = n then 'END_SEGMENT ' || node::bigint || ' ' || xyz else 'SHAPE_POINT ' || xyz end, chr(10) order by l_orderkey, seq) as text
    from m group by 1
    """
)
def k9_network_text(spark: SparkSession, d: str) -> DataFrame:
    s = adapters.segments(spark, d)
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "x2"))
    roads = s.select(F.floor(F.col("l_orderkey") / 100).alias("tile"), F.col("l_orderkey").alias("road"), F.lit(50).alias("subtype"), seq.alias("seq"), (29 + F.col("x1") / 100).alias("lon"), (41 + F.col("y1") / 100).alias("lat"))
    return writers.network_text(roads, ["tile"])


@_query(
    with_tables("", "truth").rstrip() + """
    , b as (select *, floor(ymin / 120)::bigint as tile, 'facades/' || case when a < 100 then 'small' when a < 800 then 'medium' else 'large' end || '.fac' as facade, round_even(least(12.0, greatest(1.0, round_even((xmax - xmin) / 10, 0))) * 3.5, 0)::int as h from (select *, (xmax - xmin) * (ymax - ymin) * 20 as a from truth)),
    n as (select *, dense_rank() over (partition by tile order by facade) - 1 as k from b),
    p as (select *, printf('%.8f', 29 + xmin / 1e4) as l, printf('%.8f', 29 + xmax / 1e4) as r, printf('%.8f', 41 + ymin / 1e4) as s, printf('%.8f', 41 + ymax / 1e4) as t, 'POLYGON_POINT ' as o from n),
    lines as (
        select distinct tile, 0 as kind, k::bigint as place, 'POLYGON_DEF ' || facade as line from n
        union all
        select tile, 1, id, 'BEGIN_POLYGON ' || k || ' ' || h || ' 2' || chr(10) || 'BEGIN_WINDING' || chr(10) || o || l || ' ' || s || chr(10) || o || r || ' ' || s || chr(10) || o || r || ' ' || t || chr(10) || o || l || ' ' || t || chr(10) || 'END_WINDING' || chr(10) || 'END_POLYGON' from p
    )
    select tile, string_agg(line, chr(10) order by kind, place, line) as text from lines group by 1
    """
)
def k9_facade_text(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    point = lambda x, y: F.struct((29 + F.col(x) / 1e4).alias("lon"), (41 + F.col(y) / 1e4).alias("lat"))
    ring = F.array(point("xmin", "ymin"), point("xmax", "ymin"), point("xmax", "ymax"), point("xmin", "ymax"))
    height = geodesy.building_height(F.col("xmax") - F.col("xmin"), F.lit(None).cast("double"))
    facade = F.concat(F.lit("facades/"), features.size_bucket(spatial.box_area() * 20), F.lit(".fac"))
    return writers.facade_text(b.select(F.floor(F.col("ymin") / 120).alias("tile"), "id", facade.alias("facade"), ring.alias("ring"), height.alias("height")), ["tile"])


@_query("""
    select p_size, p_brand as layer, rank() over (partition by p_size, p_brand order by p_partkey) - 1 as number, rank() over (partition by p_size order
    by p_brand, p_partkey) - 1 as joined, p_partkey from part
    """)
def x5_join_overlays(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_size", F.col("p_brand").alias("layer"), (F.row_number().over(Window.partitionBy("p_size", "p_brand").orderBy("p_partkey")) - 1).cast("long").alias("number"), "p_partkey")
    return writers.join_overlays(p, ["p_size"])


@_query(with_tables("", "truth", "found").rstrip() + ", " + _MATCHES + " select 'Objects' as section, metric, value, case when metric = 'tp' then 'accepted' else '' end as notes from (select (select count(*) from truth)::double as n_gt, (select count(*) from found)::double as n_pred, (select count(*) from matches)::double as tp) unpivot (value for metric in (n_gt, n_pred, tp))")
def k6_metric_rows(spark: SparkSession, d: str) -> DataFrame:
    m = evaluation.object_metrics(adapters.truth_boxes(spark, d), adapters.found_boxes(spark, d), _matches(spark, d))
    return writers.metric_rows(m.select(*(F.col(c).cast("double").alias(c) for c in ("n_gt", "n_pred", "tp"))), "Objects", {"tp": "accepted"})


@_query("""
    select time_bucket(interval '1 hour', ts) as start, count(*) as samples, round(avg(value), 6) as average_fps, min(value) as min_fps, max(value) as
    max_fps from events where value > 0 group by 1
    """)
def t2_windowed_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = stream_frames.windowed_rates(e, "ts", "value", "1 hour")
    return out.withColumn("average_fps", _r(F.col("average_fps"))).withColumn("start", F.col("start").cast("timestamp_ntz"))


@_query()
def k2_k3_s4_s17_images(spark: SparkSession, d: str) -> DataFrame:
    """Tiles to PNG, TIFF and height files as bytes, with their sizes."""
    t = adapters.rasters(spark, d).select(F.col("vec_id").cast("string").alias("name"), raster.stretch(F.col("px"), F.lit(-0.5), F.lit(0.5)).alias("px"))
    out = [writers.image_bytes(t, k, 8).select("name", F.lit(k).alias("kind"), F.length("content").alias("size"), F.sha2("content", 256).alias("sha256")) for k in ("png", "tiff", "heights")]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- scenery ----------------------------------------------------------------------------------------------------------


@_query(
    """
    with n as (select p, row_number() over (order by p) - 1 as i from (select distinct c_acctbal * 40 as p from customer)),
    v as (select distinct o_totalprice as v from orders),
    low as (select v.v, n.p, n.i from v asof left join n on v.v >= n.p),
    pair as (select low.v, low.p as a, low.i, n.p as b, n.i as j from low asof left join n on low.v < n.p)
    select v, case when a is null or b - v < v - a then j else i end as idx from pair
    """
)
def j9_nearest(spark: SparkSession, d: str) -> DataFrame:
    values, nodes = table(spark, d, "orders").select(F.col("o_totalprice").alias("v")), table(spark, d, "customer").select((F.col("c_acctbal") * 40).alias("at"))
    return scenery.nearest(values, "v", nodes, "at")



@_query(with_tables("", "truth").rstrip() + ", grid as (select distinct p_size as x, p_partkey % 10 as y from part) select g.x, g.y, n.x as near_x, n.y as near_y from grid g join grid n on abs(g.x - n.x) <= 1 and abs(g.y - n.y) <= 1 and (g.x <> n.x or g.y <> n.y)")
def j17_neighbours(spark: SparkSession, d: str) -> DataFrame:
    grid = table(spark, d, "part").select(F.col("p_size").alias("x"), F.call_function("mod", F.col("p_partkey"), F.lit(10)).alias("y"))
    return scenery.neighbours(grid, "x", "y")


_POINTS = "select l_orderkey, (l_partkey * 7919 % 10007) / 10007.0 as x, ((l_suppkey * 104729 + l_orderkey) % 10009) / 10009.0 as y from lineitem"
_CELLS_OF = f"""
    with c as (select l, floor(x * (1 << l))::bigint as cx, floor(y * (1 << l))::bigint as cy, count(*) as size from ({_POINTS}), range(16) t(l) group by 1, 2, 3)
    select case when l = 0 then '' else lpad(bin(cx), l::int, '0') end || '/' || case when l = 0 then '' else lpad(bin(cy), l::int, '0') end as cell, l::int as depth, size
    from c where size <= 200 and (l = 0 or (l - 1, cx // 2, cy // 2) in (select (l, cx, cy) from c where size > 200))
"""


@_query(_CELLS_OF)
def a21_quadtree(spark: SparkSession, d: str) -> DataFrame:
    """Cells of at most 200 places each."""
    return scenery.quadtree(_tree_points(spark, d), "x", "y", 200)[1]


def _tree_points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey"), (F.call_function("mod", F.col("l_partkey") * 7919, F.lit(10007)) / 10007).alias("x"), (F.call_function("mod", F.col("l_suppkey") * 104729 + F.col("l_orderkey"), F.lit(10009)) / 10009).alias("y"))


@_query(f"select count(*) as buckets, round(avg(depth), 6) as mean_depth, round(avg(size), 6) as mean_size, max(depth) as max_depth from ({_CELLS_OF})")
def a21_quadtree_figures(spark: SparkSession, d: str) -> DataFrame:
    f = scenery.quadtree_figures(scenery.quadtree(_tree_points(spark, d), "x", "y", 200)[1])
    return f.select("buckets", _r(F.col("mean_depth")).alias("mean_depth"), _r(F.col("mean_size")).alias("mean_size"), "max_depth")



@_query("""
    select p_partkey, sum(h * w)::bigint as tiles, max((h - 1) * 512)::bigint as last_row, max((w - 1) * 512)::bigint as last_col
    from (select p_partkey, ceil(p_size * 100 / 512.0)::bigint as w, ceil((p_size * 70 + 1) / 512.0)::bigint as h
    from part) group by 1
    """)
def f41_slices(spark: SparkSession, d: str) -> DataFrame:
    s = scenery.slices(F.col("p_size") * 100, F.col("p_size") * 70 + 1, 512)
    return table(spark, d, "part").select("p_partkey", s.alias("s")).select("p_partkey", F.size("s").cast("long").alias("tiles"), F.array_max(F.transform("s", lambda t: t["row"])).alias("last_row"), F.array_max(F.transform("s", lambda t: t["col"])).alias("last_col"))


@_query("""
    select a as asked, max(z) as zoom from (select distinct p_size / 4.0 as a
    from part), (select z, 156543.0 / pow(2, z) as r from range(31) t(z))
    where r <= 1.1 * a and r = (select max(156543.0 / pow(2, q)) from range(31) u(q)
    where 156543.0 / pow(2, q) <= 1.1 * a) group by a
    """)
def f67_finest_level(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "part").select((F.col("p_size") / 4.0).alias("asked")).distinct()
    levels = spark.range(31).select(F.col("id").alias("zoom"), (156543.0 / F.pow(F.lit(2.0), F.col("id"))).alias("resolution"))
    return scenery.finest(levels, asked)


@_query("""
    select a.x, a.y, a.zoom, m.l as levels, a.x - (a.x // (1 << m.l)) * (1 << m.l) as qx, a.y - (a.y // (1 << m.l)) * (1 << m.l) as qy
    from (select p_partkey as x, p_partkey * 3 % 512 as y, 12::bigint as zoom
    from part) a join (select p.p_partkey as x, min(l)::int as l from part p, range(6) t(l)
    where (p.p_partkey // (1 << l), (p.p_partkey * 3 % 512) // (1 << l), 12 - l) in (select (s_suppkey // (1 << (s_suppkey % 5 + 1)), (s_suppkey * 3 %
    512) // (1 << (s_suppkey % 5 + 1)), 11 - s_suppkey % 5) from supplier)
    group by 1) m on m.x = a.x
    """)
def f67_parent_tiles(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    tiles_ = table(spark, d, "part").select(k.alias("x"), F.call_function("mod", k * 3, F.lit(512)).alias("y"), F.lit(12).cast("long").alias("zoom"))
    n = F.pow(F.lit(2), F.call_function("mod", s, F.lit(5)) + 1).cast("long")
    held = table(spark, d, "supplier").select(F.floor(s / n).alias("x"), F.floor(F.call_function("mod", s * 3, F.lit(512)) / n).alias("y"), (11 - F.call_function("mod", s, F.lit(5))).alias("zoom"))
    return scenery.with_parents(tiles_, held).where("levels is not null")


@_query("""
    select l_partkey, l_suppkey, avg(v) as v from (select l_partkey % 100 as l_partkey, l_suppkey % 10 as l_suppkey, l_quantity as v
    from lineitem) group by 1, 2
    """)
def a20_blend(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.call_function("mod", F.col("l_partkey"), F.lit(100)).alias("l_partkey"), F.call_function("mod", F.col("l_suppkey"), F.lit(10)).alias("l_suppkey"), F.col("l_quantity").alias("v"))
    return scenery.blend(li, ["l_partkey", "l_suppkey"], "v")


@_query("select p_partkey, p_retailprice >= 1500 and p_brand not in ('Brand#1', 'Brand#2') as masked from part")
def p16_large_lakes(spark: SparkSession, d: str) -> DataFrame:
    return scenery.large_lakes(table(spark, d, "part"), "p_brand", "p_retailprice", 1500.0, ["Brand#1", "Brand#2"]).select("p_partkey", "masked")


@_query("""
    select s_suppkey, s_suppkey * 7 % 400 - 200 between -90 and 90 and s_suppkey * 11 % 500 - 250 between -180 and 180 as good, s_suppkey * 7 % 400 - 200
    between -90 and 89 and s_suppkey * 11 % 500 - 250 between -180 and 179 as tile, s_suppkey > 0 and (s_suppkey & (s_suppkey - 1)) = 0 as power
    from supplier
    """)
def p19_p22_validation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    lat, lon = F.call_function("mod", k * 7, F.lit(400)) - 200, F.call_function("mod", k * 11, F.lit(500)) - 250
    text = F.concat_ws(",", lat.cast("string"), lon.cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", scenery.coordinates(text).isNotNull().alias("good"), scenery.tile_degrees(lat, lon).alias("tile"), scenery.power_of_two(k).alias("power"))


@_query(with_tables("select vec_id, list_max(list_transform(px, lambda x: trunc(least(1.0, greatest(0.0, (x + 0.25) / 0.5)) * 255)::int)) > 230 as high from rasters", "rasters"))
def p21_needs_mask(spark: SparkSession, d: str) -> DataFrame:
    px = F.transform(raster.stretch(F.col("px"), F.lit(-0.25), F.lit(0.25)), lambda v: v - 200)
    return adapters.rasters(spark, d).select("vec_id", scenery.needs_mask(px).alias("high"))


@_query("select p_partkey from part where p_retailprice >= 400 and p_retailprice / (p_size * 40.0) >= 0.8")
def p11_fill_ratio(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(scenery.fill_ratio(F.col("p_retailprice"), F.col("p_size"), F.lit(40.0), 0.8)).select("p_partkey")


@_query("""
    select t.id, coalesce(c.n, 0)::bigint as cuts, (case coalesce(c.n, 0) when 0 then 1 when 1 then 2 when 2 then 3 else 6 end)::int as parts
    from (select p_partkey as id from part) t left join (select id, count(*) as n
    from (select p_partkey as id, unnest([[p_partkey, p_partkey + 1], [p_partkey + 1, p_partkey + 2], [p_partkey, p_partkey + 2]]) as e
    from part) where (e[1], e[2]) in (select (s_suppkey * 2, s_suppkey * 2 + 1 + s_suppkey % 2)
    from supplier) group by 1) c using (id)
    """)
def f34_recut(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    triangles = table(spark, d, "part").select(k.alias("id"), k.alias("a"), (k + 1).alias("b"), (k + 2).alias("c"))
    return scenery.recut(triangles, table(spark, d, "supplier").select((s * 2).alias("u"), (s * 2 + 1 + F.call_function("mod", s, F.lit(2))).alias("v")))


@_query(with_tables("""
    select id, cx as cell_x, cy as cell_y, 'tex' || cx || '_' || cy as texture
    from (select id, floor((xmin * 2 + xmax) / 3 / 10)::bigint as cx, floor((ymin * 2 + ymax) / 3 / 10)::bigint as cy
    from truth)
    """, "truth"))
def j14_triangle_textures(spark: SparkSession, d: str) -> DataFrame:
    b = adapters.truth_boxes(spark, d)
    t = b.select("id", F.col("xmin").alias("x1"), F.col("ymin").alias("y1"), F.col("xmax").alias("x2"), F.col("ymin").alias("y2"), F.col("xmin").alias("x3"), F.col("ymax").alias("y3"))
    cells = t.select(F.floor((F.col("x1") * 2 + F.col("x2")) / 3 / 10).alias("cell_x"), F.floor((F.col("y1") * 2 + F.col("y3")) / 3 / 10).alias("cell_y")).distinct()
    named = cells.withColumn("texture", F.concat(F.lit("tex"), F.col("cell_x").cast("string"), F.lit("_"), F.col("cell_y").cast("string")))
    return scenery.triangle_textures(t, named, 10.0).select("id", "cell_x", "cell_y", "texture")


_GROUPS = """
    , hit as (select a.id as a, b.id as b from roads a join roads b on a.id <> b.id and a.xmin < b.xmax and b.xmin < a.xmax and a.ymin < b.ymax and b.ymin < a.ymax),
    reach(id, other) as (select id, id from roads union select reach.id, hit.b from reach join hit on hit.a = reach.other),
    roots as (select id, min(other) as root from reach group by 1)
"""


def _over_groups(query: str) -> str:
    return with_tables("", "roads").rstrip().replace("with ", "with recursive ", 1) + _GROUPS + query


@_query(_over_groups("select id, root from roots"))
def j8_merge_overlapping(spark: SparkSession, d: str) -> DataFrame:
    return scenery.merge_overlapping(adapters.road_boxes(spark, d), 16.0)



_DENSE = """
    select l_orderkey, seq, part, round(x1 + coalesce(part / (n + 1.0) * (nx - x1), 0), 6) + 0.0 as x, round(y1 + coalesce(part / (n + 1.0) * (ny - y1), 0), 6) + 0.0 as y
    from (
        select *, greatest(coalesce(ceil(sqrt(pow(nx - x1, 2) + pow(ny - y1, 2)) / 20) - 1, 0), 0)::bigint as n
        from (select l_orderkey, row_number() over w as seq, x1, y1, lead(x1) over w as nx, lead(y1) over w as ny from segments window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, x2))
    ), lateral (select unnest(range(n + 1)) as part)
"""


@_query(with_tables(_DENSE, "segments"))
def f38_w7_densify(spark: SparkSession, d: str) -> DataFrame:
    s = adapters.segments(spark, d)
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "x2")).cast("long")
    out = scenery.densify(s.select("l_orderkey", seq.alias("seq"), F.col("x1").alias("x"), F.col("y1").alias("y")), ["l_orderkey"], "seq", 20.0)
    return out.select("l_orderkey", "seq", "part", _r(F.col("x")).alias("x"), _r(F.col("y")).alias("y"))



@_query(with_tables("""
    select vec_id, k, x, y from (select vec_id, k::int as k, (vec_id * 7 + k * 13) % 100 / 100.0 as x, (vec_id * 11 + k * 17) % 100 / 100.0 as y, px
    from rasters, range(5) t(k)) where px[(floor(y * 8) * 8 + floor(x * 8))::int + 1] >= 0.02
    """, "rasters"))
def j6_j15_positions_on_mask(spark: SparkSession, d: str) -> DataFrame:
    t = adapters.rasters(spark, d)
    place = lambda a, b: F.call_function("mod", F.col("vec_id") * a + F.col("k") * b, F.lit(100)) / 100.0
    trees = t.select(F.col("vec_id").alias("tile"), "vec_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select("tile", "vec_id", "k", place(7, 13).alias("x"), place(11, 17).alias("y"))
    masks = t.select(F.col("vec_id").alias("tile"), F.lit(8).alias("width"), F.lit(8).alias("height"), raster.threshold_mask(F.col("px"), 0.02).alias("px"))
    return tiles.positions_on_mask(trees, masks).select("vec_id", "k", "x", "y")


@_query("select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as k from orders qualify k <= 50")
def o1_o3_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 tiles of an order, as a debugging limit takes them."""
    top = table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)
    return top.select("o_orderkey", F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long").alias("k"))


@_query(with_tables("select vec_id, list_transform(px, lambda v: trunc((v - list_min(px)) / (list_max(px) - list_min(px)) * 255)::int) as bytes from rasters", "rasters"))
def f43_eight_bits(spark: SparkSession, d: str) -> DataFrame:
    return adapters.rasters(spark, d).select("vec_id", colours.to_eight_bits(F.col("px")).alias("bytes"))


@_query(f"""
    select {_K}, trunc((1 - s) * 255)::int as red, trunc(s * 255)::int as green, (l_partkey * 37 % 65536 // 256)::int as upper, round(least(255.0,
    greatest(0.0, (l_quantity * 5 + 10 - 128) * 1.5 + 128)), 6) as c, round(20 + pow(least(1.0, greatest(0.0, (l_quantity - 5) / 40)), 1 / 2.2) * 200, 6)
    as level, round(3 * s * s - 2 * s * s * s, 6) as spline, round(2 * s - s * s, 6) as parabola
    from (select *, least(1.0, greatest(0.0, (l_quantity - 1) / 49)) as s
    from lineitem)
    """)
def f49_f52_f54_colours(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    red, green = colours.red_green(q, F.lit(1.0), F.lit(50.0))
    upper = colours.from_uint16(F.call_function("mod", F.col("l_partkey") * 37, F.lit(65536)))
    share = (q - 1) / 49
    return table(spark, d, "lineitem").select(*KEY, red.alias("red"), green.alias("green"), upper.alias("upper"), F.round(colours.contrast(q * 5, 10, 1.5), 6).alias("c"), F.round(colours.levels(q, 5, 2.2, 45, 20, 220), 6).alias("level"), F.round(colours.transition(share, "spline"), 6).alias("spline"), F.round(colours.transition(share, "parabolic"), 6).alias("parabola"))


@_query("""
    select r as "row", c as col, greatest(max(w), 0.5::double) as weight
    from (select s_suppkey * 37 % 990 as r0, s_suppkey * 53 % 990 as c0, (1.0 + s_suppkey % 3)::double as w, s_suppkey % 6 as n
    from supplier), range(1001) a(r), range(1001) b(c) where r between r0 and least(r0 + n, 1000) and c between c0 and least(c0 + 4, 1000)
    group by 1, 2
    """)
def f55_weight_map(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    m = lambda a, n: F.call_function("mod", k * a, F.lit(n))
    boxes = table(spark, d, "supplier").select(m(37, 990).alias("row0"), (m(37, 990) + m(1, 6)).alias("row1"), m(53, 990).alias("col0"), (m(53, 990) + 4).alias("col1"), (1.0 + m(1, 3)).alias("weight"))
    return scenery.weight_map(boxes, 1001, 0.5)


_LINES = """
    with t as (select n_nationkey - 10 as lat, n_nationkey * 7 - 80 as lon from nation),
    lines as (
        select lat, lon, 'x' as axis, n * 16 as n, n * 16 / 8192.0 * 360 - 180 - lon as place from t, range(512) r(n)
        union all
        select lat, lon, 'y', n * 16, degrees(2 * atan(exp(pi() * (1 - 2 * n * 16 / 8192.0))) - pi() / 2) - lat from t, range(512) r(n)
    )
    select lat, lon, axis, n, round_even(place, 9) + 0.0 as "at" from lines where round_even(place, 9) between 0 and 1
"""


@_query(_LINES)
def f64_ortho_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return scenery.ortho_lines(table(spark, d, "nation").select((k - 10).alias("lat"), (k * 7 - 80).alias("lon")), 13)



@_query("select p_size as relation, min(p_partkey) as ring, true as closed from part group by 1, p_partkey % 3")
def j12_rings(spark: SparkSession, d: str) -> DataFrame:
    """Ways of a size and remainder in a circle: each ends where the next begins."""
    by = Window.partitionBy("p_size", F.call_function("mod", F.col("p_partkey"), F.lit(3))).orderBy("p_partkey")
    whole = Window.partitionBy("p_size", F.call_function("mod", F.col("p_partkey"), F.lit(3)))
    ways = table(spark, d, "part").select(F.col("p_size").alias("relation"), F.col("p_partkey").alias("way"), F.col("p_partkey").alias("first"), F.coalesce(F.lead("p_partkey").over(by), F.min("p_partkey").over(whole)).alias("last"))
    return scenery.stitch_rings(ways)


@_query("""
    select p_partkey, round(case p_size % 3 when 0 then 0.0 when 1 then avg(p_retailprice) over (partition by p_brand, p_size % 3) else p_retailprice end,
    6) as level from part
    """)
def f33_node_levels(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("sea"), F.lit("water"), F.lit("land")), F.col("p_size") % 3 + 1)
    nodes = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("body"), kind.alias("kind"), F.col("p_retailprice").alias("z"))
    return scenery.node_levels(nodes, "water", "sea").select("p_partkey", F.round("level", 6).alias("level"))
