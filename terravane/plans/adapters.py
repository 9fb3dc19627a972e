"""The driver's star-schema tables as boxes, points, rasters, frame series, polylines, tags and tile names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def truth_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for each part on a lattice of 40 columns."""
    k = F.col("p_partkey")
    x, y = (F.call_function("mod", k, F.lit(40)) * 12).cast("double"), (F.floor(k / 40) * 12).cast("double")
    return table(spark, sf_dir, "part").select(k.alias("id"), x.alias("xmin"), y.alias("ymin"), (x + 4 + F.call_function("mod", k, F.lit(5))).alias("xmax"), (y + 4 + F.call_function("mod", k, F.lit(3))).alias("ymax"))


def found_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same boxes moved by parts of their keys, every eleventh missing."""
    k = F.col("id")
    dx, dy = F.call_function("mod", k, F.lit(7)) * 0.5, F.call_function("mod", k, F.lit(4)) * 0.5
    boxes = truth_boxes(spark, sf_dir).where(F.call_function("mod", k, F.lit(11)) != 0)
    return boxes.select("id", (F.col("xmin") + dx).alias("xmin"), (F.col("ymin") + dy).alias("ymin"), (F.col("xmax") + dx).alias("xmax"), (F.col("ymax") + dy).alias("ymax"))


def road_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thin box for each supplier, as a road's buffer."""
    k = F.col("s_suppkey")
    x, y = (F.call_function("mod", k * 7, F.lit(480))).cast("double"), (F.call_function("mod", k * 13, F.lit(600))).cast("double")
    return table(spark, sf_dir, "supplier").select(k.alias("id"), x.alias("xmin"), y.alias("ymin"), (x + 30).alias("xmax"), (y + 2).alias("ymax"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lat, lon) of line items."""
    li = table(spark, sf_dir, "lineitem")
    lat = F.call_function("mod", F.col("l_suppkey"), F.lit(160)) - 80 + F.col("l_linenumber") / 10.0
    lon = F.call_function("mod", F.col("l_partkey"), F.lit(360)) - 180 + F.col("l_linenumber") / 8.0
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as a tile of 8 by 8 pixels."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.call_function("mod", F.col("vec_id"), F.lit(25)).alias("tile_x"), F.floor(F.col("vec_id") / 25).alias("tile_y"), "label", F.col("embedding").cast("array<double>").alias("px"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames: a rate, its time, and the order."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.col("value").alias("fps"), F.when(F.col("value") > 0, 1 / F.when(F.col("value") > 0, F.col("value"))).alias("dt"), "props")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment for each line item with a fixed start and end."""
    li = table(spark, sf_dir, "lineitem")
    x1 = F.call_function("mod", F.col("l_partkey"), F.lit(97)) + 0.25
    y1 = F.call_function("mod", F.col("l_suppkey"), F.lit(89)) + 0.5
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), (x1 + F.call_function("mod", F.col("l_orderkey"), F.lit(13)) - 6).cast("double").alias("x2"), (y1 + F.col("l_linenumber") - 3).cast("double").alias("y2"))


# The same adapters as SQL, for the queries' counterparts.
SQL = {
    "truth": "select p_partkey as id, (p_partkey % 40 * 12)::double as xmin, (p_partkey // 40 * 12)::double as ymin, (p_partkey % 40 * 12 + 4 + p_partkey % 5)::double as xmax, (p_partkey // 40 * 12 + 4 + p_partkey % 3)::double as ymax from part",
    "found": "select id, xmin + id % 7 * 0.5 as xmin, ymin + id % 4 * 0.5 as ymin, xmax + id % 7 * 0.5 as xmax, ymax + id % 4 * 0.5 as ymax from truth where id % 11 <> 0",
    "roads": "select s_suppkey as id, (s_suppkey * 7 % 480)::double as xmin, (s_suppkey * 13 % 600)::double as ymin, (s_suppkey * 7 % 480 + 30)::double as xmax, (s_suppkey * 13 % 600 + 2)::double as ymax from supplier",
    "places": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_suppkey % 160 - 80 + l_linenumber / 10.0)::double as lat, (l_partkey % 360 - 180 + l_linenumber / 8.0)::double as lon from lineitem",
    "rasters": "select vec_id, vec_id % 25 as tile_x, vec_id // 25 as tile_y, label, embedding::double[] as px from embeddings",
    "frames": "select event_id, ts, user_id, event_type, value as fps, case when value > 0 then 1 / value end as dt, props from events",
    "segments": "select *, x1 + l_orderkey % 13 - 6 as x2, y1 + l_linenumber - 3 as y2 from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 97 + 0.25)::double as x1, (l_suppkey % 89 + 0.5)::double as y1 from lineitem)",
    "pixels": "select vec_id, tile_x, tile_y, label, (i // 8)::int as \"row\", (i % 8)::int as col, px[i + 1] as v from rasters, range(64) r(i)",
}


def with_tables(query: str, *names: str) -> str:
    """A query over adapters, which may build on each other in the order given."""
    return "with " + ", ".join(f"{n} as ({SQL[n]})" for n in names) + " " + query
