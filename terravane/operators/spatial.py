"""Joins in space as equi-joins on grid cells.

A box goes to every cell that it touches. A pair that meets in several cells counts in one of them only, that of the
lower left corner of the two boxes' intersection, so no distinct is needed. Boxes much longer than a cell are dealt to
cells of a coarser level, so that no box goes to more than a few cells; levels meet each other pairwise. Cells are ordinary
join keys: Spark plans them by size, and AQE splits crowded ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _lineage

BOX = ("xmin", "ymin", "xmax", "ymax")


#: Cells along a side of a box at most, and what a level's cells are longer than the one's below by.
_REACH = 4
_COARSER = 8


def _leveled(df: DataFrame, box: tuple[str, ...], cell: float, prefix: str) -> DataFrame:
    """Rows with the level whose cells their box spans a few of."""
    side = F.greatest(F.col(box[2]) - F.col(box[0]), F.col(box[3]) - F.col(box[1]))
    level = F.ceil(F.log(F.greatest(side / (cell * _REACH), F.lit(1.0))) / F.log(F.lit(float(_COARSER))) - 1e-9)
    return df.where(side.isNotNull()).withColumn(f"{prefix}level", level.cast("int"))


def _dealt(df: DataFrame, box: tuple[str, ...], size: Column, prefix: str) -> DataFrame:
    x0, y0, x1, y1 = (F.floor(F.col(c) / size) for c in box)
    return df.withColumn(f"{prefix}cx", F.explode(F.sequence(x0, x1))).withColumn(f"{prefix}cy", F.explode(F.sequence(y0, y1)))


def box_join(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Pairs of rows whose boxes touch. Columns: the left's, and the right's after ``r_``. Null boxes meet nothing."""
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    r_box = tuple(f"r_{c}" for c in BOX)
    l, r = _leveled(left, BOX, cell, "l"), _leveled(right, r_box, cell, "r")
    # Each side goes to the cells of its own level and of those coarser ones that the other side has.
    levels = lambda df, c: sorted(x[0] for x in df.select(c).distinct().collect())  # some ten at most: sizes are doubles
    ours, theirs = levels(l, "llevel"), levels(r, "rlevel")
    size = F.lit(cell) * F.pow(F.lit(float(_COARSER)), F.col("level"))
    at = lambda df, own, others: df.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, others)) if others else F.array().cast("array<int>"), lambda v: v >= F.col(own))))
    both = sorted({*ours, *theirs})
    l, r = _dealt(at(l, "llevel", both), BOX, size, "l").withColumnRenamed("level", "lat"), _dealt(at(r, "rlevel", both), r_box, size, "r").withColumnRenamed("level", "rat")
    pairs = l.join(r, (F.col("lat") == F.col("rat")) & (F.col("lcx") == F.col("rcx")) & (F.col("lcy") == F.col("rcy")) & (F.col("lat") == F.greatest("llevel", "rlevel")))
    meets = (F.col("xmin") <= F.col("r_xmax")) & (F.col("r_xmin") <= F.col("xmax")) & (F.col("ymin") <= F.col("r_ymax")) & (F.col("r_ymin") <= F.col("ymax"))
    across = F.lit(cell) * F.pow(F.lit(float(_COARSER)), F.col("lat"))
    once = (F.col("lcx") == F.floor(F.greatest("xmin", "r_xmin") / across)) & (F.col("lcy") == F.floor(F.greatest("ymin", "r_ymin") / across))
    return pairs.where(meets & once).drop("lcx", "lcy", "rcx", "rcy", "llevel", "rlevel", "lat", "rat")


def connected(nodes: DataFrame, links: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, id, root): the smallest id that links (keys, a, b) reach from each node (keys, id). In each round a node takes
    the smallest root of its neighbours, and then that of its root, so chains shorten by halves."""
    links = _lineage.settle(links.select(*keys, "a", "b").where("a != b"))
    both = _lineage.settle(links.unionByName(links.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    root = nodes.select(*keys, "id", F.col("id").alias("root"))
    while True:
        near = both.join(root.select(*keys, F.col("id").alias("b"), "root"), [*keys, "b"]).groupBy(*keys, F.col("a").alias("id")).agg(F.min("root").alias("near"))
        new = root.join(near, [*keys, "id"], "left").select(*keys, "id", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("to"))
        hop = new.select(*keys, F.col("id").alias("to"), F.col("to").alias("far"))
        new = _lineage.settle(new.join(hop, [*keys, "to"], "left").select(*keys, "id", "old", F.least("to", F.coalesce("far", "to")).alias("root")))
        root = new.select(*keys, "id", "root")
        if new.where("old != root").isEmpty():
            return root


def intersection_area() -> Column:
    """Of a pair from ``box_join``."""
    w = F.least("xmax", "r_xmax") - F.greatest("xmin", "r_xmin")
    h = F.least("ymax", "r_ymax") - F.greatest("ymin", "r_ymin")
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def box_area(prefix: str = "") -> Column:
    return (F.col(f"{prefix}xmax") - F.col(f"{prefix}xmin")) * (F.col(f"{prefix}ymax") - F.col(f"{prefix}ymin"))


def without_collisions(boxes: DataFrame, blockers: DataFrame, key: str, cell: float) -> DataFrame:
    """Boxes that share area with no blocker; boxes with a null side go as well."""
    hit = box_join(boxes, blockers, cell).where(intersection_area() > 0).select(key).distinct()
    whole = F.lit(True)
    for c in BOX:
        whole = whole & F.col(c).isNotNull()
    return boxes.where(whole).join(hit, key, "left_anti")


def clip_segments(segments: DataFrame, tile: float) -> DataFrame:
    """Segments (x1, y1, x2, y2) cut into the square tiles they cross, by Liang and Barsky's limits; parts shorter than
    1e-9 go. Adds tile_x, tile_y and the cut ends ax, ay, bx, by. Of each column of tiles only those rows are asked that the
    segment has in it, so long slanted segments make no more tiles than they cross."""
    x0, x1 = F.least("x1", "x2"), F.greatest("x1", "x2")
    by_column = segments.withColumn("tile_x", F.explode(F.sequence(F.floor(x0 / tile), F.floor(x1 / tile))))
    slope = (F.col("y2") - F.col("y1")) / F.when(F.col("x2") != F.col("x1"), F.col("x2") - F.col("x1"))
    at = lambda x: F.coalesce(F.col("y1") + slope * (x - F.col("x1")), F.col("y1"))
    left, right = at(F.greatest(x0, F.col("tile_x") * tile)), F.when(F.col("x1") == F.col("x2"), F.col("y2")).otherwise(at(F.least(x1, (F.col("tile_x") + 1) * tile)))
    near = lambda y, edge: F.floor(y / tile + edge * 1e-9)  # noqa: E731  a hair more, as the limits below decide
    cut = by_column.withColumn("tile_y", F.explode(F.sequence(near(F.least(left, right), -1), near(F.greatest(left, right), 1))))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def limits(start: Column, step: Column, low: Column, high: Column) -> tuple[Column, Column]:
        safe = F.when(step != 0, step)
        a, b = (low - start) / safe, (high - start) / safe
        inside = (start >= low) & (start <= high)
        return F.coalesce(F.least(a, b), F.when(inside, 0.0).otherwise(2.0)), F.coalesce(F.greatest(a, b), F.when(inside, 1.0).otherwise(-1.0))

    ax, bx = limits(F.col("x1"), dx, F.col("tile_x") * tile, (F.col("tile_x") + 1) * tile)
    ay, by = limits(F.col("y1"), dy, F.col("tile_y") * tile, (F.col("tile_y") + 1) * tile)
    t0, t1 = F.greatest(ax, ay, F.lit(0.0)), F.least(bx, by, F.lit(1.0))
    cut = cut.withColumn("t0", t0).withColumn("t1", t1).where("t1 > t0")
    cut = cut.withColumns({"ax": F.col("x1") + F.col("t0") * dx, "ay": F.col("y1") + F.col("t0") * dy, "bx": F.col("x1") + F.col("t1") * dx, "by": F.col("y1") + F.col("t1") * dy})
    return cut.where(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")) >= 1e-9).drop("t0", "t1")


def band_weighted(points: DataFrame, samples: DataFrame, width: float, fallback: Column) -> DataFrame:
    """Per point (id, x, y) the mean of sample values (sx, sy, value) within ``width`` along both axes, by weights
    exp(-d / 2w) over the distance d; the fallback where weights sum to 1e-6 or less."""
    near = samples.withColumn("cx", F.explode(F.sequence(F.floor(F.col("sx") / width) - 1, F.floor(F.col("sx") / width) + 1))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("sy") / width) - 1, F.floor(F.col("sy") / width) + 1)))
    at = points.withColumn("px", F.floor(F.col("x") / width)).withColumn("py", F.floor(F.col("y") / width))
    pairs = at.join(near, (F.col("px") == F.col("cx")) & (F.col("py") == F.col("cy")) & (F.abs(F.col("x") - F.col("sx")) <= width) & (F.abs(F.col("y") - F.col("sy")) <= width), "left")
    w = F.exp(-F.hypot(F.col("x") - F.col("sx"), F.col("y") - F.col("sy")) / (2 * width))
    sums = pairs.groupBy("id", "x", "y").agg(F.coalesce(F.sum(w), F.lit(0.0)).alias("w"), F.coalesce(F.sum(w * F.col("value")), F.lit(0.0)).alias("v"))
    return sums.select("id", F.when(F.col("w") > 1e-6, F.col("v") / F.when(F.col("w") > 1e-6, F.col("w"))).otherwise(fallback).alias("altitude"))


def blended_at_border(value: Column, beyond: Column, x: Column, y: Column, width: float = 0.0003) -> Column:
    """A value inside the unit square that goes over to another one along a border of this width."""
    near = F.least(x, 1 - x, y, 1 - y) / width
    return F.when(near < 1, near * value + (1 - near) * beyond).otherwise(value)


#: Cells along a side of a block, whose places are decided in one task.
_BLOCK = 32
_OPEN, _JUNCTION, _NEAR_ONE = 0, 1, 2


def _decided(tolerance: float):
    """Places of blocks and of the cells around them, in order of id: of a block's own open places the state, as far as that of
    all earlier places near them is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by("id")
        asked = table["own"].to_numpy() & (table["state"].to_numpy() == _OPEN)
        states, seen = table["state"].to_pylist(), {}
        for k, (tx, ty, cx, cy, x, y) in enumerate(zip(*(table[c].to_pylist() for c in ("tx", "ty", "cx", "cy", "lon", "lat")), strict=True)):
            if asked[k]:
                near = [s for i in (-1, 0, 1) for j in (-1, 0, 1) for s, u, v in seen.get((tx, ty, cx + i, cy + j), ()) if abs(x - u) < tolerance and abs(y - v) < tolerance]
                states[k] = _NEAR_ONE if _JUNCTION in near else _OPEN if near else _JUNCTION
            if states[k] != _NEAR_ONE:
                seen.setdefault((tx, ty, cx, cy), []).append((states[k], x, y))
        out = table.set_column(table.schema.get_field_index("state"), "state", pa.array(states, pa.int32())).filter(pa.array(asked))
        yield from out.select(["id", "lon", "lat", "cx", "cy", "state"]).combine_chunks().to_batches()

    return run


def merge_junctions(points: DataFrame, tolerance: float = 5e-6) -> DataFrame:
    """(id, junction): in order of id, a point joins the first junction within the tolerance along both axes, else it is a
    junction itself; so junctions are the points with no earlier junction near.

    Points at one place share their junction, so places are decided, each by its smallest id. Blocks of cells are decided in
    order of id as far as what lies around them is known; rounds go on for chains of near places that cross blocks. Points
    without a finite place are near none.
    """
    size, kind = F.lit(tolerance), dict(points.dtypes)["id"]
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    given = points.select("id", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat")).withColumn("_placed", finite("lon") & finite("lat"))
    placed = given.where("_placed").groupBy("lon", "lat").agg(F.min("id").alias("id"))
    open_ = _lineage.settle(placed.select("id", "lon", "lat", F.floor(F.col("lon") / size).alias("cx"), F.floor(F.col("lat") / size).alias("cy"), F.lit(_OPEN).alias("state")))
    block = lambda c, by: F.floor((F.col(c) + by) / _BLOCK)
    around = lambda c: F.explode(F.array_distinct(F.array(block(c, -1), block(c, 0), block(c, 1))))
    places, junctions = open_.drop("state"), None
    while True:
        rows = open_ if junctions is None else open_.unionByName(junctions)
        dealt = rows.withColumn("tx", around("cx")).withColumn("ty", around("cy")).withColumn("own", (F.col("tx") == block("cx", 0)) & (F.col("ty") == block("cy", 0)))
        done = _lineage.settle(dealt.repartition("tx", "ty").mapInArrow(_decided(tolerance), f"id {kind}, lon double, lat double, cx long, cy long, state int"))
        new = done.where(F.col("state") == _JUNCTION)
        junctions = new if junctions is None else _lineage.settle(junctions.unionByName(new))
        open_ = done.where(F.col("state") == _OPEN)
        if open_.isEmpty():
            break
    # A cell has one junction at most, so a place meets nine of them at most.
    step = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    spread = junctions.withColumn("dx", step).withColumn("dy", step).select(F.col("id").alias("to"), F.col("lon").alias("u"), F.col("lat").alias("v"), (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"))
    near = (F.abs(F.col("lon") - F.col("u")) < size) & (F.abs(F.col("lat") - F.col("v")) < size) & (F.col("to") <= F.col("id"))
    first = places.join(spread, ["cx", "cy"]).where(near).groupBy("lon", "lat").agg(F.min("to").alias("junction"))
    return given.where("_placed").join(first, ["lon", "lat"]).select("id", "junction").unionByName(given.where("not _placed").select("id", F.col("id").alias("junction")))
