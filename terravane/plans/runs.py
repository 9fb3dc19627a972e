"""Whole runs put together from operators: what a scene's builder does tile by tile, as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import raster, tiles
from ..sources import scenery_files


@dataclass
class Trees:
    """Masks (tile, px), positions (tile, x, y), documents (tile, json) and one row of counters."""

    masks: DataFrame
    positions: DataFrame
    documents: DataFrame
    counters: DataFrame


def plant_trees(greens: DataFrame, roads: DataFrame, width: int, height: int, *, limit: float, density: float, seed: int = 42) -> Trees:
    """From tiles of a green index (tile, px) and of road masks (tile, px; a missing one is empty) to trees: pixels that reach
    the limit and are no road, a share of them drawn without replacement, as places from 0 to 1."""
    road = F.coalesce("road", F.array_repeat(F.lit(0), width * height))
    both = greens.select("tile", raster.threshold_mask(F.col("px"), limit).alias("tree")).join(roads.select("tile", F.col("px").alias("road")), "tile", "left")
    masks = both.select("tile", raster.and_not(F.col("tree"), road).alias("px"))
    pixels = raster.pixels(masks, "px", width).where("v > 0").select("tile", "row", "col")
    drawn = tiles.density_sample(pixels, ["tile"], ["row", "col"], density, seed)
    positions = drawn.select("tile", ((F.col("col") + 0.5) / width).alias("x"), ((F.col("row") + 0.5) / height).alias("y"))
    counts = masks.select("tile", raster.mask_share(F.col("px"))[0].alias("n")).agg(F.count("*").alias("tiles"), F.sum("n").alias("tree_pixels"))
    counters = counts.crossJoin(F.broadcast(positions.agg(F.count("*").alias("trees"))))  # one row each
    return Trees(masks, positions, scenery_files.tree_documents(positions), counters)


def for_each(tasks: DataFrame, function: Callable[[DataFrame], DataFrame], partitions: int) -> DataFrame:
    """What a function of DataFrames gives for tasks that are dealt to so many partitions: Spark's scheduler is the queue, and
    tasks of lost executors run again."""
    return function(tasks.repartition(partitions))
