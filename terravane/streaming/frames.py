"""Frame rates over event time: the batch summaries as a stream with watermark and tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_rates(frames: DataFrame, time: str, fps: str, width: str, late: str | None = None) -> DataFrame:
    """Samples, mean, least and most of positive rates in windows of ``width``. On a stream, ``late`` is how long after the
    newest event older ones are still counted; a batch has no need of it."""
    rows = frames.where(F.col(fps) > 0)
    if late:
        rows = rows.withWatermark(time, late)
    out = rows.groupBy(F.window(time, width).alias("w")).agg(F.count("*").alias("samples"), F.avg(fps).alias("average_fps"), F.min(fps).alias("min_fps"), F.max(fps).alias("max_fps"))
    return out.select(F.col("w.start").alias("start"), "samples", "average_fps", "min_fps", "max_fps")
