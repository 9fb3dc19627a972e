"""Frame-rate summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import ratio
from ._order import running


def names_frame_rate(header: str) -> bool:
    """Whether a header speaks of actual frames (f-act, fact), of a frame and after it a rate, or has the word fps."""
    text = header.replace("_", " ").strip().lower()
    frame = text.find("frame")
    words = "".join(c if c.isalnum() else " " for c in text).split()
    return "f-act" in text or "fact" in text or (frame >= 0 and "rate" in text[frame + 5 :]) or "fps" in words


def fps_column(headers: list[str]) -> str:
    """The first header that names frames a second."""
    for h in headers:
        if names_frame_rate(h):
            return h
    raise ValueError("no column of frame rates")


def positive_rates(rows: DataFrame, headers: list[str]) -> DataFrame:
    """(file, line, fps) of samples (file, line, values) whose frame rate is above 0, by the headers' frame-rate column."""
    return rows.select("file", "line", F.element_at("values", headers.index(fps_column(headers)) + 1).alias("fps")).where("fps > 0")


def fps_summary(samples: DataFrame, fps: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Count, mean, one-percent low, least and most of positive rates. The low is the value at index floor(n / 100) of
    the ascending rates, not interpolated: found by counting distinct rates, so no key is gathered."""
    x = samples.where(F.col(fps) > 0)
    counts = x.groupBy(*keys, F.col(fps).alias("v")).agg(F.count("*").alias("c"))
    placed = _with_total(running(counts, ["v"], "c", "before", keys), counts, keys)
    at = F.greatest(F.lit(0), F.least(F.col("n") - 1, (F.col("n") * 0.01).cast("long")))
    low = F.max(F.when((F.col("before") <= at) & (at < F.col("before") + F.col("c")), F.col("v")))
    return placed.groupBy(*keys).agg(F.sum("c").alias("sample_count"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("average_fps"), low.alias("one_percent_low_fps"), F.min("v").alias("min_fps"), F.max("v").alias("max_fps"))


def _with_total(rows: DataFrame, counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``rows`` with the number n of all samples of their key."""
    n = counts.groupBy(*keys).agg(F.sum("c").alias("n"))
    return rows.join(n, list(keys)) if keys else rows.crossJoin(F.broadcast(n))  # one row


def recorder_summary(frames: DataFrame, seconds: str, keys: tuple[str, ...] = (), memory: tuple[str, ...] = ()) -> DataFrame:
    """Frame times to frames, mean rate n / time, low rate of the slowest hundredth of frames (rounded up), least and most;
    and the peak of each ``memory`` column (bytes), in megabytes. The slowest frames come from counts by time."""
    x = frames.where(F.col(seconds) > 0)
    counts = x.groupBy(*keys, (-F.col(seconds)).alias("v")).agg(F.count("*").alias("c"), *(F.max(m).alias(m) for m in memory))
    placed = _with_total(running(counts, ["v"], "c", "before", keys), counts, keys)
    wanted = F.ceil(F.col("n") * 0.01)
    taken, dt = F.least(F.col("c"), F.greatest(wanted - F.col("before"), F.lit(0))), -F.col("v")
    peaks = [(F.max(m) / (1024.0 * 1024.0)).alias(f"{m}_mb") for m in memory]
    return placed.groupBy(*keys).agg(
        F.sum("c").alias("frames"), (F.sum("c") / F.sum(dt * F.col("c"))).alias("average_fps"), (F.sum(taken) / F.sum(taken * dt)).alias("one_percent_low_fps"), (1 / F.max(dt)).alias("min_fps"), (1 / F.min(dt)).alias("max_fps"), *peaks
    )


def after_warm_up(frames: DataFrame, seconds: str, order: tuple[str, ...], warm_up: float, window: float | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Frames that begin ``warm_up`` seconds of frame time or more after the first, and within ``window`` from there."""
    timed = running(frames.withColumn("_dt", F.coalesce(F.col(seconds).cast("double"), F.lit(0.0))), list(order), "_dt", "_before", keys)
    kept = timed.withColumn("elapsed", F.col("_before") + F.col("_dt")).drop("_dt", "_before").where(F.col("elapsed") >= warm_up)
    return kept.where(F.col("elapsed") < warm_up + window) if window is not None else kept


def share(part: Column, whole: Column) -> Column:
    return 100 * ratio(part, whole)
