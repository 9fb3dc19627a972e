"""Object matching and accuracy metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import ratio
from ._order import percentiles, running
from .spatial import box_area, box_join, intersection_area


def overlaps(truth: DataFrame, found: DataFrame, cell: float) -> DataFrame:
    """(gt_idx, pred_idx, iou, gt_area, pred_area) of boxes (id and sides) that share area."""
    inter = intersection_area()
    pairs = box_join(truth, found, cell).where(inter > 0)
    union = box_area() + box_area("r_") - inter
    return pairs.select(F.col("id").alias("gt_idx"), F.col("r_id").alias("pred_idx"), ratio(inter, union).alias("iou"), box_area().alias("gt_area"), box_area("r_").alias("pred_area"))


def match_objects(pairs: DataFrame, threshold: float) -> DataFrame:
    """For each truth its best candidate, if that reaches the threshold and no earlier truth (by gt_idx) has claimed it.

    There is no second choice: a truth whose best candidate is taken stays unmatched. Equal scores go to the smaller
    pred_idx.
    """
    best = Window.partitionBy("gt_idx").orderBy(F.desc("iou"), "pred_idx")
    first = Window.partitionBy("pred_idx").orderBy("gt_idx")
    top = pairs.withColumn("n", F.row_number().over(best)).where((F.col("n") == 1) & (F.col("iou") >= threshold))
    return top.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def object_metrics(truth: DataFrame, found: DataFrame, matches: DataFrame) -> DataFrame:
    """Counts, completeness, correctness and quality in one row."""
    counts = truth.agg(F.count("*").alias("n_gt")).crossJoin(found.agg(F.count("*").alias("n_pred"))).crossJoin(matches.agg(F.count("*").alias("tp")))
    n_gt, n_pred, tp = (F.col(c).cast("double") for c in ("n_gt", "n_pred", "tp"))
    return counts.select("n_gt", "n_pred", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"), ratio(tp, n_gt).alias("completeness"), ratio(tp, n_pred).alias("correctness"), ratio(tp, n_gt + n_pred - tp).alias("quality"))


def area_metrics(tp: Column, fp: Column, fn: Column, total: Column) -> dict[str, Column]:
    """Precision, recall, F1, IoU, accuracy and mean IoU of areas; 0 where a denominator is 0."""
    tn = total - tp - fp - fn
    iou, background = ratio(tp, tp + fp + fn), ratio(tn, tn + fn + fp)
    return {"tn": tn, "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "iou": iou, "accuracy": ratio(tp + tn, total), "miou": (iou + background) / 2}


def precision_curve(matches: DataFrame, n_gt: int, threshold: float) -> DataFrame:
    """(gt_idx, iou, tp, fp, precision, recall) along the accepted matches by falling IoU: hits so far, and misses."""
    marked = matches.select("gt_idx", "iou", (-F.col("iou")).alias("_down"), (F.col("iou") >= threshold).cast("long").alias("_hit"), F.lit(1).cast("long").alias("_one"))
    counted = running(running(marked, ["_down", "gt_idx"], "_hit", "_hits"), ["_down", "gt_idx"], "_one", "_rows")
    tp, n = F.col("_hits") + F.col("_hit"), F.col("_rows") + 1
    return counted.select("gt_idx", "iou", tp.alias("tp"), (n - tp).alias("fp"), (tp / (n + 1e-9)).alias("precision"), (tp / n_gt if n_gt else F.lit(0.0)).alias("recall"))


def average_precision(matches: DataFrame, n_gt: int, thresholds: list[float]) -> DataFrame:
    """(threshold, ap): mean over 101 recalls of the best precision at that recall or more, for accepted matches in
    order of falling IoU. Predictions without a match are not in the list, so they never count against it.

    In that order all matches that reach a threshold come first. Up to the last of these, precision n / (n + 1e-9) and recall
    both rise, and then only precision changes, and falls: so the last hit is the best point for every recall up to its own, and
    a count for each threshold says all.
    """
    counts = matches.agg(*(F.count(F.when(F.col("iou") >= t, 1)).alias(f"t{k}") for k, t in enumerate(thresholds)))
    rows = F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{k}").alias("n")) for k, t in enumerate(thresholds))))
    hits = counts.select(rows.alias("r")).select("r.threshold", "r.n")
    steps = F.least(F.floor(F.col("n") / F.lit(max(n_gt, 1)) * 100 + 1e-9), F.lit(100)) + 1
    return hits.select("threshold", (F.when(F.col("n") > 0, steps * (F.col("n") / (F.col("n") + 1e-9))).otherwise(0.0) / 101).alias("ap"))


def stats_summary(df: DataFrame, value: str, distance: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean, median, population deviation, quartile range, variation, extremes and worst value; NaN and null are left out."""
    x = F.when(~F.isnan(value), F.col(value).cast("double"))
    out = df.groupBy(*keys).agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    quartiles = percentiles(df, value, [0.25, 0.5, 0.75], keys)
    safe = F.when(F.col("mean") != 0, F.col("mean"))
    both = out.join(quartiles, list(keys), "left") if keys else out.crossJoin(F.broadcast(quartiles.select(F.collect_list("q")[0].alias("q"))))  # one row each
    return both.select(*keys, "mean", F.col("q")[1].alias("median"), "std", (F.col("q")[2] - F.col("q")[0]).alias("iqr"), (F.col("std") / safe).alias("cv"), "min", "max", F.col("max" if distance else "min").alias("worst"))


def area_errors(matches: DataFrame) -> DataFrame:
    """Mean, median, spread and mean relative size of the matches' errors of area."""
    e = F.abs(F.col("pred_area") - F.col("gt_area"))
    out = matches.agg(F.avg(e).alias("mean_abs"), F.avg(e / (F.col("gt_area") + 1e-9)).alias("mean_rel"), F.stddev_pop(F.col("pred_area") - F.col("gt_area")).alias("std"))
    middle = percentiles(matches.select(e.alias("e")), "e", [0.5]).agg(F.max(F.col("q")[0]).alias("median_abs"))
    return out.crossJoin(F.broadcast(middle)).select("mean_abs", "median_abs", "mean_rel", "std")  # one row each


def false_objects(truth: DataFrame, found: DataFrame, matches: DataFrame) -> DataFrame:
    """(kind, id): what was found without a match (fp), and truths without one (fn)."""
    fp = found.select("id").join(matches.select(F.col("pred_idx").alias("id")), "id", "left_anti")
    fn = truth.select("id").join(matches.select(F.col("gt_idx").alias("id")), "id", "left_anti")
    return fp.select(F.lit("fp").alias("kind"), "id").unionByName(fn.select(F.lit("fn").alias("kind"), "id"))
