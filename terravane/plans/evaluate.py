"""Evaluation of building footprints from files: read, reproject, clean, clip, match, measure and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy, polygons
from ..operators import evaluation, shapes
from ..operators._lineage import settle
from ..sources import vectors, writers

# Sections, labels and notes of the report, as its readers know them.
AREA_LABELS = (("iou", "IoU (Jaccard)", "Intersection over Union"), ("f1", "Dice / F1", "2*TP / (2*TP+FP+FN)"), ("precision", "Precision", "TP / (TP+FP)"), ("recall", "Recall", "TP / (TP+FN)"), ("accuracy", "Area-based Accuracy", "(TP+TN) / total area"), ("miou", "mIoU", "Mean of building-IoU and background-IoU"), ("tp", "TP area (m²)", ""), ("fp", "FP area (m²)", ""), ("fn", "FN area (m²)", ""), ("tn", "TN area (m²)", ""))
OBJECT_LABELS = (("n_gt", "GT buildings", ""), ("n_pred", "Predicted buildings", ""), ("tp", "TP (objects)", ""), ("fp", "FP (objects)", ""), ("fn", "FN (objects)", ""), ("completeness", "Completeness", "Object-level recall"), ("correctness", "Correctness", "Object-level precision"), ("quality", "Quality Rate", "TP / (TP+FP+FN)"))
STATISTICS = (("iou", "C1 - Per-building IoU", ""), ("boundary_iou", "C2 - Boundary IoU", ""), ("boundary_f1", "C3 - Boundary F1", ""), ("boundary_precision", "C4 - Boundary Precision", ""), ("boundary_recall", "C5 - Boundary Recall", ""), ("hausdorff_m", "C6 - Hausdorff Distance", "metres"), ("centroid_dist_m", "C7 - Centroid Distance", "metres"))
ERROR_LABELS = (("mean_abs", "Mean Absolute Area Error (m²)"), ("mean_rel", "Mean Relative Area Error"), ("median_abs", "Median Absolute Area Error (m²)"), ("std", "Std of Area Error (m²)"))
BOUNDARY_NOTE = "Explicit evaluation boundary; GT and predictions clipped"


@dataclass
class Evaluation:
    """What an evaluation finds: single-row figures as dictionaries, the matched pairs as a DataFrame."""

    study_area: float
    boundary: list
    areas: dict
    objects: dict
    ap50: float
    ap50_95: float
    statistics: dict[str, dict]
    errors: dict
    matches: DataFrame

    def rows(self) -> list[tuple[str, str, float | None, str]]:
        """(section, metric, value, notes) in the report's order."""
        out = [("A - Area-based", "Study Area (m²)", self.study_area, BOUNDARY_NOTE)]
        out += [("A - Area-based", label, self.areas[k], note) for k, label, note in AREA_LABELS]
        out += [("B - Object-level", label, self.objects[k], note) for k, label, note in OBJECT_LABELS]
        out += [("B - Object-level", "AP @ IoU=0.50", self.ap50, ""), ("B - Object-level", "AP @ IoU=0.50:0.95", self.ap50_95, "")]
        for key, section, unit in STATISTICS:
            out += [(section, name.capitalize() + (f" ({unit})" if unit else ""), self.statistics[key][name], "") for name in ("mean", "median", "std", "iqr", "cv", "min", "max", "worst")]
        return out + [("D - Area Error", label, self.errors[k], "") for k, label in ERROR_LABELS]

    def text(self, title: str = "BUILDING SEGMENTATION EVALUATION REPORT", facts: dict[str, object] | None = None) -> str:
        """The figures for readers, by sections; the time stands on top."""
        from datetime import datetime

        lines, now = ["=" * 70, f"  {title}", "=" * 70, f"  Generated : {datetime.now():%Y-%m-%d %H:%M:%S}"], None
        lines += [f"  {k:<10}: {v}" for k, v in (facts or {}).items()]
        for section, metric, value, _ in self.rows():
            if section != now:
                lines += ["", f"  {section}", "-" * 70]
                now = section
            lines.append(f"  {metric:<34}: {writers.plain_number(value)}")
        return "\n".join([*lines, "", "=" * 70, "  END OF REPORT", "=" * 70, ""])


def _moved(shape: str, source: int, target: int) -> Column:
    point = lambda p: F.array(*geodesy.reproject(p[0], p[1], source, target))
    return F.transform(shape, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, point)))


def reprojected(features: DataFrame, epsg: int) -> DataFrame:
    """Feature rows in another coordinate system; rows of unknown systems raise ValueError."""
    known = [r["epsg"] for r in features.select("epsg").distinct().collect()]  # a row for each coordinate system
    if None in known:
        raise ValueError("a layer has no coordinate system")
    moved = F.lit(None).cast(shapes.SHAPE)
    for code in known:
        moved = F.when(F.col("epsg") == code, _moved("shape", code, epsg)).otherwise(moved)
    return features.withColumns({"shape": moved, "epsg": F.lit(epsg)})


def compare(truth: DataFrame, found: DataFrame, footprint: list, *, iou_threshold: float = 0.5, boundary_width: float = 2.0, cell: float = 64.0) -> Evaluation:
    """All figures of two layers of polygons (id, shape) within a footprint. Objects are clipped to it, and what is split
    stays one object; ids tell the order in which truths claim what was found."""
    truth, found = (settle(shapes.clip(x.select("id", "shape"), footprint)) for x in (truth, found))
    total = polygons.area(polygons.shape_of(footprint))
    a = shapes.area_confusion(truth, found, 4 * cell)
    metrics = evaluation.area_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.lit(total))
    areas = a.select("tp", "fp", "fn", *(c.alias(n) for n, c in metrics.items())).first().asDict()
    pairs = shapes.overlaps(truth, found, cell)
    matches = settle(shapes.match_details(evaluation.match_objects(pairs, iou_threshold), boundary_width))
    objects = evaluation.object_metrics(truth, found, matches).first().asDict()
    n = objects["n_gt"]
    steps = [round(0.5 + 0.05 * k, 2) for k in range(10)]
    ap = {round(r["threshold"], 2): r["ap"] for r in evaluation.average_precision(matches, n, steps).collect()}
    statistics = {k: evaluation.stats_summary(matches, k, distance=unit == "metres").first().asDict() for k, _, unit in STATISTICS}
    return Evaluation(total, footprint, areas, objects, ap[0.5], sum(ap.values()) / len(ap), statistics, evaluation.area_errors(matches).first().asDict(), matches)


def evaluate(spark: SparkSession, truth: str, found: str, boundary: str, epsg: int = 32637, *, output: str | None = None, iou_threshold: float = 0.5, boundary_width: float = 2.0) -> Evaluation:
    """The whole evaluation from files. With ``output`` (without suffix) it writes .csv (sectioned figures), .txt (a report),
    _per_building.csv and _boundary.geojson."""
    footprint = vectors.features(spark, boundary)
    known = footprint.agg(F.max("epsg")).first()[0]
    if known is not None:
        if not vectors.only(footprint, vectors.POLYGONAL).count() == footprint.count():
            raise ValueError("Evaluation boundary must be polygonal.")
        footprint = reprojected(footprint, epsg)
    region = shapes.check_boundary(footprint, known, metric=epsg not in (4326,))
    layers = [vectors.polygon_rows(reprojected(vectors.features(spark, p), epsg)) for p in (truth, found)]
    out = compare(*layers, region, iou_threshold=iou_threshold, boundary_width=boundary_width)
    if output:
        table = spark.createDataFrame([(s, m, None if v is None else float(v), n) for s, m, v, n in out.rows()], "Section string, Metric string, Value double, Notes string")
        writers.write_rows_csv(spark, table, f"{output}.csv")
        writers.write_rows_csv(spark, out.matches.orderBy("gt_idx"), f"{output}_per_building.csv")
        vectors.write_text(spark, f"{output}.txt", out.text(facts={"GT file": truth, "Pred file": found, "EPSG": epsg, "IoU thr.": iou_threshold, "Boundary": f"{boundary_width} m"}).encode())
        outline = spark.createDataFrame([(0, region)], f"id long, shape {shapes.SHAPE}")
        vectors.write_features(vectors.polygon_features(outline), f"{output}_boundary.geojson", epsg)
    return out
