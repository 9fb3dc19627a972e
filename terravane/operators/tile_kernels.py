"""Kernels over tiles and rings, a batch of rows at a time; no row needs another, so nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import convex, kernels, polygons


def map_rows(df: DataFrame, columns: list[str], kernel: Callable[..., tuple], schema: str, keep: list[str], many: Callable[..., Iterator[tuple[np.ndarray, list]]] | None = None) -> DataFrame:
    """``keep`` and what ``kernel`` returns for the values of ``columns``; a null value gives nulls. ``many`` takes whole
    columns and gives (rows, arrays of what the kernel would return) for rows that it can take at once; the kernel has the
    others."""
    kinds = dict(df.dtypes)
    names = [x.strip().split()[0] for x in _top_level(schema)]
    types = [f.type for f in to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)]
    nothing = tuple(None for _ in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(at, out) for at, out in many(*(batch[c] for c in columns)) if len(at)] if many else []
            left = np.setdiff1d(np.arange(batch.num_rows), np.concatenate([at for at, _ in done])) if done else np.arange(batch.num_rows)
            rest = batch.take(pa.array(left)) if done else batch
            rows = [nothing if any(v is None for v in values) else kernel(*values) for values in zip(*(rest[c].to_pylist() for c in columns), strict=True)]
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            if done:
                order = pa.array(np.argsort(np.concatenate([*(at for at, _ in done), left])))
                made = [pa.concat_arrays([*(_as(out[k], t) for _, out in done), made[k]]).take(order) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *made], [*keep, *names])

    return df.select(*dict.fromkeys([*keep, *columns])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), schema]))


def _as(values, kind: pa.DataType) -> pa.Array:
    out = values if isinstance(values, pa.Array) else pa.array(values)
    return out if out.type == kind else out.cast(kind)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores: a few bytes a row make one task of many thousand rows, whose kernels take long."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def map_grids(tiles: DataFrame, px: str, width: int, kernel: Callable[[np.ndarray], tuple], schema: str, keep: list[str]) -> DataFrame:
    """``keep`` and what ``kernel`` returns for each tile's pixels as a grid of ``width`` columns: numbers, or grids and lists
    for array columns. Pixels are views on Arrow's buffers, no object is made for each; null pixels give nulls."""
    kinds = dict(tiles.dtypes)
    names = [x.strip().split()[0] for x in _top_level(schema)]
    types = [f.type for f in to_arrow_schema(tiles.sparkSession.createDataFrame([], schema).schema)]

    def column(values: list, kind: pa.DataType) -> pa.Array:
        if not pa.types.is_list(kind) or pa.types.is_nested(kind.value_type):
            return pa.array(values, kind)
        flat = [np.zeros(0) if v is None else np.ravel(v) for v in values]
        stops = np.cumsum([0, *map(len, flat)]).astype(np.int32)
        mask = pa.array([v is None for v in values]) if any(v is None for v in values) else None
        return pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(flat) if flat else np.zeros(0)).cast(kind.value_type), mask=mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pixels = batch[px]
            flat, stops = pixels.values.to_numpy(zero_copy_only=False), pixels.offsets.to_numpy()
            rows = [tuple(None for _ in names) if gone else kernel(flat[a:b].reshape(-1, width)) for a, b, gone in zip(stops[:-1], stops[1:], pixels.is_null().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *(column([r[k] for r in rows], t) for k, t in enumerate(types))], [*keep, *names])

    given = tiles.select(*(c for c in keep if c != px), F.col(px).cast("array<double>").alias(px))
    out_types = {**kinds, px: "array<double>"}
    return given.mapInArrow(run, ", ".join([*(f"`{c}` {out_types[c]}" for c in keep), schema]))


def _top_level(schema: str) -> list[str]:
    out, depth, now = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


def mask_objects(tiles: DataFrame, keep: list[str], px: str, width: int, limit: float, opening: int, closing: int, least: int) -> DataFrame:
    """Objects of a probability tile: thresholded, opened, closed, small groups dropped; their number, pixels, and for
    each object its rectangle of least area."""

    def kernel(grid: np.ndarray) -> tuple:
        mask = kernels.drop_small(kernels.open_close(grid >= limit, opening, closing), least)
        groups = kernels.label(mask)
        boxes = []
        for k in range(1, groups.max(initial=0) + 1):
            r, c = np.nonzero(groups == k)
            corners = np.concatenate([np.stack([c + dx, r + dy], axis=1) for dx in (0, 1) for dy in (0, 1)]).astype(float)
            boxes.append([[float(v) for v in p] for p in kernels.least_rectangle(corners)])
        return int(groups.max(initial=0)), int(mask.sum()), boxes

    return map_grids(tiles, px, width, kernel, "objects int, set_pixels int, rectangles array<array<array<double>>>", keep)


def vectorise(tiles: DataFrame, keep: list[str], px: str, width: int, limit: float, least: float = 0.0, tolerance: float = 0.0) -> DataFrame:
    """Adds ``shape``: the set pixels' outlines with holes, in pixels; polygons of less than ``least`` area go, and outlines
    are simplified within the tolerance."""

    def kernel(grid: np.ndarray) -> tuple:
        rings = [r[:, :2] for r in kernels.outlines(grid >= limit)]
        shape = polygons.nested(rings)
        shape = [p for p in shape if polygons.area([p]) >= least]
        if tolerance:
            thin = [[kernels.simplify(np.concatenate([r, r[:1]]), tolerance)[:-1] for r in p] for p in shape]
            shape = [[r for r in p if len(r) > 2] for p in thin if len(p[0]) > 2]
        return (polygons.to_lists(shape),)

    return map_grids(tiles, px, width, kernel, "shape array<array<array<array<double>>>>", keep)


def rasterise(shapes: DataFrame, keep: list[str], shape: str, height: int, width: int) -> DataFrame:
    """Adds ``mask``: 1 for pixels whose centres lie in the shape (in pixels), else 0."""
    y, x = np.mgrid[0:height, 0:width] + 0.5
    centres = np.column_stack([x.ravel(), y.ravel()])

    def kernel(coordinates) -> tuple:
        held = polygons.shape_of(coordinates)
        out = np.zeros(height * width, np.int32)
        for k in range(0, len(centres), 65536):
            out[k : k + 65536] = polygons.inside(held, centres[k : k + 65536])
        return (out.tolist(),)

    return map_rows(shapes, [shape], kernel, "mask array<int>", keep)


def blur(tiles: DataFrame, keep: list[str], px: str, width: int, passes: int = 1) -> DataFrame:
    """``px`` as the mean of each pixel's 3 by 3 neighbours, edges repeated; so many passes."""

    def kernel(grid: np.ndarray) -> tuple:
        for _ in range(passes):
            p = np.pad(grid, 1, mode="edge")
            grid = sum(p[r : r + grid.shape[0], c : c + grid.shape[1]] for r in range(3) for c in range(3)) / 9
        return (grid,)

    return map_grids(tiles, px, width, kernel, f"{px} array<double>", keep)


def sharpen(tiles: DataFrame, keep: list[str], px: str, width: int, factor: float) -> DataFrame:
    """``px`` with each pixel's distance from its 3 by 3 mean multiplied; 1 leaves it, 0 blurs it."""

    def kernel(grid: np.ndarray) -> tuple:
        p = np.pad(grid, 1, mode="edge")
        mean = sum(p[r : r + grid.shape[0], c : c + grid.shape[1]] for r in range(3) for c in range(3)) / 9
        return (mean + (grid - mean) * factor,)

    return map_grids(tiles, px, width, kernel, f"{px} array<double>", keep)


def slopes(tiles: DataFrame, keep: list[str], px: str, width: int) -> DataFrame:
    """``dx`` and ``dy``: central differences along both axes, one-sided at edges."""

    def along(grid: np.ndarray, axis: int) -> np.ndarray:
        if grid.shape[axis] < 2:
            return np.zeros(grid.shape)
        return np.gradient(grid, axis=axis)

    return map_grids(tiles, px, width, lambda g: (along(g, 1), along(g, 0)), "dx array<double>, dy array<double>", keep)


def normals(tiles: DataFrame, keep: list[str], px: str, width: int, spacing: float = 1.0, strength: float = 1.0) -> DataFrame:
    """``normal``: each pixel's unit normal as bytes, three a pixel, 127.5 being 0."""

    def kernel(grid: np.ndarray) -> tuple:
        dx, dy = (np.gradient(grid, spacing, axis=a) if grid.shape[a] > 1 else np.zeros(grid.shape) for a in (1, 0))
        n = np.stack([-strength * dx, -strength * dy, np.ones(grid.shape)], axis=-1)
        n /= np.sqrt((n**2).sum(axis=-1, keepdims=True))
        return (np.rint(127.5 * (n + 1)).astype(np.int32),)

    return map_grids(tiles, px, width, kernel, "normal array<int>", keep)


def level_sets(tiles: DataFrame, keep: list[str], px: str, width: int, level: float, nodata: float | None = None) -> DataFrame:
    """``above``: 1 where pixels reach a level, 0 below it and where there are no data."""
    return map_grids(tiles, px, width, lambda g: (((g >= level) & (g != (np.nan if nodata is None else nodata))).astype(np.int32),), "above array<int>", keep)


def shore_blur(tiles: DataFrame, keep: list[str], px: str, width: int, radius: int, profile: str = "sand") -> DataFrame:
    """``soft``: a mask (0 or 1) blurred to bytes over a shore: by a triangle (sand), or by a triangle twice, near a bell, and
    then steepened by a tangent (rocks)."""

    def kernel(grid: np.ndarray) -> tuple:
        out = kernels.hat_blur(grid > 0, radius)
        if profile == "rocks":
            out = np.tan(np.clip(kernels.hat_blur(out, radius), 0, 1) * np.pi / 4) ** 2.5
        return (np.clip(out * 255, 0, 255).astype(np.int32),)

    if profile not in ("sand", "rocks"):
        raise ValueError("profile must be sand or rocks")
    return map_grids(tiles, px, width, kernel, "soft array<int>", keep)


def warp(tiles: DataFrame, keep: list[str], px: str, width: int, rows: list[list[float]], cols: list[list[float]], size: tuple[int, int]) -> DataFrame:
    """``warped``: a tile drawn anew on ``size`` (height, width): between the nodes of an even mesh, whose places in the source
    ``rows`` and ``cols`` give, places are bilinear; pixels are bilinear as well."""
    mesh = [kernels.resample(np.array(m, float), *np.meshgrid(*(np.linspace(0, n - 1, s) for n, s in zip(np.shape(m), size, strict=True)), indexing="ij")) for m in (rows, cols)]
    return map_grids(tiles, px, width, lambda g: (kernels.resample(g, *mesh),), "warped array<double>", keep)


def resampled(tiles: DataFrame, keep: list[str], px: str, width: int, size: tuple[int, int], how: str = "bilinear") -> DataFrame:
    """``fine``: a tile at another size (height, width), its corners kept: by the nearest pixel, linearly or by cubic convolution."""
    if how not in ("nearest", "bilinear", "cubic"):
        raise ValueError("how must be nearest, bilinear or cubic")

    def kernel(grid: np.ndarray) -> tuple:
        rows, cols = np.meshgrid(*(np.linspace(0, n - 1, m) for n, m in zip(grid.shape, size, strict=True)), indexing="ij")
        if how == "nearest":
            return (grid[np.rint(rows).astype(int), np.rint(cols).astype(int)],)
        return ((kernels.resample if how == "bilinear" else kernels.resample_cubic)(grid, rows, cols),)

    return map_grids(tiles, px, width, kernel, "fine array<double>", keep)


def leveled(meshes: DataFrame, keep: list[str], rounds: int, sea: str = "zero") -> DataFrame:
    """``levels``: a tile's node altitudes (arrays z and drawn, triangles of node numbers from 0, kinds) after its triangles'
    kinds, in their order. A tile's mesh is one row, as each triangle works on what the one before has left."""
    run = lambda z, drawn, triangles, kinds: (kernels.level_triangles(np.array(z, float), np.array(drawn, float), np.array(triangles, int).reshape(-1, 3), kinds, rounds, sea).tolist(),)
    return map_rows(meshes, ["z", "drawn", "triangles", "kinds"], run, "levels array<double>", keep)


def decode_detections(rows: DataFrame, keep: list[str], raw: str, fields: int, size: tuple[int, int], least: float = 0.25, limit: float = 0.45) -> DataFrame:
    """Raw detections (a flat array, ``fields`` numbers each: centre x and y, width, height, score, mask factors) to rows
    kept after scores, clipping to (height, width) and suppression: arrays of boxes, scores and factors."""

    def kernel(grid: np.ndarray) -> tuple:
        grid = grid[grid[:, 4] >= least]
        boxes = np.column_stack([grid[:, 0] - grid[:, 2] / 2, grid[:, 1] - grid[:, 3] / 2, grid[:, 0] + grid[:, 2] / 2, grid[:, 1] + grid[:, 3] / 2])
        boxes = np.clip(boxes, 0, [size[1], size[0], size[1], size[0]])
        order = kernels.suppress(boxes, grid[:, 4], limit) if len(boxes) else np.zeros(0, int)
        return boxes[order].tolist(), grid[order, 4].tolist(), grid[order, 5:].tolist()

    return map_grids(rows, raw, fields, kernel, "boxes array<array<double>>, scores array<double>, factors array<array<double>>", keep)


def detection_masks(boxes: list[list[float]], factors: list[list[float]], prototypes: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Probabilities of all detections of an image put together by their greatest: factors times prototypes, a sigmoid, each
    cut to its box, at the prototypes' resolution brought to ``size``."""
    out = np.zeros(size)
    for (x0, y0, x1, y1), f in zip(boxes, factors, strict=True):
        small = 1 / (1 + np.exp(-np.tensordot(np.array(f), prototypes, axes=1)))
        rows, cols = (np.linspace(0, n - 1, m) for n, m in zip(small.shape, size, strict=True))
        full = kernels.resample(small, rows[:, None] + 0 * cols, cols[None] + 0 * rows[:, None])
        inside = np.zeros(size, bool)
        inside[int(y0) : int(np.ceil(y1)), int(x0) : int(np.ceil(x1))] = True
        out = np.maximum(out, np.where(inside, full, 0))
    return out


def smooth_ways(ways: DataFrame, keep: list[str], values: str, kernel_: list[float], degree: int | None = None) -> DataFrame:
    """``smooth``: an array of values along a closed way convolved with a kernel, or, with a degree, its least-squares
    polynomial along the way."""
    weights = np.array(kernel_, float)

    def kernel(v: list[float]) -> tuple:
        x = np.array(v, float)
        return ((kernels.fit_altitudes(np.arange(len(x), dtype=float), x, degree) if degree is not None and len(x) > 1 else x if degree is not None else kernels.smooth_ring(x, weights)).tolist(),)

    return map_rows(ways, [values], kernel, "smooth array<double>", keep)


def ring_measures(rings: DataFrame, keep: list[str], ring: str, other: str) -> DataFrame:
    """Area, centroid, and against another ring their Hausdorff distance, centroid distance and the area in common
    (for convex rings)."""

    def kernel(a: list[list[float]], b: list[list[float]]) -> tuple:
        p, q = np.array(a, float), np.array(b, float)
        (x, y), (u, v) = kernels.centroid(p), kernels.centroid(q)
        q_ccw = q if kernels.signed_area(q) > 0 else q[::-1]
        common = kernels.clip_convex(p, q_ccw)
        return abs(kernels.signed_area(p)), x, y, kernels.hausdorff(p, q), float(np.hypot(x - u, y - v)), abs(kernels.signed_area(common)) if len(common) > 2 else 0.0

    return map_rows(rings, [ring, other], kernel, "area double, cx double, cy double, hausdorff double, centroid_distance double, common_area double", keep)


def boundary_scores(rings: DataFrame, keep: list[str], truth: str, found: str, width: float) -> DataFrame:
    """Boundary IoU, precision, recall and F1 of convex rings: bands of ``width`` around their edges, the second pair of
    figures comparing the truth's band with the whole found ring."""

    def area(p: np.ndarray) -> float:
        return abs(kernels.signed_area(p)) if len(p) > 2 else 0.0

    def kernel(a: list[list[float]], b: list[list[float]]) -> tuple:
        p, q = (r if kernels.signed_area(r) > 0 else r[::-1] for r in (np.array(a, float), np.array(b, float)))
        outer, inner = zip(*((kernels.grow_convex(r, width / 2), kernels.grow_convex(r, -width / 2)) for r in (p, q)), strict=True)
        meet = lambda r, s: area(kernels.clip_convex(r, s)) if len(r) > 2 and len(s) > 2 else 0.0
        # Bands are outer less inner parts, so what bands share follows from what convex parts share.
        both = meet(outer[0], outer[1]) - meet(outer[0], inner[1]) - meet(inner[0], outer[1]) + meet(inner[0], inner[1])
        bands = [area(o) - area(i) for o, i in zip(outer, inner, strict=True)]
        union = sum(bands) - both
        tp = meet(outer[0], q) - meet(inner[0], q)
        fp, fn = area(q) - tp, bands[0] - tp
        precision, recall = tp / (tp + fp) if tp + fp > 0 else 0.0, tp / (tp + fn) if tp + fn > 0 else 0.0
        return both / union if union > 0 else 0.0, precision, recall, 2 * precision * recall / (precision + recall) if precision + recall > 0 else 0.0

    def many(first: pa.Array, second: pa.Array) -> Iterator[tuple[np.ndarray, list]]:
        for rows, p, q in convex.convex_pairs(first, second):
            scores = convex.band_scores(*(f(r) for r in (p, q) for f in (lambda r: convex.grown(r, width / 2, steps=8), lambda r: convex.shrunk(r, width / 2))), q)
            yield rows, list(scores)

    return map_rows(dealt(rings), [truth, found], kernel, "boundary_iou double, boundary_precision double, boundary_recall double, boundary_f1 double", keep, many)


def keep_best_boxes(detections: DataFrame, keep: list[str], boxes: str, scores: str, limit: float = 0.45) -> DataFrame:
    """Indices of the detections that non-maximum suppression keeps."""
    return map_rows(detections, [boxes, scores], lambda b, s: (kernels.suppress(np.array(b, float).reshape(-1, 4), np.array(s, float), limit).tolist(),), "kept array<int>", keep)


def refine(tiles: DataFrame, keep: list[str], px: str, width: int, nodata: float, factor: int = 3) -> DataFrame:
    """A height tile with voids filled, brought to ``factor`` times its resolution, and its distance to the nearest
    pixel above the mean."""

    def kernel(grid: np.ndarray) -> tuple:
        grid = kernels.fill_nodata(grid, nodata)
        return kernels.upsample(grid, factor), kernels.distance(grid > grid.mean())

    return map_grids(tiles, px, width, kernel, "fine array<double>, away array<double>", keep)
