"""Geometry and raster kernels on numpy arrays, for what column expressions cannot say. Each works on one tile or ring."""

from __future__ import annotations

import math

import numpy as np

# --- rings: arrays of (x, y) rows, not closed -------------------------------------------------------------------------


def signed_area(ring: np.ndarray) -> float:
    """Positive for counter-clockwise rings."""
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def centroid(ring: np.ndarray) -> tuple[float, float]:
    """Centre of mass; the mean of the corners where the area is 0."""
    x, y = ring[:, 0], ring[:, 1]
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    if abs(cross.sum()) < 1e-300:
        return float(x.mean()), float(y.mean())
    return float(((x + np.roll(x, -1)) * cross).sum() / (3 * cross.sum())), float(((y + np.roll(y, -1)) * cross).sum() / (3 * cross.sum()))


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Counter-clockwise hull without points on its edges."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def half(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1]))


def least_rectangle(points: np.ndarray) -> np.ndarray:
    """Corners of the rectangle of least area around points; one side lies along an edge of the hull."""
    hull = convex_hull(points)
    if len(hull) < 3:
        return np.array([hull[0], hull[-1], hull[-1], hull[0]])
    edges = np.roll(hull, -1, axis=0) - hull
    best = None
    for angle in np.unique(np.arctan2(edges[:, 1], edges[:, 0]) % (np.pi / 2)):
        turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
        q = hull @ turn
        low, high = q.min(axis=0), q.max(axis=0)
        size = float(np.prod(high - low))
        if best is None or size < best[0] - 1e-12:
            best = size, np.array([low, [high[0], low[1]], high, [low[0], high[1]]]) @ turn.T
    return best[1]


def simplify(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas and Peucker: points further than the tolerance from the line between kept ones stay."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    stack = [(0, len(line) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        away = segment_distance(line[a + 1 : b], line[a], line[b])
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return line[keep]


def segment_distance(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of points from the segment a b."""
    d = b - a
    length = float(d @ d)
    t = np.clip(((points - a) @ d) / length, 0, 1) if length else np.zeros(len(points))
    return np.hypot(*(points - (a + t[:, None] * d)).T)


def hausdorff(a: np.ndarray, b: np.ndarray) -> float:
    """Greatest distance of a corner of either ring from the nearest point of the other's edges."""

    def one_way(p: np.ndarray, q: np.ndarray) -> float:
        return float(np.minimum.reduce([segment_distance(p, u, v) for u, v in zip(q, np.roll(q, -1, axis=0), strict=True)]).max())

    return max(one_way(a, b), one_way(b, a)) if len(a) and len(b) else math.nan


def contains(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Whether points lie inside, by crossings to the right; points on left and lower edges count as inside."""
    x, y = points[:, 0, None], points[:, 1, None]
    x1, y1 = ring[:, 0], ring[:, 1]
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    spans = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return ((spans & (x < at)).sum(axis=1) % 2).astype(bool)


def clip_convex(ring: np.ndarray, clip: np.ndarray) -> np.ndarray:
    """The part of a ring inside a convex counter-clockwise ring (Sutherland and Hodgman); exact for convex rings."""
    out = [tuple(p) for p in ring]
    for a, b in zip(clip, np.roll(clip, -1, axis=0), strict=True):
        inside = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) >= 0  # noqa: B023, E731
        rest, out = out, []
        for p, q in zip(rest, rest[1:] + rest[:1], strict=True):
            if inside(p) != inside(q):
                d = (b[0] - a[0]) * (q[1] - p[1]) - (b[1] - a[1]) * (q[0] - p[0])
                t = ((b[0] - a[0]) * (a[1] - p[1]) - (b[1] - a[1]) * (a[0] - p[0])) / d
                cross = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
                out += [p, cross] if inside(p) else [cross]
            elif inside(p):
                out.append(p)
        if not out:
            break
    return np.array(out).reshape(-1, 2)


def grow_convex(ring: np.ndarray, by: float, corner_steps: int = 8) -> np.ndarray:
    """A convex ring grown by a distance, its corners rounded by so many steps; a negative distance shrinks it."""
    if signed_area(ring) < 0:
        ring = ring[::-1]
    edges = np.roll(ring, -1, axis=0) - ring
    normal = np.stack([edges[:, 1], -edges[:, 0]], axis=1) / np.hypot(*edges.T)[:, None]
    if by >= 0:
        arcs = []
        for p, before, after in zip(ring, np.roll(normal, 1, axis=0), normal, strict=True):
            a = math.atan2(before[1], before[0])
            turn = (math.atan2(after[1], after[0]) - a) % (2 * math.pi)
            t = a + turn * np.arange(corner_steps + 1) / corner_steps
            arcs.append(p + by * np.stack([np.cos(t), np.sin(t)], axis=1))
        return np.concatenate(arcs)
    out = ring
    for p, n in zip(ring, normal, strict=True):  # cut by each edge moved inwards
        far = 4 * (np.abs(ring).max() + 1)
        along, base = np.array([-n[1], n[0]]), p + by * n
        out = clip_convex(out, np.array([base - far * along, base + far * along, base + far * along - far * n, base - far * along - far * n])) if len(out) else out
    return out


# --- masks and grids --------------------------------------------------------------------------------------------------


def rasterise(ring: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels whose centres lie in a ring, by scan lines."""
    mask = np.zeros((height, width), bool)
    x1, y1 = ring[:, 0], ring[:, 1]
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    for row in range(max(0, math.floor(y1.min() - 0.5)), min(height, math.ceil(y1.max() + 0.5))):
        y = row + 0.5
        hit = (y1 > y) != (y2 > y)
        at = np.sort((x2[hit] - x1[hit]) * (y - y1[hit]) / (y2[hit] - y1[hit]) + x1[hit])
        for a, b in zip(at[::2], at[1::2], strict=False):
            mask[row, max(0, math.ceil(a - 0.5)) : max(0, min(width, math.ceil(b - 0.5)))] = True
    return mask


def _shifted(a: np.ndarray, radius: int, fill: float, join) -> np.ndarray:
    for axis in (0, 1):
        padded = np.pad(a, [(radius, radius) if k == axis else (0, 0) for k in (0, 1)], constant_values=fill)
        a = join.reduce([padded[tuple(slice(s, s + a.shape[axis]) if k == axis else slice(None) for k in (0, 1))] for s in range(2 * radius + 1)])
    return a


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    return _shifted(mask.astype(bool), radius, False, np.logical_or)


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    return _shifted(mask.astype(bool), radius, True, np.logical_and)


def open_close(mask: np.ndarray, opening: int, closing: int) -> np.ndarray:
    """Opening and then closing by squares of side 2r + 1; radius 0 leaves the mask."""
    if opening:
        mask = dilate(erode(mask, opening), opening)
    return erode(dilate(mask, closing), closing) if closing else mask.astype(bool)


def label(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 of 8-connected groups of set pixels, in order of their first pixels; 0 elsewhere."""
    mask = mask.astype(bool)
    n = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    big = mask.size + 1
    while True:
        low = np.where(mask, n, big)
        near = _shifted(low, 1, big, np.minimum)
        new = np.where(mask, near, 0)
        flat = np.concatenate([[0], new.ravel()])
        new = np.where(mask, flat[new], 0)  # and on to what that pixel has found
        if (new == n).all():
            break
        n = new
    return np.searchsorted(np.unique(n[mask]), n) * mask + mask if mask.any() else n


def drop_small(mask: np.ndarray, least: int) -> np.ndarray:
    """Without groups of fewer pixels."""
    groups = label(mask)
    return (np.bincount(groups.ravel(), minlength=1) >= least)[groups] & mask.astype(bool)


def outlines(mask: np.ndarray) -> list[np.ndarray]:
    """Rings along pixel edges around set pixels: outer rings counter-clockwise (y down: set pixels to the right), holes
    the other way round; corners only."""
    m = np.pad(mask.astype(bool), 1)
    onward: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r, c in zip(*np.nonzero(m), strict=True):
        for (dr, dc), a, b in (((-1, 0), (0, 0), (1, 0)), ((0, 1), (1, 0), (1, 1)), ((1, 0), (1, 1), (0, 1)), ((0, -1), (0, 1), (0, 0))):
            if not m[r + dr, c + dc]:
                onward.setdefault((c - 1 + a[0], r - 1 + a[1]), []).append((c - 1 + b[0], r - 1 + b[1]))
    rings = []
    while onward:
        start = min(onward)
        ring, at, before = [], start, None
        while True:
            options = onward[at]
            # Where two rings touch at a corner the sharper right turn keeps to the same pixel.
            pick = options[0] if len(options) == 1 or before is None else max(options, key=lambda q: (at[0] - before[0]) * (q[1] - at[1]) - (at[1] - before[1]) * (q[0] - at[0]))
            options.remove(pick)
            if not options:
                del onward[at]
            ring.append(at)
            before, at = at, pick
            if at == start:
                break
        p = np.array(ring, float)
        turn = np.cross(np.pad(p - np.roll(p, 1, axis=0), ((0, 0), (0, 1))), np.pad(np.roll(p, -1, axis=0) - p, ((0, 0), (0, 1))))[:, 2] != 0
        rings.append(p[turn])
    return rings


def distance(mask: np.ndarray) -> np.ndarray:
    """Distance of each pixel to the nearest set one, exactly: columns first, then rows by all offsets."""
    height, width = mask.shape
    far = float(height + width)
    d = np.where(mask, 0.0, far)
    for r in range(1, height):
        d[r] = np.minimum(d[r], d[r - 1] + 1)
    for r in range(height - 2, -1, -1):
        d[r] = np.minimum(d[r], d[r + 1] + 1)
    offset = (np.arange(width)[:, None] - np.arange(width)[None, :]) ** 2
    return np.sqrt(np.stack([(row**2 + offset).min(axis=1) for row in d]))


def band_distance(mask: np.ndarray, band: float) -> np.ndarray:
    """Signed distance to the mask's edge in bytes: 0 at ``band`` outside, 255 at ``band`` inside."""
    signed = distance(~mask.astype(bool)) - distance(mask.astype(bool))
    return np.clip(127.5 * (1 + signed / band), 0, 255).astype(np.uint8)


def hat_blur(grid: np.ndarray, radius: int) -> np.ndarray:
    """Convolution with a triangle of the radius along both axes, edges repeated."""
    kernel = np.append(np.arange(1, radius + 1), np.arange(radius + 1, 0, -1)).astype(float)
    kernel /= kernel.sum()
    for axis in (0, 1):
        padded = np.pad(grid.astype(float), [(radius, radius) if k == axis else (0, 0) for k in (0, 1)], mode="edge")
        grid = np.apply_along_axis(lambda v: np.convolve(v, kernel, "valid"), axis, padded)
    return grid


def fill_nodata(grid: np.ndarray, nodata: float, steps: int = 20, most: int = 10_000) -> np.ndarray:
    """Voids take the greatest of their four neighbours, step by step; grids with ``most`` voids or more are left."""
    grid = grid.astype(float).copy()
    if (grid == nodata).sum() >= most:
        return grid
    for _ in range(steps):
        void = grid == nodata
        if not void.any():
            break
        p = np.pad(np.where(void, -np.inf, grid), 1, constant_values=-np.inf)
        near = np.maximum.reduce([p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]])
        grid = np.where(void & np.isfinite(near), near, grid)
    return grid


def _between(a: np.ndarray, b: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Linear values; at either end that end's own, whatever the other one is."""
    with np.errstate(invalid="ignore"):
        return np.where(share == 0, a, np.where(share == 1, b, a * (1 - share) + b * share))


def resample(grid: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional rows and columns, cut off at the edges. A place that rounding has left beside a pixel is
    that pixel's."""
    on = lambda v: np.where(np.abs(v - np.rint(v)) < 1e-9, np.rint(v), v)
    r, c = np.clip(on(rows), 0, grid.shape[0] - 1), np.clip(on(cols), 0, grid.shape[1] - 1)
    r0, c0 = np.minimum(r.astype(int), max(grid.shape[0] - 2, 0)), np.minimum(c.astype(int), max(grid.shape[1] - 2, 0))
    r1, c1 = np.minimum(r0 + 1, grid.shape[0] - 1), np.minimum(c0 + 1, grid.shape[1] - 1)
    return _between(_between(grid[r0, c0], grid[r0, c1], c - c0), _between(grid[r1, c0], grid[r1, c1], c - c0), r - r0)


def resample_cubic(grid: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values by cubic convolution (a = -1/2) at fractional rows and columns, edges repeated."""
    def weights(t: np.ndarray) -> np.ndarray:
        d = np.abs(np.stack([t + 1, t, 1 - t, 2 - t]))
        return np.where(d <= 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0))

    r, c = np.clip(rows, 0, grid.shape[0] - 1), np.clip(cols, 0, grid.shape[1] - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    wr, wc = weights(r - r0), weights(c - c0)
    out = np.zeros(np.broadcast(r, c).shape)
    for i in range(4):
        for j in range(4):
            out += wr[i] * wc[j] * grid[np.clip(r0 + i - 1, 0, grid.shape[0] - 1), np.clip(c0 + j - 1, 0, grid.shape[1] - 1)]
    return out


def level_triangles(z: np.ndarray, drawn: np.ndarray, triangles: np.ndarray, kinds: list[str], rounds: int, sea: str = "zero") -> np.ndarray:
    """Altitudes after the triangles' kinds, in their order: inland water's corners take their mean, so many rounds; then the
    sea's are 0, take their mean or rise to 0; then those of drawn surfaces take the altitude that was drawn."""
    z = np.array(z, float)
    of = lambda k: [t for t, kind in zip(triangles.tolist(), kinds, strict=True) if kind == k]
    for _ in range(rounds):
        for t in of("water"):
            z[t] = z[t].mean()
    for t in of("sea"):
        z[t] = {"zero": 0.0, "mean": z[t].mean(), "clamp": np.maximum(z[t], 0.0)}[sea]
    for t in of("drawn"):
        z[t] = drawn[t]
    return z


def upsample(grid: np.ndarray, factor: int = 3) -> np.ndarray:
    """A grid of (n - 1) * factor + 1 nodes with linear values between."""
    rows, cols = (np.arange((n - 1) * factor + 1) / factor for n in grid.shape)
    return resample(grid.astype(float), rows[:, None] + 0 * cols, cols[None, :] + 0 * rows[:, None])


def suppress(boxes: np.ndarray, scores: np.ndarray, limit: float = 0.45) -> np.ndarray:
    """Indices of boxes (x1, y1, x2, y2) kept, best first: none overlaps a better kept one by an IoU above the limit."""
    order, kept = np.lexsort((np.arange(len(scores)), -scores)), []
    area = (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    while len(order):
        i, rest = order[0], order[1:]
        kept.append(i)
        w = np.minimum(boxes[i, 2], boxes[rest, 2]) - np.maximum(boxes[i, 0], boxes[rest, 0])
        h = np.minimum(boxes[i, 3], boxes[rest, 3]) - np.maximum(boxes[i, 1], boxes[rest, 1])
        inter = np.maximum(w, 0) * np.maximum(h, 0)
        order = rest[inter <= limit * (area[i] + area[rest] - inter)]
    return np.array(kept, int)


def smooth_ring(values: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Convolution along a closed way."""
    n, half = len(values), len(kernel) // 2
    padded = values[(np.arange(-half, n + len(kernel) - half - 1)) % n]
    return np.convolve(padded, kernel, "valid")


def fit_altitudes(at: np.ndarray, altitude: np.ndarray, degree: int = 7) -> np.ndarray:
    """Least-squares polynomial along a way, at its own places."""
    return np.polynomial.Polynomial.fit(at, altitude, min(degree, len(at) - 1))(at)
