"""Convex polygons by the thousand: numpy arrays (rows, corners, 2) in place of a loop over polygons.

Corners run counter-clockwise. Rows with fewer corners than others repeat one: edges without length change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows that are worked on at once.
ROWS = 1000


def _levels(column: pa.Array) -> list[pa.Array]:
    """A nested list column's levels, from the outermost to the points."""
    out = [column]
    while pa.types.is_list(out[-1].type.value_type):
        out.append(out[-1].values)
    return out


def single_rings(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, corners) of a column of shapes, or of rings: those rows that are one ring of finite corners with an area, by
    their number of corners; turned counter-clockwise and open. Other rows are left out."""
    levels = _levels(column)
    if not len(column) or any(x.null_count for x in levels[1:]) or levels[-1].values.null_count:
        return
    offsets = [x.offsets.to_numpy() for x in levels]
    if not (np.diff(offsets[-1]) == 2).all():
        return
    flat = levels[-1].values.to_numpy()[offsets[-1][0] if len(offsets[-1]) else 0 :].reshape(-1, 2)
    rows = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    at = rows
    for o in offsets[:-2]:  # one polygon, one ring
        one = o[at + 1] - o[at] == 1
        rows, at = rows[one], o[at[one]]
    start, stop = offsets[-2][at], offsets[-2][at + 1]
    rows, start, stop = (x[stop - start >= 3] for x in (rows, start, stop))
    stop = stop - (flat[start] == flat[stop - 1]).all(axis=1)
    for k in np.unique(stop - start).tolist():
        own = stop - start == k
        if k < 3:
            continue
        corners = flat[start[own][:, None] + np.arange(k)]
        size = area(corners)
        sound = np.isfinite(corners).all(axis=(1, 2)) & (size != 0)
        corners[size < 0] = corners[size < 0, ::-1]
        yield rows[own][sound], corners[sound]


def convex_rings(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those of ``single_rings`` that are convex, some rows at a time."""
    for rows, corners in single_rings(column):
        held = is_convex(corners)
        rows, corners = rows[held], corners[held]
        for i in range(0, len(rows), ROWS):
            yield rows[i : i + ROWS], corners[i : i + ROWS]


def convex_pairs(first: pa.Array, second: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, corners, corners) of rows where both columns are convex."""
    others = list(convex_rings(second))
    for rows, p in convex_rings(first):
        for more, q in others:
            both, i, j = np.intersect1d(rows, more, assume_unique=True, return_indices=True)
            if len(both):
                yield both, p[i], q[j]


def area(p: np.ndarray) -> np.ndarray:
    near = p - p[:, :1]
    after = np.roll(near, -1, axis=1)
    return (near[..., 0] * after[..., 1] - after[..., 0] * near[..., 1]).sum(axis=1) / 2


def centroid(p: np.ndarray) -> np.ndarray:
    near = p - p[:, :1]
    after = np.roll(near, -1, axis=1)
    cross = near[..., 0] * after[..., 1] - after[..., 0] * near[..., 1]
    return p[:, 0] + ((near + after) * cross[..., None]).sum(axis=1) / (3 * cross.sum(axis=1))[:, None]


def is_convex(p: np.ndarray) -> np.ndarray:
    """Rows whose edges all have a length and turn left, or go straight on, once around in all."""
    d = np.roll(p, -1, axis=1) - p
    e = np.roll(d, -1, axis=1)
    cross, dot = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0], (d * e).sum(axis=2)
    turn = np.arctan2(cross, dot)
    return (d != 0).any(axis=2).all(axis=1) & (turn >= 0).all(axis=1) & (turn < np.pi - 1e-9).all(axis=1) & (np.abs(turn.sum(axis=1) - 2 * np.pi) < 1e-6)


def cut(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What lies to the left of each row's line from a to b; a row of one repeated corner where nothing does."""
    n, k = p.shape[:2]
    d = (b - a)[:, None]
    side = d[..., 0] * (p[..., 1] - a[:, None, 1]) - d[..., 1] * (p[..., 0] - a[:, None, 0])
    inside = side >= 0
    if inside.all():
        return p
    q, after, beyond = np.roll(p, -1, axis=1), np.roll(side, -1, axis=1), np.roll(inside, -1, axis=1)
    crosses = inside != beyond
    share = np.where(crosses, side, 0) / np.where(crosses, side - after, 1)
    both = np.stack([p, p + share[..., None] * (q - p)], axis=2).reshape(n, 2 * k, 2)
    kept = np.stack([inside, crosses], axis=2).reshape(n, 2 * k)
    place, count = np.cumsum(kept, axis=1) - 1, kept.sum(axis=1)
    out = np.zeros((n, max(int(count.max()), 1), 2))
    i, j = np.nonzero(kept)
    out[i, place[i, j]] = both[i, j]
    return np.where((np.arange(out.shape[1]) < count[:, None])[..., None], out, out[:, :1])


def clip(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What rows of both have in common."""
    for k in range(q.shape[1]):
        p = cut(p, q[:, k], q[:, (k + 1) % q.shape[1]])
    return p


def shared(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The area in common, 0 where only rounding makes one; the polygon of more corners is cut by the other's edges."""
    both = area(clip(p, q) if p.shape[1] >= q.shape[1] else clip(q, p))
    least = lambda x: 1e-12 * np.abs(x).max(axis=(1, 2)) * np.ptp(x, axis=1).max(axis=1)
    # A polygon without area has no edges to cut by, and would leave all of the other one.
    return np.where((area(p) > least(p)) & (area(q) > least(q)) & (both > least(p)), both, 0.0)


def _normals(p: np.ndarray) -> np.ndarray:
    d = np.roll(p, -1, axis=1) - p
    return np.stack([d[..., 1], -d[..., 0]], axis=2) / np.hypot(d[..., 0], d[..., 1])[..., None]


def grown(p: np.ndarray, by: float, steps: int | None = None, quarter: int = 16) -> np.ndarray:
    """Rows grown by a distance: corners are arcs of so many steps, or of so many a quarter circle."""
    n = _normals(p)
    m = np.roll(n, 1, axis=1)
    turn = np.arctan2(m[..., 0] * n[..., 1] - m[..., 1] * n[..., 0], (m * n).sum(axis=2))
    pieces = np.full(turn.shape, steps) if steps else np.maximum(1, np.ceil(turn / (np.pi / 2) * quarter - 1e-9))
    share = np.minimum(np.arange(int(pieces.max()) + 1), pieces[..., None]) / pieces[..., None]
    t = np.arctan2(m[..., 1], m[..., 0])[..., None] + turn[..., None] * share
    return (p[:, :, None] + by * np.stack([np.cos(t), np.sin(t)], axis=3)).reshape(len(p), -1, 2)


def shrunk(p: np.ndarray, by: float) -> np.ndarray:
    """Rows cut by each of their edges moved inwards."""
    n, out = _normals(p), p
    for k in range(p.shape[1]):
        a = p[:, k] - by * n[:, k]
        out = cut(out, a, a + np.stack([-n[:, k, 1], n[:, k, 0]], axis=1))
    return out


def band_scores(outer: np.ndarray, inner: np.ndarray, other_outer: np.ndarray, other_inner: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
    """(IoU of both bands; precision, recall and F1 of the first band against the whole other polygon). Bands are outer less
    inner parts, so what they share follows from what convex parts share."""
    both = shared(outer, other_outer) - shared(outer, other_inner) - shared(inner, other_outer) + shared(inner, other_inner)
    band, second = area(outer) - area(inner), area(other_outer) - area(other_inner)
    tp = shared(outer, other) - shared(inner, other)
    share = lambda x, y: np.where(y > 0, x / np.where(y > 0, y, 1), 0.0)
    precision, recall = share(tp, area(other)), share(tp, band)
    return share(both, band + second - both), precision, recall, share(2 * precision * recall, precision + recall)


def hausdorff(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Greatest distance of a corner of either from the nearest point of the other's outline."""

    def one_way(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d = (np.roll(y, -1, axis=1) - y)[:, None]
        v = x[:, :, None] - y[:, None]
        t = np.clip((v * d).sum(axis=3) / (d * d).sum(axis=3), 0, 1)
        return np.hypot(*np.moveaxis(v - t[..., None] * d, 3, 0)).min(axis=2).max(axis=1)

    return np.maximum(one_way(p, q), one_way(q, p))


def to_shapes(p: np.ndarray) -> pa.Array:
    """Rows as shapes with closed rings; what has no area is the empty shape."""
    held = (p != np.roll(p, -1, axis=1)).any(axis=2)
    held &= (area(p) > 1e-12 * np.abs(p).max(axis=(1, 2), initial=0) * np.ptp(p, axis=1).max(axis=1, initial=0))[:, None]
    count = held.sum(axis=1)
    full = count > 2
    held &= full[:, None]
    first = p[np.arange(len(p)), held.argmax(axis=1)]
    points = np.concatenate([p, first[:, None]], axis=1)[np.concatenate([held, full[:, None]], axis=1)]
    lists = lambda stops, values: pa.ListArray.from_arrays(pa.array(np.asarray(stops, np.int32)), values)
    corners = lists(np.arange(len(points) + 1) * 2, pa.array(points.ravel()))
    rings = lists(np.append(0, np.cumsum((count + 1)[full])), corners)
    return lists(np.append(0, np.cumsum(full)), lists(np.arange(full.sum() + 1), rings))


def parts(p: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of each part, parts): rows halved along the longer side of their box as long as it is longer than ``most``."""
    row = np.arange(len(p))
    while True:
        low, high = p.min(axis=1), p.max(axis=1)
        long = (high - low).max(axis=1) > most
        if not long.any():
            return row, p
        across = np.where((high - low)[:, 0] >= (high - low)[:, 1], 0, 1)
        middle = (low + high) / 2
        up = np.where(across[:, None] == 0, [0.0, 1.0], [-1.0, 0.0])  # the half before the middle lies to the left
        halves = [cut(p[long], middle[long], (middle + up)[long]), cut(p[long], middle[long], (middle - up)[long])]
        width = max(p.shape[1], *(h.shape[1] for h in halves))
        wide = lambda x: np.concatenate([x, np.repeat(x[:, :1], width - x.shape[1], axis=1)], axis=1)  # noqa: B023, E731
        order = np.argsort(np.concatenate([np.flatnonzero(~long), *[np.flatnonzero(long)] * 2]), kind="stable")
        row = np.concatenate([row[~long], *[row[long]] * 2])[order]
        p = np.concatenate([wide(p[~long]), *map(wide, halves)])[order]
        sound = area(p) > 0
        row, p = row[sound], p[sound]
