"""Polygons with holes on numpy arrays: overlay, union, buffers, distances, validity.

A shape is a list of polygons, a polygon a list of rings (the shell, then its holes), a ring an array of (x, y) rows that is
not closed; any nesting of lists will do as input, as GeoJSON's MultiPolygon coordinates are. Overlay cuts the plane into
upright slabs at all corners and crossings. In a slab no two edges cross, so a walk from below to above counts how often
each shape winds around each strip. What is inside follows from these counts alone, whatever touches or overlaps.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

from .kernels import segment_distance, signed_area

Shape = list[list[np.ndarray]]
#: Points closer than this share of the largest coordinate are one point.
SNAP = 1e-12
#: Straight pieces of a quarter circle.
QUARTER = 16


def shape_of(coordinates) -> Shape:
    """Nested lists of coordinates to a shape: rings open, shells counter-clockwise, holes the other way round. Rings of less
    than three corners are left out, with their holes if they are shells."""
    out: Shape = []
    for polygon in coordinates or ():
        rings = []
        for k, ring in enumerate(polygon):
            r = np.asarray(ring, float).reshape(-1, np.shape(ring)[-1] if len(ring) else 2)[:, :2]
            if len(r) > 1 and (r[0] == r[-1]).all():
                r = r[:-1]
            if len(r) < 3:
                if k == 0:
                    break
                continue
            rings.append(r if (signed_area(r) >= 0) == (k == 0) else r[::-1])
        if rings:
            out.append(rings)
    return out


def to_lists(shape: Shape) -> list[list[list[list[float]]]]:
    """Closed rings as nested lists."""
    return [[[*r.tolist(), r[0].tolist()] for r in polygon] for polygon in shape]


def box(xmin: float, ymin: float, xmax: float, ymax: float) -> Shape:
    return [[np.array([[xmin, ymin], [xmax, ymin], [xmax, ymax], [xmin, ymax]], float)]]


def rings_of(shape: Shape) -> list[np.ndarray]:
    return [r for polygon in shape for r in polygon]


def area(shape: Shape) -> float:
    return float(sum(signed_area(r) for r in rings_of(shape)))


def bounds(shape: Shape) -> tuple[float, float, float, float]:
    points = np.concatenate(rings_of(shape))
    return (*points.min(axis=0).tolist(), *points.max(axis=0).tolist())


def centroid(shape: Shape) -> tuple[float, float]:
    """Centre of mass of all polygons."""
    total, x, y = 0.0, 0.0, 0.0
    for r in rings_of(shape):
        near = r - r[0]  # sums about a corner, so that far coordinates lose nothing
        after = np.roll(near, -1, axis=0)
        cross = near[:, 0] * after[:, 1] - after[:, 0] * near[:, 1]
        total += cross.sum() / 2
        x += ((near[:, 0] + after[:, 0]) * cross).sum() / 6 + r[0, 0] * cross.sum() / 2
        y += ((near[:, 1] + after[:, 1]) * cross).sum() / 6 + r[0, 1] * cross.sum() / 2
    return float(x / total), float(y / total)


def _edges(rings: list[np.ndarray], owner: int) -> np.ndarray:
    """(x1, y1, x2, y2, sign, owner) of edges from left to right; upright ones are not needed."""
    if not rings:
        return np.zeros((0, 6))
    a, b = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    right = a[:, 0] < b[:, 0]
    lo, hi = np.where(right[:, None], a, b), np.where(right[:, None], b, a)
    out = np.column_stack([lo, hi, np.where(right, 1.0, -1.0), np.full(len(a), float(owner))])
    return out[lo[:, 0] < hi[:, 0]]


def _crossings(e: np.ndarray) -> np.ndarray:
    """Where along x edges cross, from comparing each with all that follow, a block at a time."""
    found = []
    for i in range(0, len(e), 256):
        a, b = e[i : i + 256, None, :], e[None, i:, :]
        low, high = np.maximum(a[..., 0], b[..., 0]), np.minimum(a[..., 2], b[..., 2])
        near = (low < high) & (np.maximum(np.minimum(a[..., 1], a[..., 3]), np.minimum(b[..., 1], b[..., 3])) <= np.minimum(np.maximum(a[..., 1], a[..., 3]), np.maximum(b[..., 1], b[..., 3])))
        p, q = np.nonzero(near)
        p, q = e[i + p], e[i + q]
        s, t = (p[:, 3] - p[:, 1]) / (p[:, 2] - p[:, 0]), (q[:, 3] - q[:, 1]) / (q[:, 2] - q[:, 0])
        with np.errstate(divide="ignore", invalid="ignore"):
            x = (q[:, 1] - t * q[:, 0] - p[:, 1] + s * p[:, 0]) / (s - t)
        inside = (x > np.maximum(p[:, 0], q[:, 0])) & (x < np.minimum(p[:, 2], q[:, 2]))
        found.append(x[inside])
    return np.concatenate(found) if found else np.zeros(0)


class Overlay:
    """Slabs of one or two sets of rings, from which areas and shapes of any combination follow."""

    def __init__(self, first: list[np.ndarray], second: list[np.ndarray] | None = None):
        largest = max((float(np.abs(r).max()) for r in [*first, *(second or [])]), default=1.0)
        # A power of two, so that snapping moves no number that has few digits.
        self.grid = 2.0 ** math.floor(math.log2(max(largest, 1e-280) * SNAP))
        snapped = lambda rings: [np.rint(r / self.grid) * self.grid for r in rings]
        e = np.concatenate([_edges(snapped(first), 0), _edges(snapped(second or []), 1)])
        xs = np.unique(np.rint(np.concatenate([e[:, 0], e[:, 2], _crossings(e)]) / self.grid)) * self.grid if len(e) else np.zeros(0)
        self.slabs: list[tuple[float, float, np.ndarray, np.ndarray, np.ndarray]] = []
        e = e[np.argsort(e[:, 0], kind="stable")]
        slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
        for xa, xb in zip(xs[:-1], xs[1:], strict=False):
            k = np.searchsorted(e[:, 0], (xa + xb) / 2)
            on = np.flatnonzero(e[:k, 2] > (xa + xb) / 2)
            if not len(on):
                continue
            ya, yb = (np.clip(e[on, 1] + slope[on] * (x - e[on, 0]), np.minimum(e[on, 1], e[on, 3]), np.maximum(e[on, 1], e[on, 3])) for x in (xa, xb))
            order = np.lexsort((yb, ya + yb))
            winding = np.cumsum(np.where(e[on[order], 5][:, None] == [0, 1], e[on[order], 4][:, None], 0), axis=0)
            # Crossings lie on the grid only nearly: heights are kept in order all the same.
            self.slabs.append((float(xa), float(xb), np.maximum.accumulate(ya[order]), np.maximum.accumulate(yb[order]), winding > 0.5))

    def strips(self, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """(left, right, lower and upper heights at both) of the maximal strips of each slab that are wanted."""
        for xa, xb, ya, yb, inside in self.slabs:
            held = wanted(inside[:, 0], inside[:, 1])
            start = held & ~np.append(False, held[:-1])
            stop = ~held & np.append(False, held[:-1])
            if start.any():
                yield xa, xb, ya[start], yb[start], ya[stop], yb[stop]

    def area(self, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> float:
        return float(sum((xb - xa) * ((ta - la) + (tb - lb)).sum() / 2 for xa, xb, la, lb, ta, tb in self.strips(wanted)))

    def shape(self, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Shape:
        """The wanted region's outline: strips' borders, and at slabs' edges what only one side's strips have."""
        onward: dict[tuple[int, int], list[tuple[int, int]]] = {}
        sides: dict[int, list[tuple[int, int, int]]] = {}
        whole = lambda v: int(round(v / self.grid))

        def draw(a: tuple[int, int], b: tuple[int, int]) -> None:
            if a != b:
                onward.setdefault(a, []).append(b)

        for xa, xb, la, lb, ta, tb in self.strips(wanted):
            left, right = whole(xa), whole(xb)
            for heights in zip(la, lb, ta, tb, strict=True):
                a, b, c, d = map(whole, heights)
                draw((left, a), (right, b))
                draw((right, d), (left, c))
                sides.setdefault(left, []).append((a, c, -1))
                sides.setdefault(right, []).append((b, d, 1))
        for x, spans in sides.items():
            steps: dict[int, int] = {}
            for low, high, kind in spans:
                steps[low] = steps.get(low, 0) + kind
                steps[high] = steps.get(high, 0) - kind
            level, places = 0, sorted(steps)
            for low, high in zip(places[:-1], places[1:], strict=True):
                level += steps[low]
                for _ in range(abs(level)):
                    draw(*(((x, low), (x, high)) if level > 0 else ((x, high), (x, low))))
        return nested([r * self.grid for r in _traced(onward)])


def _traced(onward: dict[tuple[int, int], list[tuple[int, int]]]) -> list[np.ndarray]:
    """Rings along directed pieces; where several go on, the sharpest left turn keeps to the same region."""
    rings = []
    # A ring begins where only one way leads on, so that its first turn is right as well.
    for start in sorted(onward, key=lambda p: (len(onward[p]) > 1, p)):
        if start not in onward:
            continue
        ring, at, before = [], start, None
        while True:
            options = onward[at]
            pick = options[0]
            if len(options) > 1 and before is not None:
                back = math.atan2(before[1] - at[1], before[0] - at[0])
                pick = min(options, key=lambda q: (back - math.atan2(q[1] - at[1], q[0] - at[0])) % (2 * math.pi) or 2 * math.pi)  # noqa: B023
            options.remove(pick)
            if not options:
                del onward[at]
            ring.append(at)
            before, at = at, pick
            if at == start:
                break
        if len(ring) > 2:
            r = _straightened(np.array(ring, float))
            if len(r) > 2:
                rings.append(r)
    return rings


def _straightened(ring: np.ndarray) -> np.ndarray:
    """Without corners that lie within some units of the line between their neighbours."""
    while len(ring) > 2:
        before, after = np.roll(ring, 1, axis=0), np.roll(ring, -1, axis=0)
        d, v = after - before, ring - before
        length = np.hypot(*d.T)
        off = np.abs(d[:, 0] * v[:, 1] - d[:, 1] * v[:, 0]) / np.where(length > 0, length, 1)
        drop = (off < 4) & ((d * v).sum(axis=1) >= 0)
        drop[1:] &= ~drop[:-1]  # never two in a row at once
        if len(drop) > 1 and drop[0] and drop[-1]:
            drop[-1] = False
        if not drop.any():
            break
        ring = ring[~drop]
    return ring


def nested(rings: list[np.ndarray]) -> Shape:
    """Shells with the holes that lie in them."""
    shells = sorted(([r] for r in rings if signed_area(r) > 0), key=lambda p: signed_area(p[0]))
    for hole in (r for r in rings if signed_area(r) < 0):
        inner = (hole[0] + hole[1]) / 2
        for polygon in shells:  # the smallest one that holds it
            if inside([[polygon[0]]], inner[None])[0]:
                polygon.append(hole)
                break
    return shells


def intersection(a: Shape, b: Shape) -> Shape:
    return Overlay(rings_of(a), rings_of(b)).shape(lambda p, q: p & q)


def union(*shapes: Shape) -> Shape:
    return Overlay([r for s in shapes for r in rings_of(s)]).shape(lambda p, q: p)


def difference(a: Shape, b: Shape) -> Shape:
    return Overlay(rings_of(a), rings_of(b)).shape(lambda p, q: p & ~q)


def symmetric_difference(a: Shape, b: Shape) -> Shape:
    return Overlay(rings_of(a), rings_of(b)).shape(lambda p, q: p ^ q)


def shared_areas(a: Shape, b: Shape) -> tuple[float, float, float]:
    """Areas of what both have, of what only ``a`` has, and of what only ``b`` has."""
    o = Overlay(rings_of(a), rings_of(b))
    return o.area(lambda p, q: p & q), o.area(lambda p, q: p & ~q), o.area(lambda p, q: ~p & q)


def inside(shape: Shape, points: np.ndarray) -> np.ndarray:
    """Whether points lie in a shape, by how often its rings wind around them; edges count as their right-hand side does."""
    out = np.zeros(len(points), int)
    x, y = points[:, 0, None], points[:, 1, None]
    for r in rings_of(shape):
        s = np.roll(r, -1, axis=0)
        side = (s[:, 0] - r[:, 0]) * (y - r[:, 1]) - (s[:, 1] - r[:, 1]) * (x - r[:, 0])
        up, down = (r[:, 1] <= y) & (s[:, 1] > y), (r[:, 1] > y) & (s[:, 1] <= y)
        out += (up & (side > 0)).sum(axis=1) - (down & (side < 0)).sum(axis=1)
    return out > 0


def _moved(ring: np.ndarray, by: float, quarter: int) -> np.ndarray | None:
    """A ring moved to its right by a distance: arcs at corners that turn left, and at the others a way through the corner,
    which leaves loops that wind the other way and so do not count."""
    ring = ring[(ring != np.roll(ring, 1, axis=0)).any(axis=1)]
    if len(ring) < 2:
        return None
    d = np.roll(ring, -1, axis=0) - ring
    d /= np.hypot(*d.T)[:, None]
    normal = np.column_stack([d[:, 1], -d[:, 0]])
    out = []
    for p, m, n in zip(ring, np.roll(normal, 1, axis=0), normal, strict=True):
        turn = math.pi if m @ n < -1 + 1e-12 else math.atan2(m[0] * n[1] - m[1] * n[0], m @ n)  # back again: around the end
        if turn >= 0:
            t = math.atan2(m[1], m[0]) + turn * np.linspace(0, 1, max(1, math.ceil(turn / (math.pi / 2) * quarter - 1e-9)) + 1)
            out.append(p + by * np.column_stack([np.cos(t), np.sin(t)]))
        else:
            out.append(np.array([p + by * m, p, p + by * n]))
    return np.concatenate(out)


def buffer(shape: Shape, by: float, quarter: int = QUARTER) -> Shape:
    """All places within a distance of a shape; for a negative one, those that are further than it from all outside."""
    if not shape or by == 0:
        return shape
    if by > 0:
        return Overlay([m for r in rings_of(shape) if (m := _moved(r, by, quarter)) is not None]).shape(lambda p, q: p)
    x0, y0, x1, y1 = bounds(shape)
    far = -4 * by + (x1 - x0) + (y1 - y0)
    outside = rings_of(box(x0 - far, y0 - far, x1 + far, y1 + far)) + [m for r in rings_of(shape) if (m := _moved(r[::-1], -by, quarter)) is not None]
    return Overlay(rings_of(shape), outside).shape(lambda p, q: p & ~q)


def buffer_line(line: np.ndarray, by: float, quarter: int = QUARTER) -> Shape:
    """All places within a distance of a line with round ends."""
    if not (line != line[0]).any():
        t = np.arange(4 * quarter) * math.pi / 2 / quarter
        return [[line[0] + by * np.column_stack([np.cos(t), np.sin(t)])]]
    parts = []
    for a, b in zip(line[:-1], line[1:], strict=True):
        moved = _moved(np.array([a, b]), by, quarter)
        if moved is not None:
            parts.append(moved)
    return Overlay(parts).shape(lambda p, q: p)


def boundary_band(shape: Shape, width: float) -> Shape:
    """What lies within half a width of a shape's outline; all of the grown shape if nothing is left of the shrunken one."""
    outer, inner = buffer(shape, width / 2), buffer(shape, -width / 2)
    return difference(outer, inner) if inner else outer


def hausdorff(a: Shape, b: Shape) -> float:
    """Greatest distance of a corner of either shape from the nearest point of the other's outline."""

    def one_way(p: Shape, q: Shape) -> float:
        points = np.concatenate(rings_of(p))
        best = np.full(len(points), np.inf)
        for r in rings_of(q):
            for u, v in zip(r, np.roll(r, -1, axis=0), strict=True):
                best = np.minimum(best, segment_distance(points, u, v))
        return float(best.max())

    return max(one_way(a, b), one_way(b, a)) if a and b else math.nan


def is_valid(coordinates) -> bool:
    """Whether every ring has three different corners and an area, and no two edges of a polygon cross or overlap."""
    for polygon in coordinates:
        for ring in polygon:
            r = np.asarray(ring, float)
            if len(r) < 4 or (r[0] != r[-1]).any() or len(np.unique(r, axis=0)) < 3 or signed_area(r[:-1]) == 0 or not np.isfinite(r).all():
                return False
        a = np.concatenate([np.asarray(r, float)[:-1, :2] for r in polygon])
        b = np.concatenate([np.asarray(r, float)[1:, :2] for r in polygon])
        side = lambda p, q, x: (q[..., 0] - p[..., 0]) * (x[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (x[..., 0] - p[..., 0])
        p, q, u, v = a[:, None], b[:, None], a[None], b[None]
        one, two, three, four = side(p, q, u), side(p, q, v), side(u, v, p), side(u, v, q)
        if ((one * two < 0) & (three * four < 0)).any():
            return False
        flat = (one == 0) & (two == 0) & ~np.eye(len(a), dtype=bool)  # on one line: do they share a stretch?
        along = np.abs(q - p).argmax(axis=2)
        pick = lambda x: np.take_along_axis(np.broadcast_to(x, (len(a), len(a), 2)), np.broadcast_to(along, (len(a), len(a)))[..., None], 2)[..., 0]
        low = np.maximum(np.minimum(pick(p), pick(q)), np.minimum(pick(u), pick(v)))
        high = np.minimum(np.maximum(pick(p), pick(q)), np.maximum(pick(u), pick(v)))
        if (flat & (low < high)).any():
            return False
    return True


def split(shape: Shape, most: float) -> list[Shape]:
    """Parts whose boxes are no longer than ``most``: the longer side is halved as long as it is too long."""
    if not shape:
        return []
    x0, y0, x1, y1 = bounds(shape)
    if max(x1 - x0, y1 - y0) <= most:
        return [[p] for p in shape]
    middle = ((x0 + x1) / 2, (y0 + y1) / 2)
    halves = [box(x0, y0, middle[0], y1), box(middle[0], y0, x1, y1)] if x1 - x0 >= y1 - y0 else [box(x0, y0, x1, middle[1]), box(x0, middle[1], x1, y1)]
    return [part for half in halves for part in split(intersection(shape, half), most)]


def grow_then_shrink(shape: Shape, by: float, tolerance: float = 0.0) -> Shape:
    """Grown and shrunk again, so that gaps narrower than twice the distance close; outlines are then simplified."""
    from .kernels import simplify

    closed = buffer(buffer(shape, by), -by)
    if not tolerance:
        return closed
    thin = [[simplify(np.concatenate([r, r[:1]]), tolerance)[:-1] for r in polygon] for polygon in closed]
    return shape_of([[r for r in polygon if len(r) > 2] for polygon in thin if len(polygon[0]) > 2])


def representative_point(polygon: list[np.ndarray]) -> tuple[float, float]:
    """A place inside a polygon: the middle of the widest stretch along a line through it."""
    ys = np.unique(np.concatenate(polygon)[:, 1])
    middle = (ys[0] + ys[-1]) / 2
    k = min(max(np.searchsorted(ys, middle), 1), len(ys) - 1)
    y = (ys[k - 1] + ys[k]) / 2
    hits = []
    for r in polygon:
        s = np.roll(r, -1, axis=0)
        on = (r[:, 1] > y) != (s[:, 1] > y)
        hits.append(r[on, 0] + (y - r[on, 1]) / (s[on, 1] - r[on, 1]) * (s[on, 0] - r[on, 0]))
    x = np.sort(np.concatenate(hits))
    widest = int((x[1::2] - x[::2]).argmax())
    return float((x[2 * widest] + x[2 * widest + 1]) / 2), float(y)


def coast_to_sea(lines: list[np.ndarray], low: tuple[float, float] = (0.0, 0.0), high: tuple[float, float] = (1.0, 1.0)) -> Shape:
    """The sea in a box, from coastlines that have land to the left: open lines begin and end at the box's border, closed
    ones are islands, or lakes if they wind the other way. From a line's end the border is followed clockwise, with the sea
    inside, to where the next line begins."""
    (x0, y0), (x1, y1) = low, high
    w, h = x1 - x0, y1 - y0
    corners = [(0.0, (x0, y0)), (h, (x0, y1)), (h + w, (x1, y1)), (2 * h + w, (x1, y0))]  # clockwise from the lower left

    def along(p: np.ndarray) -> float:
        away = [abs(p[0] - x0), abs(p[1] - y1), abs(p[0] - x1), abs(p[1] - y0)]
        return [p[1] - y0, h + p[0] - x0, h + w + y1 - p[1], 2 * h + w + x1 - p[0]][int(np.argmin(away))]

    rings = [line[:-1] for line in lines if len(line) > 3 and (line[0] == line[-1]).all()]
    open_ = [line for line in lines if len(line) > 1 and (line[0] != line[-1]).any()]
    begins = [along(line[0]) for line in open_]
    left = set(range(len(open_)))
    shells = []
    while left:
        first = k = min(left)
        points: list = []
        while True:
            left.discard(k)
            points.extend(open_[k].tolist())
            at = along(open_[k][-1])
            turn = 2 * (w + h)
            step = lambda t: (t - at) % turn  # noqa: B023, E731
            nxt = min([first, *left], key=lambda j: step(begins[j]) or turn if j != k or step(begins[j]) else turn)
            points.extend(list(c) for _, c in sorted(((step(t), c) for t, c in corners if 0 < step(t) < (step(begins[nxt]) or turn)), key=lambda v: v[0]))
            if nxt == first:
                break
            k = nxt
        shells.append(np.array(points))
    sea = union(*[[[r if signed_area(r) > 0 else r[::-1]]] for r in shells]) if shells else (box(x0, y0, x1, y1) if rings else [])
    islands = [[[r]] for r in rings if signed_area(r) > 0]
    lakes = [[[r[::-1]]] for r in rings if signed_area(r) < 0]
    sea = difference(sea, union(*islands)) if islands and sea else sea
    return union(sea, *lakes) if lakes else sea
