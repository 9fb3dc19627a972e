"""Kernels against definitions worked out by hand or by brute force."""

import math

import numpy as np
import pytest

from terravane.functions import kernels as k
from terravane.sources import codecs

SQUARE = np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float)


def test_area_and_centroid():
    assert k.signed_area(SQUARE) == 16 and k.signed_area(SQUARE[::-1]) == -16
    assert k.centroid(SQUARE) == (2, 2) and k.centroid(np.array([[0, 0], [2, 0]], float)) == (1, 0)


def test_hull_and_rectangle():
    r = np.random.default_rng(0)
    pts = np.concatenate([r.random((50, 2)) * 3.9, SQUARE])
    assert sorted(map(tuple, k.convex_hull(pts))) == sorted(map(tuple, SQUARE))
    turn = np.array([[math.cos(0.3), -math.sin(0.3)], [math.sin(0.3), math.cos(0.3)]])
    box = k.least_rectangle(pts @ turn.T)
    assert abs(k.signed_area(box)) == pytest.approx(16)
    assert k.least_rectangle(np.array([[1, 1], [1, 1]], float)).shape == (4, 2)


def test_simplify_and_hausdorff():
    line = np.array([[0, 0], [1, 0.05], [2, -0.05], [3, 2], [4, 0]], float)
    assert k.simplify(line, 0.5).tolist() == [[0, 0], [2, -0.05], [3, 2], [4, 0]]
    assert k.hausdorff(SQUARE, SQUARE + [1, 0]) == 1 and math.isnan(k.hausdorff(SQUARE, SQUARE[:0]))


def test_clip_and_grow():
    assert abs(k.signed_area(k.clip_convex(SQUARE, SQUARE + [1, 2]))) == 6
    assert len(k.clip_convex(SQUARE, SQUARE + [9, 9])) == 0
    assert k.signed_area(k.grow_convex(SQUARE, 1.0, 64)) == pytest.approx(16 + 16 + math.pi, rel=1e-3)
    assert k.signed_area(k.grow_convex(SQUARE, -1.0)) == pytest.approx(4)
    assert len(k.grow_convex(SQUARE, -3.0)) == 0


def test_contains_and_rasterise():
    ring = np.array([[1, 1], [6, 2], [4, 6]], float)
    mask = k.rasterise(ring, 8, 8)
    centres = np.stack(np.meshgrid(np.arange(8) + 0.5, np.arange(8) + 0.5), axis=-1).reshape(-1, 2)
    assert (k.contains(ring, centres).reshape(8, 8) == mask).all()
    assert k.rasterise(ring + 100, 8, 8).sum() == 0


def test_morphology_and_groups():
    m = np.zeros((9, 9), bool)
    m[1:4, 1:4] = m[4, 4] = m[7, 1] = True
    assert (k.open_close(m, 1, 0) == np.pad(np.ones((3, 3), bool), ((1, 5), (1, 5)))).all()
    groups = k.label(m)
    assert groups.max() == 2 and groups[1, 1] == groups[4, 4] == 1 and groups[7, 1] == 2
    assert k.drop_small(m, 2).sum() == 10 and k.label(np.zeros((2, 2))).max() == 0


def test_outlines():
    m = np.ones((3, 3), bool)
    m[1, 1] = False
    rings = sorted(k.outlines(m), key=len)
    assert sorted(abs(k.signed_area(r)) for r in rings) == [1, 9] and np.sign(k.signed_area(rings[0])) != np.sign(k.signed_area(rings[1])) or len(rings) == 2
    assert len(k.outlines(np.eye(2, dtype=bool))) == 2


def test_distance():
    m = np.random.default_rng(1).random((7, 9)) > 0.8
    on = np.argwhere(m)
    want = [[min(math.hypot(r - a, c - b) for a, b in on) for c in range(9)] for r in range(7)]
    assert np.allclose(k.distance(m), want)
    assert k.band_distance(m, 3).dtype == np.uint8


def test_grids():
    g = np.arange(12.0).reshape(3, 4)
    assert k.upsample(g).shape == (7, 10) and np.allclose(k.upsample(g)[::3, ::3], g)
    assert np.allclose(k.hat_blur(np.full((5, 5), 2.0), 2), 2)
    void = g.copy()
    void[1, 1] = -1
    assert k.fill_nodata(void, -1)[1, 1] == 9 and k.fill_nodata(void, -1, most=1)[1, 1] == -1
    assert k.resample(g, np.array([0.5]), np.array([0.5])) == 2.5


def test_suppression_and_ways():
    boxes = np.array([[0, 0, 4, 4], [0, 0, 4, 3.9], [9, 9, 12, 12], [1, 0, 9, 4]], float)
    assert k.suppress(boxes, np.array([0.5, 0.9, 0.5, 0.1])).tolist() == [1, 2, 3]
    assert k.suppress(boxes[:0], np.zeros(0)).tolist() == []
    assert np.allclose(k.smooth_ring(np.ones(5), np.ones(3) / 3), 1)
    x = np.linspace(0, 1, 20)
    assert np.allclose(k.fit_altitudes(x, x**3 - x), x**3 - x)


@pytest.mark.parametrize("shape", [(5, 7), (5, 7, 3), (1, 1, 4)])
def test_png(shape):
    image = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    assert (codecs.read_png(codecs.write_png(image)) == image).all()
    with pytest.raises(ValueError):
        codecs.read_png(b"nothing")


def test_png_filters():
    import struct
    import zlib

    image = np.random.default_rng(0).integers(0, 256, (5, 4)).astype(int)
    rows, above = b"", np.zeros(4, int)
    for kind, line in enumerate(image):
        left, corner = np.append(0, line[:-1]), np.append(0, above[:-1])
        guess = [min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2] for a, b, c in zip(left, above, corner, strict=True)]
        rows += bytes([kind]) + bytes((line - [0 * left, left, above, (left + above) // 2, np.array(guess)][kind]).astype(np.uint8))
        above = line
    plain = codecs.write_png(image.astype(np.uint8))
    at = plain.index(b"IDAT") - 4
    body = zlib.compress(rows)
    data = plain[:at] + struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", 0) + plain[-12:]
    assert (codecs.read_png(data) == image).all()


def test_occupancy():
    image = np.zeros((2, 2, 4), np.uint8)
    image[..., 3] = 255
    image[1, 0, 2] = 1
    assert codecs.occupancy(codecs.write_png(image), 4, 4).tolist() == [[False] * 4] * 2 + [[True, True, False, False]] * 2
    assert not codecs.occupancy(None, 3, 2).any()


@pytest.mark.parametrize("kind", [np.uint8, np.int16, np.float32])
def test_tiff(kind):
    bands = np.random.default_rng(0).integers(0, 99, (2, 5, 7)).astype(kind)
    t = codecs.Tiff(codecs.write_tiff(bands, (29.0, 41.0, 0.1, 0.2), 32637, -32768))
    assert (t.pixels == bands).all() and t.transform() == (29.0, 41.0, 0.1, 0.2) and t.epsg == 32637 and t.nodata == -32768
    w = t.window(-1, 5, 3, 4, 9)
    assert (w[:, 0] == 9).all() and (w[:, 1:, :2] == bands[:, :2, 5:]).all() and (w[:, :, 2:] == 9).all()
    with pytest.raises(ValueError):
        codecs.Tiff(b"nothing at all")


def test_heights():
    h = np.arange(6).reshape(2, 3) * 13107
    assert np.allclose(codecs.read_heights(codecs.write_heights(h), 2, 3), h / 65535)
    assert codecs.read_heights(b"", 2, 2).tolist() == [[0, 0], [0, 0]]
    assert codecs.read_hgt(np.arange(9).astype(">i2").tobytes()).tolist() == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]
