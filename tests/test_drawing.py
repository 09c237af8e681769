"""Shapes pixel by pixel against plain rules, and files that hold what was drawn."""

import random
import zlib

import numpy as np
import pytest

from tessera.operators import drawing as D
from tessera.operators import tracks
from tessera.sources import files

RED = (9, 8, 7)


def marked(canvas):
    return {(int(x), int(y)) for y, x in zip(*np.nonzero((canvas.pixels == RED).all(2)))}


@pytest.mark.parametrize("seed", range(12))
def test_shapes_are_exact(seed):
    rng = random.Random(seed)
    w, h = rng.randint(1, 40), rng.randint(1, 40)
    at = lambda: (rng.randint(-15, 55), rng.randint(-15, 55))
    (x1, y1), (x2, y2), width = at(), at(), rng.randint(1, 4)
    c = D.Canvas(w, h)
    c.outline(x1, y1, x2, y2, RED, width)
    a, b, e, f = min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)
    inside = lambda x, y: a <= x <= e and b <= y <= f and (x < a + width or x > e - width or y < b + width or y > f - width)
    assert marked(c) == {(x, y) for x in range(w) for y in range(h) if inside(x, y)}
    for dx, dy in ((x2 - x1, y2 - y1), (0, 0)):
        c, reach = D.Canvas(w, h), rng.choice([0, 1, 2, 5.5])
        c.near(x1, y1, x1 + dx, y1 + dy, reach, RED)

        def away(x, y):
            n = dx * dx + dy * dy
            t = min(1, max(0, ((x - x1) * dx + (y - y1) * dy) / n)) if n else 0
            return (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2

        assert marked(c) == {(x, y) for x in range(w) for y in range(h) if away(x, y) <= reach**2}


def test_labels():
    c = D.Canvas(60, 20)
    c.text(2, 3, "t~1", RED)
    ink = lambda ch, dx: {(2 + dx + x, 3 + y) for y, row in enumerate(D.GLYPHS[ch].split("/")) for x, p in enumerate(row) if p == "#"}
    assert marked(c) == ink("T", 0) | ink("1", 12)
    big = D.Canvas(60, 20)
    big.text(0, 0, "-", RED, 2)
    assert marked(big) == {(x, y) for x in range(10) for y in (6, 7)}
    D.Canvas(3, 3).text(-4, -4, "CUT OFF", RED)
    assert all(len(g.split("/")) == 7 and all(len(r) == 5 for r in g.split("/")) for g in D.GLYPHS.values())


def test_files_hold_the_pixels(spark):
    rng = np.random.default_rng(1)
    for w, h in ((1, 1), (7, 3), (64, 48)):
        c = D.Canvas(w, h)
        c.pixels[:] = rng.integers(0, 256, (h, w, 3))
        data = c.png()
        assert (D.unpacked(data) == c.pixels).all()
        assert data[-4:] == zlib.crc32(b"IEND").to_bytes(4, "big") and data[8:16] == b"\x00\x00\x00\rIHDR"
    sizes = files.png_headers(spark.createDataFrame([("a", bytearray(D.Canvas(5, 9).png()))], "path string, content binary")).first()
    assert (sizes.width, sizes.height) == (5, 9)
    with pytest.raises(ValueError, match="0 by 4"):
        D.Canvas(0, 4)


def test_overlays_of_pages(spark):
    schema = "doc string, page int, width int, height int, blocks array<struct<index: int, category: string, bbox: array<double>>>"
    pages = [("a", 1, 100, 80, [(1, "Table", [10.0, 30.0, 60.0, 70.0]), (2, "Text", None), (3, None, [1.0, 2.0])]), ("a", 2, 20, 20, None), ("b", 1, 30, 30, [])]
    got = {(r.doc, r.page): D.unpacked(bytes(r.content)) for r in D.layout_overlays(spark.createDataFrame(pages, schema), ["doc", "page"]).collect()}
    c = D.Canvas(100, 80)
    c.outline(10, 30, 60, 70, D.BOX_COLOR, 3)
    c.text(14, 14, "1 Table", D.LABEL_COLOR)
    assert (got["a", 1] == c.pixels).all() and (got["a", 2] == 255).all() and got["b", 1].shape == (30, 30, 3)


def test_hands_of_frames(spark):
    joints = [[20.0 + 3 * k, 60.0 + k] for k in range(21)]
    hand = lambda side, score, points: (side, [10.0, 40.0, 90.0, 90.0], False, score, points, None)
    schema = "video string, frame_index int, width int, height int, hands array<struct<handedness: string, bbox_xyxy: array<double>, bbox_interpolated: boolean, detection_score: double, keypoints_2d: array<array<double>>, keypoints_3d: array<array<double>>>>"
    rows = [("v", 0, 120, 100, [hand("left", 0.9, joints), hand("right", None, [None] * 21)]), ("v", 1, 120, 100, [])]
    got = {r.frame_index: D.unpacked(bytes(r.content)) for r in D.hand_frames(spark.createDataFrame(rows, schema), ["video", "frame_index"]).collect()}
    assert (got[1] == 255).all()
    for k, (x, y) in enumerate(joints):  # the last joint lies over the others
        assert tuple(got[0][int(y), int(x)]) in {D.HAND_COLORS["left"], D.RIM_COLOR}, k
    x, y = (int(v) for v in joints[20])
    assert tuple(got[0][y, x + 7]) == D.HAND_COLORS["left"] and tuple(got[0][y, x - 9]) == D.RIM_COLOR
    assert tuple(got[0][40, 50]) == D.HAND_COLORS["right"] and {tuple(p) for p in got[0].reshape(-1, 3)} >= {D.HAND_COLORS["left"], D.HAND_COLORS["right"]}
    assert len(tracks.EDGES) == 20
