"""Pixels without a library: overlays of layout blocks and of hand poses as PNG files (SNK6, SNK7).

Spark decides what is drawn (which blocks, which joints and edges, which label) and deals out the
pages; a task paints one image at a time on an array and encodes it.  Shapes are exact sets of
pixels: an outline of width w lies inside its rectangle, a disc has the pixels within its radius, a
line those within half its width of the segment.  Labels have the letters A to Z, digits and a few
signs, five by seven, others are left blank.  Coordinates may lie outside; what is outside is cut off.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.tracks import BIG_JOINTS, EDGES

# Fixed values that results must agree on: colours as red, green, blue, and sizes.
BOX_COLOR, BOX_WIDTH, LABEL_COLOR = (51, 112, 255), 3, (220, 53, 69)
HAND_COLORS = {"left": (30, 180, 255), "right": (90, 210, 50)}
FINGER_COLORS = ((255, 200, 80), (120, 255, 80), (70, 220, 255), (80, 130, 255), (255, 90, 220))
EDGE_WIDTH, JOINT_RIM, RIM_COLOR = 4, 2, (20, 20, 20)
#: Rows of five for each letter, from the top; # is ink.
GLYPHS = {
    "A": ".###./#...#/#...#/#####/#...#/#...#/#...#", "B": "####./#...#/#...#/####./#...#/#...#/####.", "C": ".####/#..../#..../#..../#..../#..../.####",
    "D": "####./#...#/#...#/#...#/#...#/#...#/####.", "E": "#####/#..../#..../####./#..../#..../#####", "F": "#####/#..../#..../####./#..../#..../#....",
    "G": ".####/#..../#..../#..##/#...#/#...#/.####", "H": "#...#/#...#/#...#/#####/#...#/#...#/#...#", "I": "#####/..#../..#../..#../..#../..#../#####",
    "J": "..###/...#./...#./...#./...#./#..#./.##..", "K": "#...#/#..#./#.#../##.../#.#../#..#./#...#", "L": "#..../#..../#..../#..../#..../#..../#####",
    "M": "#...#/##.##/#.#.#/#...#/#...#/#...#/#...#", "N": "#...#/##..#/#.#.#/#..##/#...#/#...#/#...#", "O": ".###./#...#/#...#/#...#/#...#/#...#/.###.",
    "P": "####./#...#/#...#/####./#..../#..../#....", "Q": ".###./#...#/#...#/#...#/#.#.#/#..#./.##.#", "R": "####./#...#/#...#/####./#.#../#..#./#...#",
    "S": ".####/#..../#..../.###./....#/....#/####.", "T": "#####/..#../..#../..#../..#../..#../..#..", "U": "#...#/#...#/#...#/#...#/#...#/#...#/.###.",
    "V": "#...#/#...#/#...#/#...#/#...#/.#.#./..#..", "W": "#...#/#...#/#...#/#...#/#.#.#/##.##/#...#", "X": "#...#/#...#/.#.#./..#../.#.#./#...#/#...#",
    "Y": "#...#/#...#/.#.#./..#../..#../..#../..#..", "Z": "#####/....#/...#./..#../.#.../#..../#####",
    "0": ".###./#...#/#..##/#.#.#/##..#/#...#/.###.", "1": "..#../.##../..#../..#../..#../..#../.###.", "2": ".###./#...#/....#/..##./.#.../#..../#####",
    "3": "####./....#/....#/.###./....#/....#/####.", "4": "#...#/#...#/#...#/#####/....#/....#/....#", "5": "#####/#..../####./....#/....#/#...#/.###.",
    "6": ".###./#..../#..../####./#...#/#...#/.###.", "7": "#####/....#/...#./..#../..#../..#../..#..", "8": ".###./#...#/#...#/.###./#...#/#...#/.###.",
    "9": ".###./#...#/#...#/.####/....#/....#/.###.", ".": "...../...../...../...../...../.##../.##..", "-": "...../...../...../#####/...../...../.....",
}
INK = {c: np.array([[x == "#" for x in row] for row in rows.split("/")]) for c, rows in GLYPHS.items()}


class Canvas:
    """An image as an array of (height, width, 3)."""

    def __init__(self, width: int, height: int, color: tuple[int, int, int] = (255, 255, 255)):
        if width < 1 or height < 1:
            raise ValueError(f"an image of {width} by {height}")
        self.pixels = np.empty((height, width, 3), np.uint8)
        self.pixels[:] = color

    def fill(self, x1: int, y1: int, x2: int, y2: int, color) -> None:
        """All pixels from one corner up to and with the other."""
        h, w = self.pixels.shape[:2]
        x1, y1, x2, y2 = max(x1, 0), max(y1, 0), min(x2, w - 1), min(y2, h - 1)
        if x1 <= x2 and y1 <= y2:
            self.pixels[y1 : y2 + 1, x1 : x2 + 1] = color

    def outline(self, x1: int, y1: int, x2: int, y2: int, color, width: int = 1) -> None:
        x1, x2, y1, y2 = min(x1, x2), max(x1, x2), min(y1, y2), max(y1, y2)
        across, down = min(width, y2 - y1 + 1) - 1, min(width, x2 - x1 + 1) - 1
        self.fill(x1, y1, x2, y1 + across, color)
        self.fill(x1, y2 - across, x2, y2, color)
        self.fill(x1, y1, x1 + down, y2, color)
        self.fill(x2 - down, y1, x2, y2, color)

    def near(self, x1: float, y1: float, x2: float, y2: float, reach: float, color) -> None:
        """The pixels within ``reach`` of a segment; of a point, a disc."""
        h, w = self.pixels.shape[:2]
        left, right = max(int(np.floor(min(x1, x2) - reach)), 0), min(int(np.ceil(max(x1, x2) + reach)), w - 1)
        top, bottom = max(int(np.floor(min(y1, y2) - reach)), 0), min(int(np.ceil(max(y1, y2) + reach)), h - 1)
        if left > right or top > bottom:
            return
        x, y = np.arange(left, right + 1)[None, :] - x1, np.arange(top, bottom + 1)[:, None] - y1
        dx, dy = x2 - x1, y2 - y1
        length = dx * dx + dy * dy
        t = np.clip((x * dx + y * dy) / length, 0, 1) if length else np.zeros((len(y), x.shape[1]))
        hit = (x - t * dx) ** 2 + (y - t * dy) ** 2 <= reach * reach
        self.pixels[top : bottom + 1, left : right + 1][hit] = color

    def text(self, x: int, y: int, text: str, color, scale: int = 1) -> None:
        """Letters from their upper left corner, six columns each."""
        h, w = self.pixels.shape[:2]
        for k, c in enumerate(text.upper()):
            ink = INK.get(c)
            if ink is not None:
                rows, columns = np.nonzero(np.kron(ink, np.ones((scale, scale), bool)))
                rows, columns = rows + y, columns + x + 6 * scale * k
                ok = (rows >= 0) & (rows < h) & (columns >= 0) & (columns < w)
                self.pixels[rows[ok], columns[ok]] = color

    def png(self) -> bytes:
        h, w = self.pixels.shape[:2]
        rows = np.zeros((h, 1 + 3 * w), np.uint8)
        rows[:, 1:] = self.pixels.reshape(h, 3 * w)

        def chunk(kind: bytes, data: bytes) -> bytes:
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def unpacked(data: bytes) -> np.ndarray:
    """The pixels of a PNG that ``Canvas.png`` made."""
    w, h = struct.unpack(">II", data[16:24])
    at, body = 8, b""
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body += data[at + 8 : at + 8 + size] if kind == b"IDAT" else b""
        at += 12 + size
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + 3 * w)[:, 1:].reshape(h, w, 3)


def draw_blocks(canvas: Canvas, blocks: list[dict]) -> None:
    """The box and the label of each block that has a box."""
    for b in blocks or []:
        box = b and b["bbox"]
        if box and len(box) == 4 and all(x is not None and np.isfinite(x) for x in box):
            x1, y1, x2, y2 = (int(x) for x in box)
            canvas.outline(x1, y1, x2, y2, BOX_COLOR, BOX_WIDTH)
            canvas.text(x1 + 4, max(y1 - 16, 0), f"{b['index']} {b['category'] or ''}", LABEL_COLOR)


def draw_hands(canvas: Canvas, hands: list[dict]) -> None:
    """Box, label, the edges in the colour of their finger, joints with a dark rim; null joints are left out."""
    for hand in hands or []:
        color = HAND_COLORS[hand["handedness"]]
        x1, y1, x2, y2 = (int(x) for x in hand["bbox_xyxy"])
        canvas.outline(x1, y1, x2, y2, color, BOX_WIDTH)
        score = hand["detection_score"]
        label = hand["handedness"] + ("" if score is None else f" {score:.2f}")
        canvas.text(x1, max(28, y1 - 10) - 14, label, color, 2)
        points = [p and [float(np.rint(x)) for x in p[:2]] for p in hand["keypoints_2d"]]
        for k, (a, b) in enumerate(EDGES):
            if points[a] and points[b]:
                canvas.near(*points[a], *points[b], EDGE_WIDTH / 2, FINGER_COLORS[k // 4])
        for k, p in enumerate(points):
            if p:
                radius = 7 if k in BIG_JOINTS else 5
                canvas.near(*p, *p, radius + JOINT_RIM, RIM_COLOR)
                canvas.near(*p, *p, radius, color)


def _painted(rows: DataFrame, draw, what: str, keep: list[str]) -> DataFrame:
    """(keep, content): a white image of each row's width and height with its ``what`` drawn."""
    names = [*keep, "width", "height", what]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # an image at a time leaves the task
                row = batch.slice(k, 1)
                canvas = Canvas(row.column(len(keep))[0].as_py(), row.column(len(keep) + 1)[0].as_py())
                draw(canvas, row.column(len(keep) + 2)[0].as_py())
                yield pa.RecordBatch.from_arrays([*row.columns[: len(keep)], pa.array([canvas.png()], pa.binary())], names=[*keep, "content"])

    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep) + "content binary"
    return rows.select(*names).mapInArrow(run, schema)


def layout_overlays(pages: DataFrame, keep: list[str], blocks: str = "blocks") -> DataFrame:
    """Overlays of pages (keep, width, height, blocks of index, category and bbox)."""
    return _painted(pages, draw_blocks, blocks, keep)


def hand_frames(frames: DataFrame, keep: list[str], hands: str = "hands") -> DataFrame:
    """Frames (keep, width, height, hands as ``tracks.frame_records`` has them) with their skeletons."""
    return _painted(frames, draw_hands, hands, keep)


def pixels_of(content: Column | str, color: tuple[int, int, int]) -> Column:
    """How many pixels of an image made here have a colour."""

    def count(images: pd.Series) -> pd.Series:
        return images.map(lambda data: int((unpacked(bytes(data)) == color).all(2).sum()))

    return F.pandas_udf(count, "long")(content)
