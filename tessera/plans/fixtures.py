"""Files made of table rows, for queries and tests: movies and PDFs with a given structure and no content."""

from __future__ import annotations

import zlib
from struct import pack

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def box(kind: bytes, *parts: bytes, large: bool = False) -> bytes:
    body = b"".join(parts)
    return pack(">I4sQ", 1, kind, len(body) + 16) + body if large else pack(">I4s", len(body) + 8, kind) + body


def _header(scale: int, units: int, long: bool, tail: int) -> bytes:
    times = pack(">QQIQ", 0, 0, scale, units) if long else pack(">IIII", 0, 0, scale, units)
    return bytes([int(long), 0, 0, 0]) + times + bytes(tail)


def _trak(number: int, kind: bytes, scale: int, runs: list[tuple[int, int]], size: tuple[int, int], long: bool) -> bytes:
    units = sum(n * d for n, d in runs)
    entry = box(b"avc1" if kind == b"vide" else b"mp4a", bytes(24), pack(">HH", *size), bytes(50))
    table = box(b"stbl", box(b"stsd", bytes(4), pack(">I", 1), entry), box(b"stts", bytes(4), pack(">I", len(runs)), *[pack(">II", *r) for r in runs]))
    media = box(b"mdia", box(b"mdhd", _header(scale, units, long, 4)), box(b"hdlr", bytes(8), kind, bytes(13)), box(b"minf", table))
    return box(b"trak", box(b"tkhd", bytes(12), pack(">I", number), bytes(60), pack(">II", size[0] << 16, size[1] << 16)), media)


def movie(frames: int, delta: int = 512, scale: int = 15360, size: tuple[int, int] = (640, 480), sound: bool = True, long: bool = False, last: bool = True, fragments: int = 0, data: int = 100, video: bool = True) -> bytes:
    """An ISO base media file of so many frames; its header behind the data or before, or in fragments."""
    units = 0 if fragments else frames * delta
    long = long or max(units, 0 if fragments else frames * 1024) >= (1 << 32) - 1
    runs = [] if fragments else [(frames, delta)] if frames else []
    tracks = ([_trak(1, b"vide", scale, runs, size, long)] if video else []) + ([_trak(2, b"soun", 48000, [] if fragments else [(frames, 1024)], (0, 0), long)] if sound else [])
    extra = [box(b"mvex", *[box(b"trex", bytes(4), pack(">IIIII", k, 1, delta, 0, 0)) for k in (1, 2)])] if fragments else []
    moov = box(b"moov", box(b"mvhd", _header(scale, units, long, 80)), *tracks, *extra)
    mdat = box(b"mdat", bytes(data), large=long)
    start = box(b"ftyp", b"isom", bytes(8))
    if fragments:
        parts = [frames // fragments + (k < frames % fragments) for k in range(fragments)]
        moofs = [box(b"moof", box(b"mfhd", bytes(8)), box(b"traf", box(b"tfhd", bytes(4), pack(">I", 1)), box(b"trun", bytes(4), pack(">I", n)))) + mdat for n in parts]
        return start + moov + b"".join(moofs)
    return start + (mdat + moov if last else moov + mdat)


class Pdf:
    """A PDF built object by object; ``update`` adds a section that replaces objects."""

    def __init__(self, compressed: bool = False):
        self.data, self.compressed, self.last, self.highest = bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), compressed, 0, 0

    def update(self, objects: dict[int, bytes], root: int = 1) -> Pdf:
        self.highest = max(self.highest, *objects)
        places = {}
        plain = {} if self.compressed else objects
        if self.compressed:  # all in one object stream, and the cross references as a stream
            packed = self.highest + 1
            head, body = b"", b""
            for k, (number, text) in enumerate(sorted(objects.items())):
                head += b"%d %d " % (number, len(body))
                body += text + b" "
                places[number] = (2, packed, k)
            stream = zlib.compress(head + body)
            plain = {packed: b"<< /Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d >>\nstream\n" % (len(objects), len(head), len(stream)) + stream + b"\nendstream"}
            self.highest += 1
        for number, text in plain.items():
            places[number] = (1, len(self.data), 0)
            self.data += b"%d 0 obj\n" % number + text + b"\nendobj\n"
        begin, before = len(self.data), b" /Prev %d" % self.last if self.last else b""
        if self.compressed:
            self.highest += 1
            places[self.highest] = (1, begin, 0)
            numbers = sorted(places)
            rows = b"".join(pack(">BIH", *places[n]) for n in numbers)
            coded, above = b"", bytes(7)
            for k in range(0, len(rows), 7):  # each row less the one above it
                coded += b"\x02" + bytes((a - b) % 256 for a, b in zip(rows[k : k + 7], above, strict=True))
                above = rows[k : k + 7]
            stream = zlib.compress(coded)
            index = b" ".join(b"%d 1" % n for n in numbers)
            what = b"<< /Type /XRef /Size %d /W [1 4 2] /Index [%s] /Root %d 0 R%s /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 7 >> /Length %d >>" % (self.highest + 1, index, root, before, len(stream))
            self.data += b"%d 0 obj\n" % self.highest + what + b"\nstream\n" + stream + b"\nendstream\nendobj\n"
        else:
            self.data += b"xref\n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, p[1]) for n, p in sorted(places.items()))
            self.data += b"trailer\n<< /Size %d /Root %d 0 R%s >>\n" % (self.highest + 1, root, before)
        self.data += b"startxref\n%d\n%%%%EOF\n" % begin
        self.last = begin
        return self


def pdf(pages: int, fan: int = 10, compressed: bool = False, size: tuple[float, float] = (612, 792), filler: int = 0) -> bytes:
    """A PDF of so many pages in a tree with ``fan`` children a node; page k is k points higher than ``size``."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>"}
    if filler:
        objects[3] = b"<< /Length %d >>\nstream\n" % filler + bytes(filler) + b"\nendstream"
    number = 3
    level = [[0, 1] for _ in range(pages)]  # object, pages
    for k in range(pages):
        number += 1
        level[k][0] = number
        objects[number] = b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %d %d] >>" % (size[0], size[1] + k + 1) if k % 2 else b"<< /Type /Page /Parent 2 0 R >>"
    while len(level) > fan:
        above = []
        for k in range(0, len(level), fan):
            number += 1
            kids = level[k : k + fan]
            objects[number] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (sum(n for _, n in kids), b" ".join(b"%d 0 R" % o for o, _ in kids))
            above.append([number, sum(n for _, n in kids)])
        level = above
    objects[2] = b"<< /Type /Pages /MediaBox [0 0 %d %d] /Count %d /Kids [%s] >>" % (*size, pages, b" ".join(b"%d 0 R" % o for o, _ in level))
    return bytes(Pdf(compressed and not filler).update(objects).data)


def _film(key: int, frames: int, k: int) -> bytes:
    data = movie(frames, size=(16 * k, 9 * k), sound=key % 3 != 0, long=key % 5 == 0, last=key % 2 == 0, fragments=3 if key % 4 == 1 else 0)
    return data[: len(data) - 130] if key % 7 == 6 else data


def _films(key: pd.Series, frames: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([_film(*x) for x in zip(key.tolist(), frames.tolist(), k.tolist(), strict=True)])


def film(key: str, frames: str, k: str) -> Column:
    """A movie for each row: its form by the key, so many frames, 16 k by 9 k pixels."""
    return F.pandas_udf(_films, "binary")(key, frames, k)


def _paper(key: int, pages: int) -> bytes:
    data = pdf(pages, 8, key % 3 == 1)
    if key % 3 == 2:  # an update that replaces the root of the tree by one above it
        doc = Pdf()
        doc.data, doc.highest = bytearray(data), pages + 500
        doc.last = int(data.rsplit(b"startxref\n", 1)[1].split()[0])
        data = bytes(doc.update({1: b"<< /Type /Catalog /Pages %d 0 R >>" % (pages + 500), pages + 500: b"<< /Type /Pages /Count 1 /Kids [2 0 R] >>"}).data)
    return data[: len(data) // 2] if key % 11 == 10 else data


def _papers(key: pd.Series, pages: pd.Series) -> pd.Series:
    return pd.Series([_paper(*x) for x in zip(key.tolist(), pages.tolist(), strict=True)])


def paper(key: Column | str, pages: Column) -> Column:
    """A PDF of so many pages for each row, its form by the key."""
    return F.pandas_udf(_papers, "binary")(key, pages)
