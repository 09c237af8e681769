"""Duration, audio, geometry and frames from the headers of media files, without a tool (SRC17 to SRC19).

ISO base media files (mp4, mov, m4a): the boxes are walked by their sizes, and only those that
describe tracks are read; media data is skipped over.  Fragmented files are summed over their
fragments.  RIFF wave files give their duration.  What a file doesn't say is null; a file that is
cut off, whose boxes run over their ends, or that is something else, is null throughout with its error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from struct import unpack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.ranged import Broken, Bytes, each_file

#: A table of a track may have that many bytes; a header with more is taken to be broken.
LARGEST = 1 << 28
NAMES = ["duration_seconds", "audio_present", "width", "height", "fps", "frame_count"]
SCHEMA = "double,boolean,int,int,double,int"


@dataclass
class Track:
    number: int = 0
    kind: bytes = b""
    scale: int = 0
    units: int = 0
    frames: int = 0
    summed: int = 0
    width: int = 0
    height: int = 0
    default: int = 0
    entry: tuple[int, int] = (0, 0)


@dataclass
class Movie:
    scale: int = 0
    units: int = 0
    fragment_units: int = 0
    tracks: list[Track] = field(default_factory=list)


def boxes(data: Bytes, begin: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, begin, end of what is inside) of the boxes between two offsets."""
    while begin < end:
        if end - begin < 8:
            raise Broken(f"{end - begin} bytes behind the last box")
        size, kind = unpack(">I4s", data.at(begin, 8))
        inside = begin + 8
        if size == 1:
            (size,), inside = unpack(">Q", data.at(inside, 8)), begin + 16
        elif size == 0:  # up to the end
            size = end - begin
        if begin + size < inside or begin + size > end:
            raise Broken(f"box {kind!r} at {begin} has {size} bytes")
        yield kind, inside, begin + size
        begin += size


def _body(data: Bytes, begin: int, end: int, least: int) -> bytes:
    if not least <= end - begin <= LARGEST:
        raise Broken(f"a box of {end - begin} bytes where at least {least} are needed")
    return data.at(begin, end - begin)


def _timed(body: bytes) -> tuple[int, int]:
    """(scale, units) of a movie or media header; units that are all ones are unknown."""
    long = body[0] == 1
    if len(body) < (32 if long else 20):
        raise Broken("a header that is cut off")
    scale, units = unpack(">IQ", body[20:32]) if long else unpack(">II", body[12:20])
    return scale, 0 if units == (1 << (64 if long else 32)) - 1 else units


def _times(body: bytes) -> tuple[int, int]:
    """(samples, units) of a table of (count, units each)."""
    (n,) = unpack(">I", body[4:8])
    if 8 + 8 * n > len(body):
        raise Broken(f"a table of {n} entries in {len(body)} bytes")
    pairs = unpack(f">{2 * n}I", body[8 : 8 + 8 * n])
    return sum(pairs[::2]), sum(a * b for a, b in zip(pairs[::2], pairs[1::2], strict=True))


def _track(data: Bytes, begin: int, end: int, track: Track) -> Track:
    for kind, a, b in boxes(data, begin, end):
        if kind in (b"mdia", b"minf", b"stbl"):
            _track(data, a, b, track)
        elif kind == b"tkhd":
            body = _body(data, a, b, 84)
            track.number = unpack(">I", body[20:24] if body[0] == 1 else body[12:16])[0]
            track.width, track.height = (x >> 16 for x in unpack(">II", body[-8:]))
        elif kind == b"mdhd":
            track.scale, track.units = _timed(_body(data, a, b, 20))
        elif kind == b"hdlr":
            track.kind = _body(data, a, b, 12)[8:12]
        elif kind == b"stts":
            track.frames, track.summed = _times(_body(data, a, b, 8))
        elif kind == b"stsd":
            head = data.at(a, min(b - a, 44))
            if len(head) == 44:
                track.entry = unpack(">HH", head[40:44])
    return track


def _fragment(data: Bytes, begin: int, end: int, movie: Movie) -> None:
    """Add the samples of one track's part of a fragment."""
    track, default = None, 0
    for kind, a, b in boxes(data, begin, end):
        if kind == b"tfhd":
            body = _body(data, a, b, 8)
            flags, number = unpack(">II", body[:8])
            track = next((t for t in movie.tracks if t.number == number), None)
            default, at = track.default if track else 0, 8 + 8 * (flags & 1) + 4 * (flags >> 1 & 1)
            if flags & 8:
                (default,) = unpack(">I", _body(data, a, b, at + 4)[at : at + 4])
        elif kind == b"trun" and track is not None:
            body = _body(data, a, b, 8)
            flags, n = unpack(">II", body[:8])
            at, step = 8 + 4 * (flags & 1) + 4 * (flags >> 2 & 1), 4 * bin(flags & 0xF00).count("1")
            if at + n * step > len(body):
                raise Broken(f"a run of {n} samples in {len(body)} bytes")
            track.frames += n
            track.summed += sum(unpack(f">{n * step // 4}I", body[at : at + n * step])[:: step // 4]) if flags & 0x100 else n * default


def movie(data: Bytes) -> Movie:
    """What the boxes of a file say."""
    found, out = False, Movie()
    for kind, a, b in boxes(data, 0, data.size):
        if kind == b"moov":
            found = True
            for inner, c, d in boxes(data, a, b):
                if inner == b"mvhd":
                    out.scale, out.units = _timed(_body(data, c, d, 20))
                elif inner == b"trak":
                    out.tracks.append(_track(data, c, d, Track()))
                elif inner == b"mvex":
                    for x, e, f in boxes(data, c, d):
                        if x == b"trex":
                            number, _, default = unpack(">III", _body(data, e, f, 24)[4:16])
                            for t in out.tracks:
                                t.default = default if t.number == number else t.default
                        elif x == b"mehd":
                            body = _body(data, e, f, 8)
                            (out.fragment_units,) = unpack(">Q", body[4:12]) if body[0] == 1 else unpack(">I", body[4:8])
        elif kind == b"moof":
            for inner, c, d in boxes(data, a, b):
                if inner == b"traf":
                    _fragment(data, c, d, out)
    if not found:
        raise Broken("no movie box")
    return out


def _iso(data: Bytes) -> tuple:
    m = movie(data)
    lengths = [max(t.units, t.summed) / t.scale for t in m.tracks if t.scale]
    stated = max(m.units, m.fragment_units) / m.scale if m.scale else 0
    duration = stated or max(lengths, default=0)
    video = next((t for t in m.tracks if t.kind == b"vide"), None)
    facts = (None, None, None, None)
    if video is not None:
        rate = video.frames * video.scale / video.summed if video.summed else 0.0
        if video.frames >= 1 << 31:
            raise Broken(f"{video.frames} frames")
        facts = (*(video.entry if all(video.entry) else (video.width, video.height)), rate, video.frames)
    return (round(duration, 3) if duration else None, any(t.kind == b"soun" for t in m.tracks), *facts)


def _wave(data: Bytes) -> tuple:
    at, rate = 12, 0
    while at + 8 <= data.size:
        kind, size = unpack("<4sI", data.at(at, 8))
        if kind == b"fmt ":
            (rate,) = unpack("<I", data.at(at + 16, 4))
        elif kind == b"data":
            return (round(min(size, data.size - at - 8) / rate, 3) if rate else None, True, None, None, None, None)
        at += 8 + size + size % 2
    raise Broken("no sound in a wave file")


def facts(data: Bytes) -> tuple:
    """(duration, audio, width, height, rate, frames) of one file."""
    if data.size >= 12 and data.at(0, 4) == b"RIFF" and data.at(8, 4) == b"WAVE":
        return _wave(data)
    return _iso(data)


def headers(files: DataFrame, column: str = "path") -> DataFrame:
    """Files, by path or by content, with what their headers say and an ``error`` where they are broken."""
    return each_file(files, column, facts, SCHEMA, NAMES, (None,) * 6)


def probed(files: DataFrame) -> DataFrame:
    """As ``media.probed``, by headers alone."""
    return headers(files.select("path")).select(F.col("path").alias("source"), *NAMES)
