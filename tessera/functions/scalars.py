"""Scalar functions: Column -> Column, inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must agree on.
VIDEO_ID = r"^[A-Za-z0-9_-]{11}\z"
HUB_HOSTS = ("huggingface.co", "www.huggingface.co")
HUB_SEGMENT = r"^[A-Za-z0-9]([A-Za-z0-9._-]{0,94}[A-Za-z0-9])?\z"
PNG_SIGNATURE = "89504E470D0A1A0A"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
JOINT_NAMES = (
    "wrist",
    "thumb_mcp", "thumb_pip", "thumb_dip", "thumb_tip",
    "index_mcp", "index_pip", "index_dip", "index_tip",
    "middle_mcp", "middle_pip", "middle_dip", "middle_tip",
    "ring_mcp", "ring_pip", "ring_dip", "ring_tip",
    "pinky_mcp", "pinky_pip", "pinky_dip", "pinky_tip",
)


def strip(c: Column) -> Column:
    """Without white space of any script at both ends; ``trim`` drops spaces only."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def html_escape(c: Column) -> Column:
    """The five characters of HTML, the ampersand first."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), ESCAPES, c)


def text_lines(c: Column) -> Column:
    """Lines as every line boundary of Unicode ends them, without a last empty one."""
    return F.split(F.regexp_replace(c, "(\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ])\\z", ""), "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")


def bbox(c: Column) -> Column:
    """Four numbers, rounded to two places, or null; numeric strings are numbers."""
    numbers = F.transform(c, lambda x: x.try_cast("double"))
    return F.when((F.size(c) == 4) & F.forall(numbers, lambda x: x.isNotNull()), F.transform(numbers, lambda x: F.bround(x, 2)))


def suffix(path: Column) -> Column:
    """The last suffix of a path, with its dot, in lower case; empty for none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)$", 1))


def stem(path: Column) -> Column:
    """A path without its last suffix."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", "")


def output_name(path: Column, kind: str) -> Column:
    """Where a program writes by default: the stem with another suffix (SNK10)."""
    return F.concat(stem(path), F.lit(kind))


def page_name(page: Column, kind: str = ".png") -> Column:
    return F.format_string(f"page-%04d{kind}", page)


def frame_name(frame: Column) -> Column:
    return F.format_string("%08d.jpg", frame)


def is_video_id(c: Column) -> Column:
    return F.coalesce(c.rlike(VIDEO_ID), F.lit(False))


def hub_dataset_id(c: Column) -> Column:
    """A dataset id from an id or a hub URL, null where it is neither.

    Under a URL the parts behind ``datasets`` count, two at most, whatever they are.
    """
    v = strip(c)
    is_url = v.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^//")
    host = F.lower(F.try_parse_url(v, F.lit("HOST")))
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(v, F.lit("PATH")), F.lit("")), "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x))
    good = (F.lower(F.try_parse_url(v, F.lit("PROTOCOL"))) == "https") & host.isin(*HUB_HOSTS) & (F.size(parts) >= 2) & (F.try_element_at(parts, F.lit(1)) == "datasets")
    named = F.when(is_url, F.when(good, F.array_join(F.slice(parts, 2, 2), "/"))).otherwise(F.regexp_replace(v, "^/+|/+$", ""))
    pieces = F.split(named, "/")
    return F.when((F.size(pieces) <= 2) & F.forall(pieces, lambda x: x.rlike(HUB_SEGMENT)), named)


def local_dataset_dir(dataset: Column, root: str) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.replace(dataset, F.lit("/"), F.lit("--")))


def png_size(content: Column) -> Column:
    """(width, height) of a PNG's header; null where it isn't one or a side is 0."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("long")
    width, height = number(17), number(21)
    ok = (F.length(content) >= 24) & (F.hex(F.substring(content, 1, 8)) == PNG_SIGNATURE) & (width > 0) & (height > 0)
    return F.when(ok, F.struct(width.alias("width"), height.alias("height")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """In doubles; null where a norm is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def focal_length(value: Column, width: Column, height: Column) -> Column:
    """The value, or the diagonal of the image for null and 0."""
    return F.coalesce(F.nullif(value.cast("double"), F.lit(0.0)), F.hypot(width.cast("double"), height.cast("double")))


def frame_rate(fps: Column) -> Column:
    return F.when(fps == 0, F.lit(30.0)).otherwise(fps.cast("double"))


def frame_count(count: Column, most: int | None = None) -> Column:
    return count if most is None else F.least(count, F.lit(most))


def timestamp_seconds(frame: Column, fps: Column) -> Column:
    return F.bround(frame / fps, 6)


def project(x: Column, y: Column, z: Column, focal: Column, cx: Column, cy: Column) -> Column:
    """Pinhole projection of a camera-space point to pixels; null where the depth is 0."""
    return F.struct(F.bround(focal * F.try_divide(x, z) + cx, 4).alias("u"), F.bround(focal * F.try_divide(y, z) + cy, 4).alias("v"))


def mirror_axis_angle(rotation: Column) -> Column:
    """Rotations (x, y, z) of a right hand as those of a left one."""
    return F.transform(rotation, lambda r: F.array(r[0], -r[1], -r[2]))


def translate(points: Column, by: Column) -> Column:
    return F.transform(points, lambda p: F.zip_with(p, by, lambda a, b: F.bround(a + b, 6)))


def downscaled(width: Column, height: Column, most: int) -> Column:
    """Sides of an image whose longest one is to fit ``most``; 0 and less leave it."""
    longest = F.greatest(width, height)
    fit = lambda side: F.greatest(F.lit(1), F.bround(side * (F.lit(float(most)) / longest)).cast("int"))
    small = F.lit(most <= 0) | (longest <= most)
    return F.struct(F.when(small, width).otherwise(fit(width)).alias("width"), F.when(small, height).otherwise(fit(height)).alias("height"))


def srgb_linear(colour: Column) -> Column:
    """Linear red, green, blue and alpha of a colour in hexadecimal."""
    value = F.ltrim(colour, F.lit("#"))

    def channel(at: int) -> Column:
        c = F.conv(F.substring(value, at, 2), 16, 10).cast("double") / 255
        return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))

    return F.array(channel(1), channel(3), channel(5), F.lit(1.0))


def even_offsets(count: Column | int, width: float, gap: float) -> Column:
    """Centres of ``count`` planks (1 at least) of that width, evenly spaced around 0."""
    step, last = width + gap, (F.lit(count) if isinstance(count, int) else count) - 1
    return F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda k: F.bround((k - last / 2) * step, 6))


def corners(x: float, y: float) -> Column:
    """The four sign combinations of a point, as legs stand under a table."""
    return F.array(*[F.array(F.lit(sx * x), F.lit(sy * y)) for sx in (-1, 1) for sy in (-1, 1)])


def null_nan(c: Column, places: int) -> Column:
    return F.when(c.isNull() | F.isnan(c), None).otherwise(F.bround(c, places))


def resolved(argument: str | None, environment: str | None, default: str) -> str:
    """The model that a run uses: the argument, else the environment's, else the default."""
    for value in (argument, environment):
        if value and value.strip():
            return value.strip()
    return default


def positive(value: int, name: str = "value") -> int:
    """A whole number of 1 at least, or ``ValueError`` (FLT7)."""
    if int(value) < 1:
        raise ValueError(f"{name} must be at least 1")
    return int(value)


def not_negative(value: int, name: str = "value") -> int:
    if int(value) < 0:
        raise ValueError(f"{name} must not be negative")
    return int(value)
