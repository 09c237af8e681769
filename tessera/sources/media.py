"""Media sources that need a codec: probes, page images and frames, by injected readers.

Spark plans what is to be read (which pages, which frames, what a missing value means); a reader
does what needs a library.  Headers of media and structures of PDFs need none: see ``containers`` and
``pdf``.  ``ffprobe`` can be asked where it is installed, for other formats.
"""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import frame_name, frame_rate, page_name
from tessera.operators.pages import page_list
from tessera.sources import pdf, tools

PDF_DPI, PAGE_DPI = 150, 200


def ffprobe(path: str, timeout: int = 60, explicit: str | None = None) -> dict:
    """Duration, streams and geometry of one file; empty where the tool is missing or fails.  A path given must exist."""
    try:
        found = tools.tool("ffprobe", explicit)
    except FileNotFoundError:
        if explicit is not None:
            raise
        return {}
    try:
        done = subprocess.run([found, "-v", "error", "-show_format", "-show_streams", "-of", "json", path], capture_output=True, text=True, timeout=timeout, check=False)
        return json.loads(done.stdout) if done.returncode == 0 else {}
    except (OSError, ValueError, subprocess.SubprocessError):
        return {}


def _facts(raw: dict) -> dict:
    streams = raw.get("streams")
    video = next((s for s in streams or [] if s.get("codec_type") == "video"), {})

    def number(x, kind=float):
        try:
            return kind(x)
        except (TypeError, ValueError):
            return None

    rate = str(video.get("avg_frame_rate", "0/1")).partition("/")
    top, bottom = number(rate[0]), number(rate[2] or 1)
    duration = number(raw.get("format", {}).get("duration"))
    return {
        "duration_seconds": None if duration is None else round(duration, 3),
        "audio_present": None if streams is None else any(s.get("codec_type") == "audio" for s in streams),
        "width": number(video.get("width"), int), "height": number(video.get("height"), int),
        "fps": (top or 0.0) / bottom if bottom else 0.0, "frame_count": number(video.get("nb_frames"), int),
    }


def probed(files: DataFrame, probe: Callable[[str], dict] = ffprobe) -> DataFrame:
    """Media with duration, audio and geometry in one pass; what is unknown is null (SRC17 to SRC19)."""
    schema = "source string, duration_seconds double, audio_present boolean, width int, height int, fps double, frame_count int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([{"source": p, **_facts(probe(p))} for p in b["path"]], columns=["source", "duration_seconds", "audio_present", "width", "height", "fps", "frame_count"]).astype({"width": "Int32", "height": "Int32", "frame_count": "Int32"})

    return files.select("path").mapInPandas(run, schema)


def usable_videos(media: DataFrame, max_frames: int | None = None) -> DataFrame:
    """Videos with sides and frames above 0; a rate of 0 counts as 30 (SRC19, FLT6, LIM1)."""
    count = F.col("frame_count") if max_frames is None else F.least(F.col("frame_count"), F.lit(max_frames))
    return media.withColumn("fps", frame_rate(F.col("fps"))).withColumn("frame_count", count).where((F.col("width") > 0) & (F.col("height") > 0) & (F.col("frame_count") > 0))


def pdf_pages(pdfs: DataFrame, count: Callable[[str], int] | None = None, spec: str = "all") -> DataFrame:
    """A row for each selected page of each PDF, with the name of its image (SRC13, STR3).

    Pages are counted by the file's own structure, or by a reader that is given; a file that can't be counted is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["path"], "pages": [count(p) for p in b["path"]]})

    if count is None:
        told = F.coalesce(F.col("pages"), F.raise_error(F.concat_ws(": ", "path", "error")).cast("int"))
        counted = pdf.page_counts(pdfs.select("path")).select(F.col("path").alias("doc_id"), told.alias("pages"))
    else:
        counted = pdfs.select("path").mapInPandas(run, "doc_id string, pages int")
    rows = counted.select("doc_id", "pages", F.explode(page_list(F.lit(spec), F.col("pages"))).alias("page"))
    return rows.withColumn("image", page_name(F.col("page")))


def rasterised(pages: DataFrame, render: Callable[[str, int, int, int], bytes], dpi: int = PDF_DPI, max_side: int = 0, parts: int | None = None) -> DataFrame:
    """Pages with their image as bytes; pages are dealt out evenly first (SRC14, SRC15)."""
    names = pages.columns
    dealt = pages.repartition(parts, "doc_id", "page") if parts else pages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(content=[render(d, p, dpi, max_side) for d, p in zip(b["doc_id"], b["page"], strict=True)])

    return dealt.mapInPandas(run, ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names) + ", content binary")


def frames(videos: DataFrame, decode: Callable[[str, int], Iterator[bytes]]) -> DataFrame:
    """A row for each frame of each video, with the name of its image (SRC20).

    A video is decoded front to back by one task; one that ends early is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for source, n in zip(b["source"], b["frame_count"], strict=True):
                k = -1
                for k, data in enumerate(decode(source, int(n))):
                    yield pd.DataFrame({"video": [source], "frame_index": [k], "content": [data]})
                if k + 1 < n:
                    raise ValueError(f"{source} ended after {k + 1} of {n} frames")

    return videos.select("source", "frame_count").mapInPandas(run, "video string, frame_index int, content binary").withColumn("name", frame_name(F.col("frame_index")))
