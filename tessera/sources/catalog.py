"""Catalogues: identifiers, format choice, dataset summaries, required assets, bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import hub_dataset_id, is_video_id, local_dataset_dir, png_size, strip, suffix
from tessera.sources.files import outside_cache

# Fixed values that results must agree on.
MOST_HEIGHT, MOST_FPS = 1080, 60
VIDEO_SUFFIXES = (".mp4", ".mkv", ".webm")
REQUIRED_ASSETS = (
    "weights/external/detector.pt",
    "weights/hawor/model_config.yaml",
    "weights/hawor/checkpoints/hawor.ckpt",
    "_DATA/data/mano/MANO_RIGHT.pkl",
    "_DATA/data_left/mano_left/MANO_LEFT.pkl",
)
BUNDLE_PARTS = ("non-empty prompt.txt", "scene.py", "a .blend scene", "a PNG render")


def video_ids(rows: DataFrame, c: str = "raw") -> DataFrame:
    """Rows with whether their value is a video id (SRC6, STR2)."""
    return rows.withColumn("is_valid", is_video_id(F.col(c)))


def datasets(rows: DataFrame, root: str, c: str = "raw") -> DataFrame:
    """Rows with the dataset id and where its snapshot lies, null where there is none (SRC9, SRC11)."""
    d = rows.withColumn("dataset", hub_dataset_id(F.col(c)))
    return d.withColumn("local_dir", local_dataset_dir(F.col("dataset"), root))


def fetched(rows: DataFrame, fetch, schema: str) -> DataFrame:
    """Rows that an injected fetcher makes of each batch (SRC7, SRC10): network stays in it."""
    return rows.mapInPandas(fetch, schema)


def format_tier() -> list[tuple[bool, Column]]:
    """The six tiers, best first: (a video and an audio stream, what its video must meet) (RANK4)."""
    low, slow, https = F.col("height") <= MOST_HEIGHT, F.col("fps") <= MOST_FPS, F.col("protocol") == "https"
    return [(True, low & slow & https), (False, low & slow & https), (True, low & slow), (False, low & slow), (True, low), (False, low)]


def best_format(formats: DataFrame, video: str = "video_id") -> DataFrame:
    """The format of each video: the first tier it can meet, then height and frame rate.

    ``formats``: video, format_id, kind (video, audio, combined), height, fps, protocol.  Audio is
    at hand where the tier's protocol allows one.  A row for each video that any tier serves.
    """
    audio_https = F.max((F.col("kind") == "audio") & (F.col("protocol") == "https")).over(Window.partitionBy(video))
    audio = F.max(F.col("kind") == "audio").over(Window.partitionBy(video))
    f = formats.withColumn("_ah", audio_https).withColumn("_a", audio)
    tier = None
    for k, (apart, meets) in enumerate(format_tier()):
        has = (F.col("kind") == "video") & F.col("_ah" if k < 2 else "_a") if apart else F.col("kind") == "combined"
        ok = has & meets
        tier = F.when(ok, k + 1) if tier is None else tier.when(ok, k + 1)
    rank = Window.partitionBy(video).orderBy("tier", F.col("height").desc(), F.col("fps").desc_nulls_last(), "format_id")
    out = f.withColumn("tier", tier).where(F.col("tier").isNotNull()).withColumn("_r", F.row_number().over(rank)).where("_r = 1")
    return out.select(video, "format_id", "tier", "height", "fps")


def downloaded_file(candidates: DataFrame, files: DataFrame, video: str = "video_id") -> DataFrame:
    """Which file a download left (SRC8): the first candidate that exists, else the newest with the id.

    ``candidates``: video, pos, path.  ``files``: path, modification_time.
    """
    first = candidates.join(files, "path").groupBy(video).agg(F.min_by("path", "pos").alias("first"))
    ids = candidates.select(video).distinct()
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    # the id is the part of the name that a downloader puts before the suffix, in brackets or bare
    named = files.where(suffix(F.col("path")).isin(*VIDEO_SUFFIXES)).withColumn(video, F.regexp_extract(name, r"([A-Za-z0-9_-]{11})\]?\.[^.]+$", 1))
    newest = named.groupBy(video).agg(F.max(F.struct("modification_time", "path")).alias("m")).select(video, F.col("m.path").alias("newest"))
    out = ids.join(first, video, "left").join(newest, video, "left")
    return out.select(video, F.coalesce("first", "newest").alias("path"))


def dataset_summary(files: DataFrame, keys: list[str], path: str = "path", length: str = "length") -> DataFrame:
    """Number and bytes of the files of each dataset, its cache left out (AGG3, SRC12)."""
    return files.where(outside_cache(F.col(path))).groupBy(*keys).agg(F.count("*").alias("file_count"), F.sum(length).alias("total_bytes"))


def require_files(summary: DataFrame) -> DataFrame:
    """The summary, or an error for an empty snapshot."""
    if summary.isEmpty():
        raise ValueError("the dataset has no files")
    return summary


def missing_assets(present: DataFrame, roots: DataFrame, required: tuple[str, ...] = REQUIRED_ASSETS) -> DataFrame:
    """(root, asset) for each required file that a root lacks, all of them at once (SRC24, JOIN6, SET3)."""
    wanted = roots.select("root", F.explode(F.array(*[F.lit(r) for r in required])).alias("asset"))
    return wanted.join(present.select("root", "asset"), ["root", "asset"], "left_anti")


def bundles(files: DataFrame) -> DataFrame:
    """Each folder's bundle: what it lacks, its scenes and renders with their sizes (AGG6, SRT3).

    ``files``: dir, name, length, content (of the prompt and of PNG files).
    """
    has = lambda cond: F.coalesce(F.bool_or(cond), F.lit(False))
    kind = suffix(F.col("name"))
    prompt = has((F.col("name") == "prompt.txt") & (strip(F.col("content").cast("string")) != ""))
    code = has((F.col("name") == "scene.py") & (F.col("length") > 0))
    size = png_size(F.col("content"))
    png = F.when(kind == ".png", F.struct("name", size["width"].alias("width"), size["height"].alias("height")))
    out = files.groupBy("dir").agg(prompt.alias("p"), code.alias("c"), has(kind == ".blend").alias("b"), has(kind == ".png").alias("r"), F.array_sort(F.collect_list(F.when(kind == ".blend", F.col("name")))).alias("blend_files"), F.array_sort(F.collect_list(png)).alias("renders"))
    lacks = F.array_compact(F.array(*[F.when(~F.col(k), F.lit(name)) for k, name in zip("pcbr", BUNDLE_PARTS, strict=True)]))
    return out.select("dir", (F.size(lacks) == 0).alias("complete"), lacks.alias("missing"), "blend_files", "renders")
