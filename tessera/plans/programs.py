"""The programs: sources, operators and sinks put together, each with its parameters.

``main`` runs one from a command line: ``python -m tessera.plans.programs NAME ...``.  Exit codes:
0 success, 1 a failure while running, 2 a wrong number or name (ERR4).
"""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions.answers import items
from tessera.operators import asr, consistency, layout, models, pages, sinks, tracks
from tessera.sources import catalog, containers, files, media, snapshot


def transcribe(spark: SparkSession, path: str, spec: models.ModelSpec, language: str | None = None, word_timestamps: bool = False, probe=None) -> DataFrame:
    """Media files to transcripts; silent ones never reach the model.  ``probe`` takes the place of a look at headers."""
    listed = files.listing(spark, path)
    found = (containers.probed(listed) if probe is None else media.probed(listed, probe)).select("source", "duration_seconds", "audio_present")
    return asr.transcribed(found, spec.name, models.transcriber(spec, language, word_timestamps))


def parse_pdfs(spark: SparkSession, path: str, spec: models.ModelSpec, count: Callable[[str], int] | None = None, selection: str = "all", mode: str = "layout_all", max_tokens: int = 8192, stop_on_first_error: bool = False, blank_page_ok: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, blocks, documents) of PDFs; pages are selected before any is answered."""
    S.positive(max_tokens, "max_tokens")
    todo = media.pdf_pages(files.pdfs(spark, path), count, selection)
    if stop_on_first_error:
        answers = models.answered_until_failure(todo, spec, lambda a: blank_page_ok or bool(items(a)), mode=mode, max_tokens=max_tokens)
    else:
        answers = models.answered(todo, spec, mode=mode, max_tokens=max_tokens)
    done = pages.parsed(answers, blank_page_ok)
    return done, pages.merged(done), pages.rollup(done)


def parse_document(spark: SparkSession, path: str, spec: models.ModelSpec, mode: str = "layout_all", max_tokens: int = 8192) -> DataFrame:
    """Page images to blocks; an answer without items is no failure here (ERR5)."""
    images = files.images(spark, path).select(F.col("path").alias("doc_id"), F.lit(1).alias("page"), F.col("path").alias("image"))
    return pages.parsed(models.answered(images, spec, mode=mode, max_tokens=max_tokens), blank_page_ok=True)


def score_images(images: DataFrame, texts: list[str], image_model: models.ModelSpec, text_model: models.ModelSpec, batch_size: int = 8) -> tuple[DataFrame, DataFrame]:
    """(scores, best matches) of images (image_id, image) with the texts of a request."""
    S.positive(batch_size, "batch_size")
    if not texts:
        raise ValueError("at least one text is needed")
    spark = images.sparkSession
    t = models.embedded(spark.createDataFrame(list(enumerate(texts)), "pos int, text string"), text_model, "text", batch_size, "text_embedding")
    i = models.embedded(images, image_model, "image", batch_size, "image_embedding")
    scores = consistency.scored(consistency.pairs(i, t)).select("image_id", "pos", "text", "cosine_similarity", "consistency_score")
    return scores, consistency.best_match(scores)


def estimate_hands(videos: DataFrame, detector: models.ModelSpec, pose: models.ModelSpec, confidence: float = 0.2, max_gap: int = tracks.MAX_GAP, chunk_batch: int = 4, max_frames: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(frame records, counts) of videos (video, width, height, fps, frame_count)."""
    S.not_negative(max_gap, "max_gap")
    S.positive(chunk_batch, "chunk_batch")
    v = media.usable_videos(videos, None if max_frames is None else S.positive(max_frames, "max_frames"))
    raw = models.tracked(tracks.spine(v).select("video", "frame_index"), detector)
    keys = ["video", "hand"]
    best = tracks.best(tracks.detections(raw, confidence), [*keys, "frame_index"], "score", "track_id")
    dense = tracks.boxes_interpolated(best, keys, max_gap=max_gap)
    out = models.posed(tracks.chunked(dense, keys), pose, keys, chunk_batch)
    joints = tracks.unchunked(out, keys).select(*keys, "frame_index", "outputs.keypoints_2d", "outputs.keypoints_3d")
    return tracks.frame_records(v, dense, joints), tracks.hand_counts(best)


def summarise_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes below a root; an empty snapshot is an error."""
    found = files.listing(spark, root).select(F.lit(root).alias("dataset"), "path", "length")
    return catalog.require_files(catalog.dataset_summary(found, ["dataset"]))


def validate_bundles(spark: SparkSession, root: str) -> DataFrame:
    f = files.listing(spark, root, content=True)
    return catalog.bundles(f.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "content"))


def write_documents(blocks: DataFrame, root: str, model: str = "") -> DataFrame:
    """An HTML file for each document of block rows."""
    html = layout.blocks_to_html(blocks, model=model)
    name = F.concat(F.regexp_extract("doc_id", r"([^/]+)$", 1), F.lit(".html"))
    return sinks.write_files(sinks.unique_names(html.select(name.alias("name"), F.col("html").alias("content")), "name"), root)


def _loaded(what: str):
    """The object that ``module:name`` stands for: a model's factory, a fetcher, a job."""
    module, _, name = what.partition(":")
    if not module or not name:
        raise ValueError(f"MODULE:NAME is needed, not {what!r}")
    return getattr(importlib.import_module(module), name)


def _model(args: argparse.Namespace, option: str = "model") -> models.ModelSpec:
    what = getattr(args, option)
    return models.ModelSpec(what, _loaded(what), cache=args.model_cache, accelerators=args.accelerators)


def _transcribe(spark, a):
    return transcribe(spark, a.root, _model(a), a.language, a.word_timestamps)


def _parse_pdfs(spark, a):
    return parse_pdfs(spark, a.root, _model(a), None, a.pages, a.mode, a.max_tokens, a.stop_on_first_error, a.blank_page_ok)[1]


def _parse_document(spark, a):
    return pages.merged(parse_document(spark, a.root, _model(a), a.mode, a.max_tokens))


def _score_images(spark, a):
    images = files.images(spark, a.root).select(F.col("path").alias("image_id"), F.col("path").alias("image"))
    return score_images(images, a.text, _model(a), _model(a, "text_model"), a.batch_size)[0]


def _estimate_hands(spark, a):
    found = containers.probed(files.listing(spark, a.root)).withColumnRenamed("source", "video")
    return estimate_hands(found, _model(a), _model(a, "pose_model"), a.confidence, a.max_gap, a.chunk_batch, a.max_frames)[0]


def _download_dataset(spark, a):
    listed = spark.read.schema("path string, size long").json(a.root)
    done = snapshot.download(listed, a.out, a.revision, _loaded(a.fetch), a.workers, force=a.force)
    return spark.createDataFrame([(a.out, done["parts"], done["files"])], "dataset string, parts long, files long")


def _video_formats(spark, a):
    return catalog.best_format(spark.read.schema("video_id string, format_id string, kind string, height int, fps double, protocol string").json(a.root))


def _run_scenes(spark, a):
    return sinks.run_jobs(spark.read.schema("name string, prompt string, script string").json(a.root), a.out, _loaded(a.job))


#: Programs by name: what runs, and its own options; every one has a root, a limit, a model cache and accelerators.
_MODEL = {"--model": {"required": True, "help": "MODULE:FACTORY"}}
_ANSWERS = _MODEL | {"--mode": {"default": "layout_all"}, "--max-tokens": {"type": int, "default": 8192}}
PROGRAMS = {
    "dataset-summary": (lambda spark, a: summarise_datasets(spark, a.root), {}),
    "validate-bundles": (lambda spark, a: validate_bundles(spark, a.root), {}),
    "transcribe": (_transcribe, _MODEL | {"--language": {}, "--word-timestamps": {"action": "store_true"}}),
    "parse-pdf": (_parse_pdfs, _ANSWERS | {"--pages": {"default": "all"}, "--stop-on-first-error": {"action": "store_true"}, "--blank-page-ok": {"action": "store_true"}}),
    "parse-document": (_parse_document, _ANSWERS),
    "score-images": (_score_images, _MODEL | {"--text-model": {"required": True}, "--text": {"action": "append", "required": True}, "--batch-size": {"type": int, "default": 8}}),
    "estimate-hands": (_estimate_hands, _MODEL | {"--pose-model": {"required": True}, "--confidence": {"type": float, "default": 0.2}, "--max-gap": {"type": int, "default": tracks.MAX_GAP}, "--chunk-batch": {"type": int, "default": 4}, "--max-frames": {"type": int}}),
    "download-dataset": (_download_dataset, {"--out": {"required": True}, "--revision": {"default": "main"}, "--fetch": {"required": True}, "--workers": {"type": int, "default": snapshot.WORKERS}, "--force": {"action": "store_true"}}),
    "video-formats": (_video_formats, {}),
    "run-scenes": (_run_scenes, {"--out": {"required": True}, "--job": {"required": True}}),
}
#: Options that must be above 0, and those that must not be below it.
POSITIVE, NOT_NEGATIVE = ("limit", "max_tokens", "batch_size", "chunk_batch", "max_frames", "workers"), ("max_gap", "accelerators")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run a program and print its rows as JSON.")
    programs = parser.add_subparsers(dest="program", required=True)
    for name, (_, options) in PROGRAMS.items():
        own = programs.add_parser(name)
        own.add_argument("root")
        own.add_argument("--limit", type=int, default=1000, help="rows to print, 1 at least")
        own.add_argument("--model-cache")
        own.add_argument("--accelerators", type=float, default=0.0)
        for option, how in options.items():
            own.add_argument(option, **how)
    args = parser.parse_args(argv)
    try:
        for names, check in ((POSITIVE, S.positive), (NOT_NEGATIVE, S.not_negative)):
            for n in names:
                if getattr(args, n, None) is not None:
                    check(getattr(args, n), "--" + n.replace("_", "-"))
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.getOrCreate()
    try:
        for row in PROGRAMS[args.program][0](spark, args).toJSON().take(args.limit):
            print(row)
    except Exception as e:  # noqa: BLE001 - a command reports and returns its code
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
