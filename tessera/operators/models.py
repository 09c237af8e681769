"""Model inference behind an injectable handle.

A ``ModelSpec`` carries a factory to the executors; each Python worker makes its handle once, on
first use, and keeps it (``spark.python.worker.reuse``).  A row whose call fails becomes a row
with an error; no task fails by it.  What needs hardware or a download is the factory's business;
the fakes here are deterministic and stand in for it in tests.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import SEGMENT
from tessera.sources import tools

PROMPT_MODES = ("layout_all", "ocr", "layout_only")
DEVICES = ("auto", "cpu", "mps", "cuda")
#: Chunks whose keypoints leave a worker together.
POSED = 128


class Handle(Protocol):
    def generate(self, item: Any, **options: Any) -> Any: ...


@dataclass(frozen=True)
class ModelSpec:
    """A model by name and how to load it (MDL3, MDL4).

    ``config`` names a stored configuration, which is fixed up and given to the factory as well (MDL9);
    ``cache`` is the folder that the worker's environment names before the factory runs (MDL12);
    ``accelerators`` is what a task of the model's stage asks for (MDL10).
    """

    name: str
    factory: Callable[..., Any]
    options: dict[str, Any] = field(default_factory=dict)
    config: str | None = None
    cache: str | None = None
    accelerators: float = 0.0


_HANDLES: dict[str, Any] = {}


def handle(spec: ModelSpec) -> Any:
    if spec.name not in _HANDLES:
        if spec.cache is not None:
            tools.cache_environment(spec.cache)
        given = (spec.name,) if spec.config is None else (spec.name, tools.stored_config(spec.config))
        _HANDLES[spec.name] = spec.factory(*given)
    return _HANDLES[spec.name]


def profile(spec: ModelSpec, resource: str = "gpu") -> ResourceProfile | None:
    """What the stage of a model's calls asks of executors and tasks; None where it needs no accelerator.

    Only that stage runs on such executors; the cluster manager must be one that knows stage profiles.
    """
    if not spec.accelerators:
        return None
    executors = ExecutorResourceRequests().resource(resource, max(1, math.ceil(spec.accelerators)))
    return ResourceProfileBuilder().require(executors).require(TaskResourceRequests().resource(resource, spec.accelerators)).build


def release(spec: ModelSpec) -> None:
    """Let a handle drop what it caches between items; never fatal (MDL11)."""
    clear = getattr(_HANDLES.get(spec.name), "clear_cache", None)
    if clear is not None:
        try:
            clear()
        except Exception:  # noqa: BLE001
            return


def pick_device(wanted: str, available: tuple[str, ...] = ("cpu",)) -> str:
    """The device asked for, if it is there; for ``auto`` cuda, mps, cpu in that order (MDL10)."""
    if wanted not in DEVICES:
        raise ValueError(f"unknown device: {wanted}")
    if wanted == "auto":
        return next(d for d in ("cuda", "mps", "cpu") if d in available or d == "cpu")
    if wanted != "cpu" and wanted not in available:
        raise RuntimeError(f"{wanted} is not available")
    return wanted


def prompt_mode(mode: str) -> str:
    if mode not in PROMPT_MODES:
        raise ValueError(f"unknown prompt mode: {mode}")
    return mode


def _captured(call: Callable[[Any], Any], item: Any) -> tuple[Any, str | None]:
    try:
        return call(item), None
    except Exception as e:  # noqa: BLE001 - one bad item must not stop the others
        return None, f"{type(e).__name__}: {e}"


def answered(pages: DataFrame, spec: ModelSpec, item: str = "image", mode: str = "layout_all", max_tokens: int = 8192) -> DataFrame:
    """Pages with ``answer`` and ``error`` of a vision-language model (MDL2, ERR1)."""
    prompt_mode(mode)
    names = pages.columns
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names) + ", answer string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            model = handle(spec)
            got = []
            for x in b[item]:
                got.append(_captured(lambda v: model.generate(v, prompt_mode=mode, max_tokens=max_tokens), x))
                release(spec)
            yield b.assign(answer=[g[0] for g in got], error=[g[1] for g in got])

    return pages.mapInPandas(run, schema, profile=profile(spec))


def answered_until_failure(pages: DataFrame, spec: ModelSpec, ok: Callable[[str], bool], doc: str = "doc_id", item: str = "image", mode: str = "layout_all", max_tokens: int = 8192) -> DataFrame:
    """As ``answered``, but a document's pages go one after another and end with the first that
    fails, so that no further call is made (ERR3).  Only the document at hand is remembered.
    """
    names = pages.columns
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names) + ", answer string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, stopped = object(), False
        for b in batches:
            model, rows = handle(spec), []
            for r in b.to_dict("records"):
                if r[doc] != current:
                    current, stopped = r[doc], False
                if stopped:
                    continue
                answer, error = _captured(lambda v: model.generate(v, prompt_mode=mode, max_tokens=max_tokens), r[item])
                rows.append({**r, "answer": answer, "error": error})
                stopped = error is not None or not ok(answer)
            yield pd.DataFrame(rows, columns=[*names, "answer", "error"])

    return pages.repartition(doc).sortWithinPartitions(doc, "page").mapInPandas(run, schema, profile=profile(spec))


def transcriber(spec: ModelSpec, language: str | None = None, word_timestamps: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Speech to text of media rows (MDL1): adds text, language and segments."""

    def infer(media: DataFrame) -> DataFrame:
        names = [c for c in media.columns if c not in ("text", "language", "segments")]
        schema = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in names) + ", raw string"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                model = handle(spec)
                yield b.assign(raw=[json.dumps(model.generate(x, language=language, word_timestamps=word_timestamps)) for x in b["source"]])

        out = media.select(*names).mapInPandas(run, schema, profile=profile(spec))
        parsed = F.from_json("raw", f"text string, language string, segments array<{SEGMENT}>")
        return out.withColumn("_p", parsed).select(*names, "_p.text", "_p.language", "_p.segments")

    return infer


def embedded(rows: DataFrame, spec: ModelSpec, item: str, batch_size: int = 8, out: str = "embedding") -> DataFrame:
    """Rows with the embedding of their text or image, in batches (MDL5, MDL6, WIN7, PRJ7)."""
    names = rows.columns
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + f", `{out}` array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            model, got = handle(spec), []
            for at in range(0, len(b), batch_size):
                got += [pooled(x) for x in model.generate(list(b[item].iloc[at : at + batch_size]))]
            yield b.assign(**{out: got})

    return rows.mapInPandas(run, schema, profile=profile(spec))


def pooled(output: Any) -> list[float]:
    """The vector in what an encoder returns: a tuple's first, then its pooled output (PRJ7)."""
    if isinstance(output, tuple):
        output = output[0]
    output = getattr(output, "pooler_output", output)
    return [float(x) for x in output]


def tracked(frames: DataFrame, spec: ModelSpec, video: str = "video") -> DataFrame:
    """Detections of a tracker that keeps state over the frames of a video (MDL7).

    The frames of a video come to one task in order; it holds one tracker and a batch of them.
    """
    columns = ["video", "frame_index", "cls", "bbox_xyxy", "score", "track_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, model = object(), None
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                if r[video] != current:  # a tracker's state belongs to one video
                    current, model = r[video], spec.factory(spec.name)
                rows += [{"video": current, "frame_index": r["frame_index"], **d} for d in model.generate(r)]
            yield pd.DataFrame(rows, columns=columns)

    ordered = frames.repartition(video).sortWithinPartitions(video, "frame_index")
    return ordered.mapInPandas(run, "video string, frame_index int, cls int, bbox_xyxy array<float>, score float, track_id int", profile=profile(spec))


def posed(chunks: DataFrame, spec: ModelSpec, keys: list[str], batch: int = 4) -> DataFrame:
    """Keypoints of every frame of chunks of 16 (MDL8, WIN7); chunks don't depend on one another.

    A worker holds the keypoints of ``POSED`` chunks, or of one batch, whatever a task's batches are.
    """
    names = [*keys, "frame_indices", "boxes", "valid_count"]
    schema = ", ".join(f"`{c}` {chunks.schema[c].dataType.simpleString()}" for c in names) + ", outputs array<struct<keypoints_2d: array<array<double>>, keypoints_3d: array<array<double>>>>"

    size = max(1, POSED // batch) * batch

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            model = handle(spec)
            for start in range(0, len(b), size):
                part, got = b.iloc[start : start + size], []
                for at in range(0, len(part), batch):
                    got += model.generate(part.iloc[at : at + batch].to_dict("records"))
                yield part[names].assign(outputs=got)

    return chunks.mapInPandas(run, schema, profile=profile(spec))


class FakePageModel:
    """A title and a text for each page, by the number in its name; ``bad`` in it fails."""

    def generate(self, image: str, prompt_mode: str = "layout_all", max_tokens: int = 8192) -> str:
        if "bad" in image:
            raise RuntimeError(f"cannot read {image}")
        if "blank" in image:
            return "nothing on this page"
        if "cites" in image:
            return "see [1]"
        return json.dumps([{"bbox": [0, 0, 10, 10], "category": "Title", "text": f"Title of {image}"}, {"bbox": [0, 10, 10, 20], "category": "Text", "text": f"Text of {image}"}])


class FakeEncoder:
    """A unit vector of eight numbers from the hash of a text."""

    def generate(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            raw = [b - 127.5 for b in hashlib.blake2b(str(t).encode(), digest_size=8).digest()]
            norm = sum(x * x for x in raw) ** 0.5
            out.append([x / norm for x in raw])
        return out


class FakeTranscriber:
    def generate(self, source: str, language: str | None = None, word_timestamps: bool = False) -> dict:
        words = [{"start": 0.0, "end": 1.0, "word": "hello"}] if word_timestamps else None
        return {"text": f"  speech of {source} ", "language": language or "en", "segments": [{"id": 0, "start": 0.0, "end": 1.0, "text": "hello", "words": words}]}


class FakeTracker:
    """The left hand in even frames and the right one in all; numbers its tracks as it goes."""

    def __init__(self):
        self.seen: dict[int, int] = {}

    def generate(self, frame: dict) -> list[dict]:
        k = int(frame["frame_index"])
        found = [(1, 0.9)] + ([(0, 0.8)] if k % 2 == 0 else [])
        return [{"cls": c, "bbox_xyxy": [float(k), float(k), float(k + 10), float(k + 10)], "score": s, "track_id": self.seen.setdefault(c, len(self.seen))} for c, s in found]


class FakePose:
    """All 21 joints of a frame at the middle of its box, at depth 1."""

    def generate(self, chunks: list[dict]) -> list[list[dict]]:
        out = []
        for c in chunks:
            mid = [((b[0] + b[2]) / 2, (b[1] + b[3]) / 2) for b in c["boxes"]]
            out.append([{"keypoints_2d": [[x, y]] * 21, "keypoints_3d": [[x, y, 1.0]] * 21} for x, y in mid])
        return out


def transcriber_factory(name: str) -> FakeTranscriber:
    return FakeTranscriber()


def tracker_factory(name: str) -> FakeTracker:
    return FakeTracker()


def pose_factory(name: str) -> FakePose:
    return FakePose()
