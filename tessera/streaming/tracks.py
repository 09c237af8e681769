"""Track segments over a stream: the gap rule of tracks as sessions, and a stateful tracker.

A detection stream has an event time; a track's segment is a session whose gap is the longest
that may be missing.  State is a session for each open track, and a watermark closes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.tracks import MAX_GAP


def timed(frames: DataFrame, seconds_per_frame: float = 1.0) -> DataFrame:
    """Frames with an event time; ``withWatermark`` takes timestamps with a zone only."""
    return frames.withColumn("at", F.timestamp_seconds(F.col("frame_index") * seconds_per_frame))


def stream_segments(detections: DataFrame, track: list[str], max_gap: int = MAX_GAP, late_frames: int = 100) -> DataFrame:
    """(track, first_frame, last_frame, observed) of closed segments, for append mode.

    With a second a frame, a session ends where more than ``max_gap`` frames are missing.
    """
    t = timed(detections).withWatermark("at", f"{late_frames} seconds")
    # a session of gap g covers [t, t + g): frames g apart start anew, so the gap is one more than what may lie between
    window = F.session_window("at", f"{max_gap + 1} seconds 1 milliseconds")
    return t.groupBy(*track, window).agg(F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"), F.count("*").alias("observed")).drop("session_window")


def tracked_stream(frames: DataFrame, track: str = "video") -> DataFrame:
    """Track numbers that last over batches (MDL7's state): per video, the next number to give.

    A detection without a track of its class so far gets a number; state is one row a video.
    """

    def run(key: tuple, groups: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = dict(zip(*state.get, strict=True)) if state.exists else {}
        for g in groups:
            g = g.sort_values("frame_index", kind="stable")
            cls = g["cls"].astype("int64")
            for c in cls.unique():  # in the order in which classes appear
                seen.setdefault(int(c), len(seen))
            yield pd.DataFrame({track: key[0], "frame_index": g["frame_index"].astype("int32"), "cls": cls.astype("int32"), "track_id": cls.map(seen).astype("int32")})
        state.update((list(seen), list(seen.values())))

    return frames.groupBy(track).applyInPandasWithState(run, f"{track} string, frame_index int, cls int, track_id int", "classes array<int>, numbers array<int>", "append", "NoTimeout")
