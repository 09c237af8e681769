"""Detections to tracks: best per frame, gap-aware segments, interpolation, chunks, assembly.

Rows are keyed by (video, hand, frame_index); one exchange by (video, hand) serves segmenting,
interpolation and chunking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import JOINT_NAMES, null_nan, timestamp_seconds

# Fixed values that results must agree on.
HANDS = ("left", "right")
MAX_GAP = 30
CHUNK = 16
EDGES = tuple((0 if k == 0 else 4 * f + k, 4 * f + k + 1) for f in range(5) for k in range(4))
BIG_JOINTS = (0, 4, 8, 12, 16, 20)


def detections(raw: DataFrame, confidence: float = 0.2) -> DataFrame:
    """Detector output with its class as a hand: other classes and low scores go (FLT2, FLT3)."""
    hand = F.when(F.col("cls") == 0, "left").when(F.col("cls") == 1, "right")
    return raw.where((F.col("score") >= confidence) & F.col("cls").isin(0, 1)).withColumn("hand", hand).drop("cls")


def best(rows: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The row of the greatest score for each key, of equals the first (AGG7).

    A limited window keeps one row a key on either side of the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def segmented(rows: DataFrame, track: list[str], frame: str = "frame_index", max_gap: int = MAX_GAP) -> DataFrame:
    """Add ``segment_id``: a new one where more than ``max_gap`` frames are missing (WIN3)."""
    w = Window.partitionBy(*track).orderBy(frame)
    gap = F.col(frame) - F.lag(frame).over(w) > max_gap + 1
    started = F.sum(F.when(gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("segment_id", started.cast("long"))


def interpolated(rows: DataFrame, track: list[str], values: list[str], frame: str = "frame_index", score: str | None = None) -> DataFrame:
    """Every frame of each segment: between observations the values run straight (WIN4, JOIN7)."""
    w = Window.partitionBy(*track, "segment_id").orderBy(frame)
    nxt = rows.withColumn("_next", F.lead(frame).over(w))
    for v in values:
        nxt = nxt.withColumn(f"_{v}", F.lead(v).over(w))
    span = nxt.withColumn("_at", F.explode(F.sequence(F.col(frame), F.coalesce(F.col("_next") - 1, F.col(frame)))))
    line = lambda v: F.when(F.col("_at") == F.col(frame), F.col(v).cast("double")).otherwise(F.col(v) + (F.col(f"_{v}") - F.col(v)) / (F.col("_next") - F.col(frame)) * (F.col("_at") - F.col(frame)))
    seen = F.col("_at") == F.col(frame)
    cols = [*track, "segment_id", F.col("_at").alias(frame), *[line(v).alias(v) for v in values], seen.alias("detected")]
    return span.select(*cols, *([F.when(seen, F.col(score)).alias(score)] if score else []))


def boxes_interpolated(rows: DataFrame, track: list[str], frame: str = "frame_index", max_gap: int = MAX_GAP) -> DataFrame:
    """Detections (track, frame, bbox_xyxy, score) to tracks with a box on every frame."""
    flat = segmented(rows, track, frame, max_gap).select(*track, "segment_id", frame, "score", *[F.col("bbox_xyxy")[k].cast("double").alias(f"b{k}") for k in range(4)])
    out = interpolated(flat, track, [f"b{k}" for k in range(4)], frame, "score")
    return out.select(*track, "segment_id", frame, F.array(*[F.col(f"b{k}") for k in range(4)]).alias("bbox_xyxy"), "detected", F.col("score").cast("double").alias("score"))


def chunked(rows: DataFrame, track: list[str], frame: str = "frame_index", value: str = "bbox_xyxy", size: int = CHUNK) -> DataFrame:
    """Segments in runs of ``size`` frames; the last run repeats its last frame (WIN5, ARR1)."""
    w = Window.partitionBy(*track, "segment_id").orderBy(frame)
    own = rows.withColumn("chunk_id", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    parts = own.groupBy(*track, "segment_id", "chunk_id").agg(F.array_sort(F.collect_list(F.struct(frame, value))).alias("m"))
    padded = F.concat(F.col("m"), F.array_repeat(F.element_at("m", -1), size - F.size("m")))
    return parts.select(*track, "segment_id", "chunk_id", F.transform(padded, lambda x: x[frame]).alias("frame_indices"), F.transform(padded, lambda x: x[value]).alias("boxes"), F.size("m").alias("valid_count"))


def unchunked(outputs: DataFrame, track: list[str], value: str = "outputs") -> DataFrame:
    """A row for each frame of a chunk's outputs, without those of its padding (WIN6)."""
    rows = outputs.select(*track, "valid_count", F.posexplode(F.arrays_zip("frame_indices", value)).alias("pos", "x"))
    return rows.where(F.col("pos") < F.col("valid_count")).select(*track, F.col("x.frame_indices").alias("frame_index"), F.col(f"x.{value}").alias(value))


def spine(videos: DataFrame, video: str = "video") -> DataFrame:
    """A row for each frame of each video, with its time (JOIN2, MTH7)."""
    frames = videos.where(F.col("frame_count") > 0).withColumn("frame_index", F.explode(F.sequence(F.lit(0), F.col("frame_count") - 1)))
    return frames.select(video, "frame_index", timestamp_seconds(F.col("frame_index"), F.col("fps")).alias("timestamp_seconds"))


def frame_records(videos: DataFrame, tracks: DataFrame, predictions: DataFrame, video: str = "video") -> DataFrame:
    """One record for each frame of each video, hands in order (JOIN1, JOIN2, PRJ6).

    A hand is there where both its track and its prediction are.  Exploded rows and keypoints are far more
    than Spark reckons from their files, so no side of these joins may be broadcast.
    """
    box = F.transform("bbox_xyxy", lambda x: F.bround(x, 4))
    both = tracks.hint("merge").join(predictions.hint("merge"), [video, "hand", "frame_index"]).select(video, "frame_index", F.struct(F.col("hand").alias("handedness"), box.alias("bbox_xyxy"), (~F.col("detected")).alias("bbox_interpolated"), null_nan(F.col("score"), 6).alias("detection_score"), "keypoints_2d", "keypoints_3d").alias("h"))
    hands = both.groupBy(video, "frame_index").agg(F.array_sort(F.collect_list("h")).alias("hands"))
    full = spine(videos, video).join(hands.hint("merge"), [video, "frame_index"], "left")
    return full.withColumn("hands", F.coalesce("hands", F.filter(F.col("hands"), lambda x: F.lit(False)), F.array()))


def hand_counts(rows: DataFrame, video: str = "video") -> DataFrame:
    """Frames of each hand (AGG5)."""
    return rows.groupBy(video).agg(*[F.count_if(F.col("hand") == h).alias(f"{h}_frames") for h in HANDS])


def skeleton(spark) -> DataFrame:
    """The 20 edges over 21 joints, each with its finger: a constant dimension."""
    return spark.createDataFrame([(k, a, b, k // 4) for k, (a, b) in enumerate(EDGES)], "edge int, start int, end int, finger int")


def segments_to_draw(joints: DataFrame, keys: list[str]) -> DataFrame:
    """Joints (keys, joint, x, y) to the lines of the skeleton (JOIN5, SNK7)."""
    e = F.broadcast(skeleton(joints.sparkSession))  # twenty rows
    end = lambda p: joints.select(*keys, F.col("joint").alias(p), F.col("x").alias(f"x_{p}"), F.col("y").alias(f"y_{p}"))
    return end("start").join(e, "start").join(end("end"), [*keys, "end"]).select(*keys, "edge", "finger", "x_start", "y_start", "x_end", "y_end")


def joints_to_draw(joints: DataFrame) -> DataFrame:
    """Joints with their names and the radius that a renderer draws."""
    names = F.array(*[F.lit(n) for n in JOINT_NAMES])
    return joints.withColumn("name", F.element_at(names, F.col("joint") + 1)).withColumn("radius", F.when(F.col("joint").isin(*BIG_JOINTS), 7).otherwise(5))


def hand_label(hand: Column, score: Column) -> Column:
    return F.concat(F.upper(hand), F.coalesce(F.format_string(" %.2f", score), F.lit("")))


def compatible_cache(cached: DataFrame, wanted: DataFrame) -> DataFrame:
    """Cached detections that a run may use again (SRC21): same source, frames and confidence.

    ``cached``: source, frame_count, det_confidence, n_frames, has_first, has_last.
    """
    c, w = cached.alias("c"), wanted.alias("w")
    near = F.abs(F.col("c.det_confidence") - F.col("w.confidence")) <= 1e-9 * F.greatest(F.abs("c.det_confidence"), F.abs("w.confidence"))
    same = (F.col("c.frame_count") == F.col("w.frame_count")) & (F.col("c.n_frames") == F.col("w.frame_count")) & near & F.col("c.has_first") & F.col("c.has_last")
    return w.join(c, (F.col("c.source") == F.col("w.source")) & same, "left").select("w.*", F.col("c.source").isNotNull().alias("reusable"))
