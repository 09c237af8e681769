"""Detections to tracks by assignment: predict, gate, match at least cost, expire (MDL7).

A track moves on at its last speed.  A detection may continue a track of its class whose predicted
box it overlaps by more than ``MIN_OVERLAP``; of all ways to continue tracks the one of least cost is
taken, where a match costs one less the overlap and each track or detection left alone costs half of
the most that a match may cost.  Other detections begin tracks.  A track without a detection for more
than ``max_age`` frames ends and is never continued.

``associated`` runs over the frames of each video in order, a frame in memory at a time;
``associated_stream`` keeps the tracks of a video as typed state between the batches of a stream, and
gives the same numbers when frames come in order.  Detections of a frame are taken in the order of
class, box and score.  Defined results: a null box or class has no track (null), frames without
detections need no row, a video's numbers begin at 0, and repeated rows are detections of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators import scans

MIN_OVERLAP, MAX_AGE = 0.1, 30
#: Weight of the newest step in a track's speed.
NEWEST = 0.5
OUT = "frame_index int, cls int, bbox_xyxy array<double>, score double, track_id int"


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of each box of ``a`` with each of ``b``; boxes without area overlap nothing."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.prod(np.clip(high - low, 0, None), axis=2)
    area = lambda x: np.prod(np.clip(x[:, 2:] - x[:, :2], 0, None), axis=1)
    total = area(a)[:, None] + area(b)[None, :] - both
    return np.divide(both, total, out=np.zeros_like(both), where=total > 0)


def assigned(cost: np.ndarray) -> np.ndarray:
    """The column of each row of a square matrix in an assignment of least cost.

    Rows enter one at a time; each by a shortest augmenting path over reduced costs.
    """
    n = len(cost)
    row_price, column_price, owner = np.zeros(n), np.zeros(n), np.full(n, -1)
    for start in range(n):
        slack, came, done = np.full(n, np.inf), np.full(n, -1), np.zeros(n, bool)
        row, column = start, -1
        while row >= 0:
            if column >= 0:
                done[column] = True
            reduced = cost[row] - row_price[row] - column_price
            better = ~done & (reduced < slack)
            slack[better], came[better] = reduced[better], column
            column = int(np.argmin(np.where(done, np.inf, slack)))
            step = slack[column]
            row_price[start] += step
            held = np.flatnonzero(done)
            row_price[owner[held]] += step
            column_price[held] -= step
            slack[~done] -= step
            row = int(owner[column])
        while column >= 0:  # turn the path round
            before = int(came[column])
            owner[column] = owner[before] if before >= 0 else start
            column = before
    out = np.empty(n, np.int64)
    out[owner] = np.arange(n)
    return out


@dataclass
class Tracks:
    """Open tracks of one video as arrays, oldest first."""

    number: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cls: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    last: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    box: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))
    speed: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))
    next: int = 0

    def keep(self, which: np.ndarray) -> None:
        for name in ("number", "cls", "last", "box", "speed"):
            setattr(self, name, getattr(self, name)[which])

    def step(self, frame: int, cls: np.ndarray, box: np.ndarray, max_age: int, min_overlap: float) -> np.ndarray:
        """The numbers of a frame's detections; tracks move, begin and end."""
        self.keep(frame - self.last - 1 <= max_age)
        t, d = len(self.number), len(cls)
        gone = (frame - self.last)[:, None]
        shared = overlaps(self.box + self.speed * gone, box)
        allowed = (shared > min_overlap) & (self.cls[:, None] == cls[None, :])
        if (allowed.sum(0) <= 1).all() and (allowed.sum(1) <= 1).all():
            to = np.where(allowed.any(1), allowed.argmax(1) if d else 0, d)  # nobody contends; any match costs less than two alone
        else:
            alone = (1 - min_overlap) / 2
            cost = np.full((t + d, t + d), alone)  # a track or a detection beside itself is left alone
            cost[:t, :d] = np.where(allowed, 1 - shared, 4 * alone)
            cost[t:, d:] = 0
            to = assigned(cost)[:t]
        matched = np.flatnonzero((to < d) & allowed[np.arange(t), np.minimum(to, d - 1)]) if d else np.zeros(0, np.int64)
        numbers = np.full(d, -1, np.int64)
        if len(matched):
            found = to[matched]
            numbers[found] = self.number[matched]
            newest = (box[found] - self.box[matched]) / gone[matched]
            first = (self.speed[matched] == 0).all(1, keepdims=True)
            self.speed[matched] = np.where(first, newest, (1 - NEWEST) * self.speed[matched] + NEWEST * newest)
            self.box[matched], self.last[matched] = box[found], frame
        new = np.flatnonzero(numbers < 0)
        numbers[new] = self.next + np.arange(len(new))
        self.next += len(new)
        self.number, self.cls = np.concatenate([self.number, numbers[new]]), np.concatenate([self.cls, cls[new]])
        self.last = np.concatenate([self.last, np.full(len(new), frame)])
        self.box, self.speed = np.concatenate([self.box, box[new]]), np.concatenate([self.speed, np.zeros((len(new), 4))])
        return numbers


def _number(state: dict, rows: pd.DataFrame, max_age: int, min_overlap: float) -> pd.DataFrame:
    """Rows of whole frames with their tracks, videos together and their frames in order.

    ``state`` holds the tracks of the video that came last; another one begins anew.
    """
    boxes = rows["bbox_xyxy"].tolist()
    whole = [b is not None and len(b) == 4 and None not in list(b) for b in boxes]
    box = np.array([b if ok else [np.nan] * 4 for b, ok in zip(boxes, whole, strict=True)], np.float64).reshape(-1, 4)
    known = np.isfinite(box).all(1) & rows["cls"].notna().to_numpy()
    cls = rows["cls"].fillna(-1).to_numpy(np.int64)
    frames, score = rows["frame_index"].to_numpy(np.int64), rows["score"].fillna(-np.inf).to_numpy(np.float64)
    video = pd.factorize(rows["video"], use_na_sentinel=False)[0]
    order = np.lexsort((score, box[:, 3], box[:, 2], box[:, 1], box[:, 0], cls, frames, video))
    numbers = np.full(len(rows), -1, np.int64)
    at = order[known[order]]
    cuts = np.flatnonzero((np.diff(frames[at]) != 0) | (np.diff(video[at]) != 0)) + 1
    names = rows["video"].tolist()
    for part in np.split(at, cuts) if len(at) else []:
        name = names[part[0]]
        if ("of", name) not in state:
            state.clear()
            state["of", name] = Tracks()
        numbers[part] = state["of", name].step(int(frames[part[0]]), cls[part], box[part], max_age, min_overlap)
    number = pd.Series(numbers, index=rows.index).astype("Int32").mask(numbers < 0)
    return rows.assign(track_id=number, cls=rows["cls"].astype("Int32"))


def _columns(detections: DataFrame, video: str) -> DataFrame:
    return detections.select(F.col(video).cast("string").alias("video"), F.col("frame_index").cast("int").alias("frame_index"), F.col("cls").cast("int").alias("cls"), F.col("bbox_xyxy").cast("array<double>").alias("bbox_xyxy"), F.col("score").cast("double").alias("score"))


def associated(detections: DataFrame, video: str = "video", max_age: int = MAX_AGE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """Detections (video, frame_index, cls, bbox_xyxy, score) with their ``track_id``.

    One exchange brings the frames of a video to a task in order.
    """
    names = ["video", *[c.split()[0] for c in OUT.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, held = {}, None
        for b in batches:
            b = b.assign(video=b["video"].astype(object).where(b["video"].notna(), None))
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            if not len(b):
                continue
            # the last frame may go on in the next batch
            name = b["video"].iloc[-1]
            same = (b["video"].isna() if name is None else b["video"] == name) & (b["frame_index"] == b["frame_index"].iloc[-1])
            held, b = b[same], b[~same]
            if len(b):
                yield _number(state, b, max_age, min_overlap)[names]
        if held is not None and len(held):
            yield _number(state, held, max_age, min_overlap)[names]

    ordered = _columns(detections, video).where("frame_index is not null").repartition(scans.ranges(detections.sparkSession), "video").sortWithinPartitions("video", "frame_index")
    return ordered.mapInPandas(run, f"video string, {OUT}").withColumnRenamed("video", video)


class TrackerState(StatefulProcessor):
    """The open tracks of a video as a list of typed rows, and the next number.

    With event times (a second a frame) a timer drops the tracks of a video once the watermark is past
    the last frame that could continue one; its next number stays, so that none is given twice.
    """

    OPEN = "number int, kind int, last int, box array<double>, speed array<double>"

    def __init__(self, max_age: int, min_overlap: float, timed: bool):
        self.max_age, self.min_overlap, self.timed = max_age, min_overlap, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.OPEN)
        self.next = handle.getValueState("next", "number int, frame int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        tracks, frame = Tracks(), -1
        if self.next.exists():
            tracks.next, frame = self.next.get()
            held = list(self.open.get()) if self.open.exists() else []
            if held:
                number, cls, last, box, speed = zip(*held, strict=True)
                tracks.number, tracks.cls, tracks.last = (np.array(x, np.int64) for x in (number, cls, last))
                tracks.box, tracks.speed = np.array(box, np.float64), np.array(speed, np.float64)
        parts = [p for p in rows if len(p)]
        if parts:
            new = pd.concat(parts, ignore_index=True)
            late = new["frame_index"] <= frame  # its frame is over; the row is kept, without a track
            done = _number({("of", new["video"].iloc[0]): tracks}, new[~late], self.max_age, self.min_overlap) if (~late).any() else None
            frame = max(frame, int(new["frame_index"].max()))
            out = [p for p in (done, new[late].assign(track_id=None) if late.any() else None) if p is not None]
            columns = ["video", *[c.split()[0] for c in OUT.split(", ")]]
            for p in out:
                yield p.assign(track_id=p["track_id"].astype("Int32"), cls=p["cls"].astype("Int32"))[columns]
        self.next.update((tracks.next, frame))
        self.open.put([(int(n), int(c), int(last), b.tolist(), s.tolist()) for n, c, last, b, s in zip(tracks.number, tracks.cls, tracks.last, tracks.box, tracks.speed, strict=True)])
        if self.timed and len(tracks.number):
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer((frame + self.max_age + 2) * 1000)

    def handleExpiredTimer(self, key, timers, expired) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.open.clear()
        return iter([])

    def close(self) -> None:
        pass


def associated_stream(detections: DataFrame, video: str = "video", max_age: int = MAX_AGE, min_overlap: float = MIN_OVERLAP, late_frames: int | None = None) -> DataFrame:
    """``associated`` over a stream whose batches hold whole frames in order, in append mode.

    A detection of a frame that is over is given out without a track.  With ``late_frames`` frames are
    event times, a second each (the first one second: at zero Spark takes rows as late), and the tracks of a video that has been left that far behind go; a
    detection that comes later than that is dropped.
    """
    spark = detections.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows, timed = _columns(detections, video).where("frame_index is not null"), late_frames is not None
    if timed:
        rows = rows.withColumn("at", F.timestamp_seconds(F.col("frame_index") + 1)).withWatermark("at", f"{late_frames} seconds")
    processor = TrackerState(max_age, min_overlap, timed)
    out = rows.groupBy("video").transformWithStateInPandas(processor, f"video string, {OUT}", "Append", "EventTime" if timed else "None")
    return out.withColumnRenamed("video", video)
