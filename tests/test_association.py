"""Tracks by assignment: least cost, identity over crossings and gaps, batch and stream alike."""

import itertools
import random

import numpy as np
import pytest

from tessera.operators import association as A

SCHEMA = "video string, frame_index int, cls int, bbox_xyxy array<float>, score float, track_id string"


@pytest.mark.parametrize("seed", range(40))
def test_assignment_is_of_least_cost(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 7))
    cost = rng.integers(0, 5, (n, n)).astype(float) if seed % 2 else rng.random((n, n))
    got = A.assigned(cost)
    assert sorted(got.tolist()) == list(range(n))
    best = min((sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n))), default=0)
    assert abs(cost[np.arange(n), got].sum() - best) < 1e-9


@pytest.mark.parametrize("seed", range(15))
def test_matches_of_a_frame_are_of_least_cost(seed):
    """Against all ways to match some tracks with some detections."""
    rng = np.random.default_rng(seed)
    boxes = lambda n: np.concatenate([c := rng.random((n, 2)) * 12, c + 4 + rng.random((n, 2))], 1)
    first, second = boxes(4), boxes(3)
    kinds, later = rng.integers(0, 2, 4), rng.integers(0, 2, 3)
    tracks = A.Tracks()
    tracks.step(0, kinds, first, 5, 0.1)
    shared = A.overlaps(first, second)
    got = tracks.step(1, later, second, 5, 0.1)
    cost = lambda pairs: sum(1 - shared[t, d] for t, d in pairs) + 0.45 * (7 - 2 * len(pairs))
    options = []
    for k in range(4):
        for ts in itertools.combinations(range(4), k):
            for ds in itertools.permutations(range(3), k):
                pairs = list(zip(ts, ds, strict=True))
                if all(shared[t, d] > 0.1 and kinds[t] == later[d] for t, d in pairs):
                    options.append(cost(pairs))
    assert abs(cost([(int(n), d) for d, n in enumerate(got) if n < 4]) - min(options)) < 1e-9


def moving(seed, videos=3, frames=60):
    """Objects on straight lines that cross, with gaps; and the object of each detection."""
    rng, rows, truth = random.Random(seed), [], {}
    for v in range(videos):
        for o in range(3):
            x, y, dx, dy = 100 * o, 60 * o, 3 - 3 * o, 2 * o - 2
            for f in range(frames):
                if rng.random() < 0.15 and f > 2:
                    continue
                box = [float(x + dx * f), float(y + dy * f), float(x + dx * f + 40), float(y + dy * f + 40)]
                rows.append((f"v{v}", f, o % 2, box, 0.9, "other"))
                truth[f"v{v}", f, tuple(box)] = o
    return rows, truth


def found(df):
    return {(r.video, r.frame_index, r.cls, tuple(r.bbox_xyxy)): r.track_id for r in df.collect()}


def test_identities_last_over_gaps(spark):
    rows, truth = moving(1)
    got = found(A.associated(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert len(got) == len(rows)
    for v in range(3):
        ids = {}
        for (video, f, _, box), number in got.items():
            if video == f"v{v}":
                ids.setdefault(truth[video, f, box], set()).add(number)
        assert all(len(s) == 1 for s in ids.values()) and len(set.union(*ids.values())) == 3  # no identity is switched
        assert set.union(*ids.values()) == {0, 1, 2}


def test_tracks_end(spark):
    still = [0.0, 0.0, 10.0, 10.0]
    rows = [("v", f, 0, still, 0.9, "x") for f in (0, 1, 2, 8, 15)] + [(None, 3, 0, still, 0.9, "x")]
    got = found(A.associated(spark.createDataFrame(rows, SCHEMA), max_age=5))
    ids = {k[1]: v for k, v in got.items() if k[0] == "v"}
    assert ids == {0: 0, 1: 0, 2: 0, 8: 0, 15: 1} and got[None, 3, 0, tuple(still)] == 0  # five frames are missing, then six


def test_odd_rows(spark):
    rows = [("v", 0, 0, None, 0.9, "x"), ("v", 0, None, [0.0, 0.0, 1.0, 1.0], 0.9, "x"), ("v", 1, 0, [0.0, 0.0, 1.0], None, "x"), ("v", 1, 0, [float("nan")] * 4, 0.1, "x"), ("v", 2, 0, [5.0, 5.0, 5.0, 5.0], 0.5, "x"), ("v", 3, 0, [5.0, 5.0, 5.0, 5.0], 0.5, "x"), ("v", None, 0, [0.0] * 4, 1.0, "x")]
    got = [(r.frame_index, r.track_id) for r in A.associated(spark.createDataFrame(rows, SCHEMA)).orderBy("frame_index", "track_id").collect()]
    assert got == [(0, None), (0, None), (1, None), (1, None), (2, 0), (3, 1)]
    assert A.associated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_batches_may_cut_a_frame(spark):
    rows, _ = moving(4)
    df = spark.createDataFrame(rows, SCHEMA)
    want = found(A.associated(df))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert found(A.associated(df)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_stream_and_batch_agree(spark, tmp_path):
    rows, _ = moving(7, videos=2, frames=40)
    for k in range(2):  # twenty frames a batch
        part = [r for r in rows if 20 * k <= r[1] < 20 * (k + 1)]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tracked = A.associated_stream(stream, late_frames=5)
    q = tracked.writeStream.format("memory").queryName("associated").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(100) and q.exception() is None
    got, want = found(spark.table("associated")), found(A.associated(spark.createDataFrame(rows, SCHEMA)))
    assert got == want
