"""Prefix scans over ranges give what windows give, also where one key is everything."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import pages, scans, tracks

SCHEMA = "video string, frame_index long, x double, score double, n int"


def rows(spark, seed, hot=0.8, n=3000):
    rng, out = random.Random(seed), []
    frame = {}
    for _ in range(n):
        v = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        frame[v] = frame.get(v, 0) + rng.choice([1, 1, 1, 2, 5, 31, 32, 60])
        out.append((v, frame[v], float(rng.randrange(100)), rng.random(), rng.randrange(9)))
    rng.shuffle(out)
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def same(a, b):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(a.columns).collect()), key=key)


@pytest.mark.parametrize(("hot", "parts"), [(0.8, 7), (1.0, 16), (0.0, 3), (0.5, 1)])
def test_scans_are_windows(spark, hot, parts):
    df, keys = rows(spark, parts, hot), ["video"]
    w = Window.partitionBy("video").orderBy("frame_index")
    got = scans.scanned(scans.placed(df, keys, ["frame_index"], parts), keys, ["frame_index"], number="k", sums={"s": F.col("n"), "ones": F.lit(1)}, lags={"p": "x", "q": "n"}, leads={"z": "score"}).drop("_part")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.row_number().over(w).cast("long").alias("k"), F.sum("n").over(upto).alias("s"), F.sum(F.lit(1)).over(upto).alias("ones"), F.lag("x").over(w).alias("p"), F.lag("n").over(w).alias("q"), F.lead("score").over(w).alias("z"))
    same(got, want)
    same(scans.numbered(df, keys, ["frame_index"], parts=parts), df.withColumn("index", F.row_number().over(w)))


@pytest.mark.parametrize("parts", [2, 9])
def test_tracks_of_any_length(spark, parts):
    df = rows(spark, 40 + parts)
    same(scans.segmented(df, ["video"], parts=parts), tracks.segmented(df, ["video"]))
    got = scans.interpolated(df, ["video"], ["x"], score="score", parts=parts)
    same(got, tracks.interpolated(tracks.segmented(df, ["video"]), ["video"], ["x"], score="score"))


def test_one_key_fills_all_ranges(spark):
    df = spark.range(50_000).select(F.lit("v").alias("video"), F.col("id").alias("frame_index"))
    sizes = [r["count"] for r in scans.placed(df, ["video"], ["frame_index"], 8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 50_000 / 8
    assert scans.numbered(df, ["video"], ["frame_index"], parts=8).where("index <> frame_index + 1").count() == 0


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scans.segmented(empty, ["video"]).count() == 0 and scans.numbered(empty, ["video"], ["frame_index"]).count() == 0
    one = spark.createDataFrame([(None, 5, 1.0, None, None)], SCHEMA)
    assert [tuple(r) for r in scans.segmented(one, ["video"]).collect()] == [(None, 5, 1.0, None, None, 0)]


def test_pages_up_to_the_first_failure(spark):
    p = spark.createDataFrame([("a", 1, "ok"), ("a", 2, "error"), ("a", 3, "error"), ("b", 1, "ok"), (None, 1, "error"), (None, 2, "ok")], "doc_id string, page int, status string")
    assert sorted((r.doc_id or "", r.page) for r in pages.fail_fast(p).collect()) == [("", 1), ("a", 1), ("a", 2), ("b", 1)]
