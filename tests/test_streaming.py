from tessera.operators import tracks
from tessera.streaming.tracks import stream_segments, tracked_stream

SCHEMA = "video string, frame_index int, cls int"


def test_stream_segments_are_those_of_the_batch(spark, tmp_path):
    frames = [0, 1, 5, 9, 15, 16, 40]
    spark.createDataFrame([("v", k, 0) for k in frames], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    spark.createDataFrame([("v", 5000, 0)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_segments(stream, ["video"], max_gap=3).writeStream.format("memory").queryName("segments").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.first_frame, r.last_frame, r.observed) for r in spark.table("segments").collect() if r.first_frame < 5000)
    batch = tracks.segmented(spark.createDataFrame([("v", k) for k in frames], "video string, frame_index int"), ["video"], max_gap=3)
    want = sorted((r.a, r.b, r.n) for r in batch.groupBy("segment_id").agg({"frame_index": "min"}).join(batch.groupBy("segment_id").agg({"frame_index": "max"}), "segment_id").join(batch.groupBy("segment_id").count(), "segment_id").toDF("s", "a", "b", "n").collect())
    assert got == want


def test_tracker_state_lasts_over_batches(spark, tmp_path):
    for k, rows in enumerate(([("v", 0, 1)], [("v", 1, 0), ("v", 2, 1)])):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = tracked_stream(stream).writeStream.format("memory").queryName("tracker").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.frame_index, r.cls): r.track_id for r in spark.table("tracker").collect()}
    assert got[0, 1] == got[2, 1] and got[1, 0] != got[0, 1]
