import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tessera.functions import answers
from tessera.operators import asr, consistency, models, pages, sinks, tracks
from tessera.plans import programs
from tessera.sources import catalog, files, media


def fake_pages():
    return models.ModelSpec("fake", lambda name: models.FakePageModel())


def test_pdf_run_numbers_blocks_and_captures_a_bad_page(spark):
    rows = [("a.pdf", 1, "p1"), ("a.pdf", 2, "bad p2"), ("a.pdf", 3, "p3"), ("b.pdf", 1, "q1"), ("b.pdf", 2, "blank q2")]
    done = pages.parsed(models.answered(spark.createDataFrame(rows, "doc_id string, page int, image string"), fake_pages()))
    blocks = pages.merged(done).orderBy("doc_id", "index").collect()
    assert [(b.doc_id, b["index"], b.page, b.page_index) for b in blocks] == [("a.pdf", 1, 1, 1), ("a.pdf", 2, 1, 2), ("a.pdf", 3, 3, 1), ("a.pdf", 4, 3, 2), ("b.pdf", 1, 1, 1), ("b.pdf", 2, 1, 2)]
    roll = {r.doc_id: r for r in pages.rollup(done).collect()}
    assert roll["a.pdf"].failed_pages == [2] and roll["a.pdf"].status == "partial" and not roll["a.pdf"].success and roll["a.pdf"].block_count == 4 and roll["a.pdf"].parsed_page_count == 3
    errors = {(r.doc_id, r.page): r.error for r in done.where("status = 'error'").collect()}
    assert errors["a.pdf", 2].startswith("RuntimeError") and "nothing on this page" in errors["b.pdf", 2]
    assert pages.exit_code(pages.rollup(done)) == 1 and pages.exit_code(pages.rollup(done.where("page = 1"))) == 0
    html = {r.doc_id: r.html for r in pages.pages_to_html(done).collect()}
    assert html["a.pdf"].index('data-page="1"') < html["a.pdf"].index('data-page="2"') < html["a.pdf"].index('data-page="3"')
    assert "page-error" in html["a.pdf"] and "2 blocks" in html["a.pdf"] and "(3 pages)" in html["a.pdf"]
    ok = pages.parsed(models.answered(spark.createDataFrame(rows, "doc_id string, page int, image string"), fake_pages()), blank_page_ok=True)
    assert ok.where("doc_id = 'b.pdf' and status = 'ok'").count() == 2


def test_stop_on_first_error_makes_no_further_call(spark):
    rows = [("a", k, "bad" if k == 2 else f"p{k}") for k in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id string, page int, image string")
    got = models.answered_until_failure(df, fake_pages(), lambda a: "[" in a).orderBy("page").collect()
    assert [r.page for r in got] == [1, 2]
    cited = spark.createDataFrame([("a", 1, "p1"), ("a", 2, "cites"), ("a", 3, "p3"), ("b", 1, "p1"), ("b", 2, "p2")], "doc_id string, page int, image string")
    got = models.answered_until_failure(cited, fake_pages(), lambda a: bool(answers.items(a))).collect()
    assert sorted((r.doc_id, r.page) for r in got) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]  # brackets without items are a failure
    assert sorted(r.page for r in pages.fail_fast(pages.parsed(models.answered(df, fake_pages()))).collect()) == [1, 2]


def detections(spark, rows):
    return spark.createDataFrame([("v", h, k, [float(k), float(k), k + 10.0, k + 10.0], s) for h, k, s in rows], "video string, hand string, frame_index int, bbox_xyxy array<float>, score float")


def test_short_gap_is_filled_and_long_gap_splits(spark):
    got = tracks.boxes_interpolated(detections(spark, [("left", 0, 0.9), ("left", 2, 0.8)]), ["video", "hand"], max_gap=2).orderBy("frame_index").collect()
    assert [r.frame_index for r in got] == [0, 1, 2] and got[1].bbox_xyxy == [1, 1, 11, 11] and [r.detected for r in got] == [True, False, True] and got[1].score is None
    for gap, segments in ((10, 1), (9, 1), (8, 2), (3, 2)):  # nine frames are missing
        d = tracks.segmented(detections(spark, [("right", 0, 0.9), ("right", 10, 0.8)]), ["video", "hand"], max_gap=gap)
        assert d.select("segment_id").distinct().count() == segments


@pytest.mark.parametrize(("length", "chunks", "valid"), [(3, 1, 3), (16, 1, 16), (17, 2, 1)])
def test_chunks_are_padded(spark, length, chunks, valid):
    d = detections(spark, [("left", k, 0.9) for k in range(length)])
    got = tracks.chunked(tracks.boxes_interpolated(d, ["video", "hand"]), ["video", "hand"]).orderBy("chunk_id").collect()
    assert len(got) == chunks and got[-1].valid_count == valid and all(len(c.frame_indices) == len(c.boxes) == 16 for c in got) and got[-1].frame_indices[-1] == length - 1


def test_tracks_against_a_plain_version(spark):
    rng = random.Random(3)
    rows = [(h, k, 0.5) for h in ("left", "right") for k in sorted(rng.sample(range(200), 40))]
    got = tracks.boxes_interpolated(detections(spark, rows), ["video", "hand"], max_gap=5).collect()
    want = {}
    for hand in ("left", "right"):
        seen = [k for h, k, _ in rows if h == hand]
        seg = 0
        for a, b in zip(seen, [*seen[1:], None], strict=True):
            last = b is None or b - a > 6
            for f in range(a, a + 1 if last else b):
                want[hand, f] = (seg, f == a, float(f))
            seg += last
    assert {(r.hand, r.frame_index): (r.segment_id, r.detected, r.bbox_xyxy[0]) for r in got} == want


def test_hands_end_to_end(spark):
    v = spark.createDataFrame([("v", 100, 100, 0.0, 5), ("empty", 0, 0, 30.0, 0)], "video string, width int, height int, fps double, frame_count int")
    records, counts = programs.estimate_hands(v, models.ModelSpec("t", lambda n: models.FakeTracker()), models.ModelSpec("p", lambda n: models.FakePose()), max_gap=3)
    got = records.orderBy("frame_index").collect()
    assert [len(r.hands) for r in got] == [2] * 5 and [h.handedness for h in got[1].hands] == ["left", "right"] and got[1].hands[0].bbox_interpolated and got[1].hands[0].detection_score is None
    assert got[1].timestamp_seconds == 0.033333 and counts.first().asDict() == {"video": "v", "left_frames": 3, "right_frames": 5}
    with pytest.raises(ValueError):
        programs.estimate_hands(v, None, None, chunk_batch=0)


def test_consistency(spark):
    image = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "image_id long, image_embedding array<float>")
    texts = spark.createDataFrame([(0, "aligned", [1.0, 0.0, 0.0]), (1, "orthogonal", [0.0, 1.0, 0.0]), (2, "diagonal", [0.7071068, 0.7071068, 0.0]), (3, "zero", [0.0, 0.0, 0.0])], "pos int, text string, text_embedding array<float>")
    s = consistency.scored(consistency.pairs(image, texts)).orderBy("pos").collect()
    assert [round(r.cosine_similarity, 5) for r in s[:3]] == [1.0, 0.0, 0.70711] and s[3].cosine_similarity is None
    assert abs(sum(r.consistency_score for r in s[:3]) - 1) < 1e-5
    assert consistency.best_match(consistency.scored(consistency.pairs(image, texts))).first().text == "aligned"
    scores, best = programs.score_images(spark.createDataFrame([(1, "cat")], "image_id long, image string"), ["dog", "cat"], models.ModelSpec("i", lambda n: models.FakeEncoder()), models.ModelSpec("t", lambda n: models.FakeEncoder()))
    assert scores.count() == 2 and best.first().text == "cat"


def test_silent_media_never_reach_the_model(spark):
    media_ = spark.createDataFrame([("a", 64.73, False), ("b", 1.0, True), ("c", None, None)], "source string, duration_seconds double, audio_present boolean")
    calls = []

    def infer(rows):
        calls.append(sorted(r.source for r in rows.select("source").collect()))
        return models.transcriber(models.ModelSpec("w", lambda n: models.FakeTranscriber()), word_timestamps=True)(rows)

    got = {r.source: r for r in asr.transcribed(media_, "w", infer).collect()}
    assert calls == [["b", "c"]] and got["a"].text == "" and got["a"].segments == [] and got["a"].audio_present is False and got["b"].text == "speech of b" and got["c"].language == "en"
    assert got["b"].segments[0].words[0].word == "hello"


def test_sinks_keep_other_scripts_and_leave_no_temporary_file(spark, tmp_path):
    rows = spark.createDataFrame([("a.json", "日本語"), ("b.json", "é")], "name string, text string")
    out = sinks.write_json_documents(rows, str(tmp_path), "name", F.struct("text")).collect()
    assert sorted(r.name for r in out) == ["a.json", "b.json"] == sorted(p.name for p in tmp_path.iterdir())
    assert (tmp_path / "a.json").read_text(encoding="utf-8") == '{\n  "text": "日本語"\n}\n'
    with pytest.raises(ValueError):
        sinks.write_json_documents(rows.withColumn("name", F.lit("same")), str(tmp_path), "name", F.struct("text"))
    done = []
    sinks.run_job(str(tmp_path / "job"), "a table ", "print()", done.append, done.append)
    assert (tmp_path / "job/prompt.txt").read_text() == "a table\n" and len(done) == 2 and sinks.remove_workspace(str(tmp_path / "job")) and not sinks.remove_workspace(str(tmp_path / "none"))


def test_sources_and_bundles(spark, tmp_path):
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    for name, data in {"full/prompt.txt": b"a table", "full/scene.py": b"x", "full/s.blend": b"b", "full/r.png": png, "part/prompt.txt": b" \n", "part/x.PDF": b"%", "part/y.tif": b"t"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    b = {r.dir.rsplit("/", 1)[1]: r for r in programs.validate_bundles(spark, str(tmp_path)).collect()}
    assert b["full"].complete and tuple(b["full"].renders[0]) == ("r.png", 640, 480) and b["part"].missing == list(catalog.BUNDLE_PARTS)
    assert files.documents(spark, str(tmp_path)).count() == 2 and files.pdfs(spark, str(tmp_path)).count() == 1 and files.images(spark, str(tmp_path)).count() == 1
    assert programs.summarise_datasets(spark, str(tmp_path)).first().file_count == 7
    with pytest.raises(ValueError):
        catalog.require_files(programs.summarise_datasets(spark, str(tmp_path)).where("1 = 0"))
    assert programs.main(["dataset-summary", str(tmp_path), "--limit", "0"]) == 2


def test_missing_assets_are_reported_together(spark):
    roots = spark.createDataFrame([("r",), ("s",)], "root string")
    have = spark.createDataFrame([("r", a) for a in catalog.REQUIRED_ASSETS[1:]], "root string, asset string")
    got = catalog.missing_assets(have, roots).collect()
    assert sorted(r.asset for r in got if r.root == "r") == [catalog.REQUIRED_ASSETS[0]] and sum(r.root == "s" for r in got) == 5


def test_probes_and_frames(spark):
    f = spark.createDataFrame([("a.mp4",), ("b.mp4",)], "path string")
    raw = {"format": {"duration": "64.7304"}, "streams": [{"codec_type": "video", "width": 4, "height": 3, "avg_frame_rate": "0/0", "nb_frames": "9"}]}
    got = {r.source: r for r in media.probed(f, lambda p: raw if p == "a.mp4" else {}).collect()}
    assert got["a.mp4"].duration_seconds == 64.73 and got["a.mp4"].audio_present is False and got["b.mp4"].audio_present is None and got["b.mp4"].duration_seconds is None
    videos = media.usable_videos(media.probed(f, lambda p: raw if p == "a.mp4" else {}), max_frames=2)
    assert [(r.fps, r.frame_count) for r in videos.collect()] == [(30.0, 2)]
    names = [r.name for r in media.frames(videos, lambda source, n: iter([b"x"] * n)).orderBy("frame_index").collect()]
    assert names == ["00000000.jpg", "00000001.jpg"]
    pages_ = media.pdf_pages(spark.createDataFrame([("a.pdf",)], "path string"), lambda p: 5, "2,4-5")
    assert [r.page for r in media.rasterised(pages_, lambda d, p, dpi, side: bytes([p]), parts=2).orderBy("page").collect()] == [2, 4, 5]


def test_devices_and_prompts():
    assert models.pick_device("auto") == "cpu" and models.pick_device("auto", ("cpu", "cuda", "mps")) == "cuda"
    with pytest.raises(RuntimeError):
        models.pick_device("mps")
    with pytest.raises(ValueError):
        models.prompt_mode("poem")
    assert models.pooled(([1, 2], "rest")) == [1.0, 2.0]


def test_keypoints_leave_a_worker_in_small_pieces():
    import pandas as pd

    names = {"video": "string", "frame_indices": "array<int>", "boxes": "array<array<double>>", "valid_count": "int"}
    schema = {c: SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda k=k: k)) for c, k in names.items()}
    chunks = SimpleNamespace(schema=schema, mapInPandas=lambda run, schema, profile: run)
    run = models.posed(chunks, models.ModelSpec("fake pose", lambda name: models.FakePose()), ["video"], batch=3)
    batch = pd.DataFrame([{"video": str(k), "frame_indices": [0], "boxes": [[k, k, k, k]], "valid_count": 1} for k in range(1000)])
    parts = list(run(iter([batch])))
    assert max(map(len, parts)) <= models.POSED
    whole = pd.concat(parts)
    assert list(whole["video"]) == list(batch["video"]) and [o[0]["keypoints_2d"][0][0] for o in whole["outputs"]] == list(range(1000))


def test_frame_records_broadcast_neither_tracks_nor_keypoints(spark):
    videos = spark.range(1, 4).select(F.col("id").cast("string").alias("video"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit(0.0).alias("fps"), (F.col("id") * 20).cast("int").alias("frame_count"))
    frames = programs.estimate_hands(videos, models.ModelSpec("fake tracker", lambda name: models.FakeTracker()), models.ModelSpec("fake pose", lambda name: models.FakePose()))[0]
    before = frames._jdf.queryExecution().executedPlan().toString()
    got = frames.orderBy("video", "frame_index").collect()
    assert [(r.video, r.frame_index) for r in got] == [(str(v), k) for v in (1, 2, 3) for k in range(20 * v)]
    assert all([h.keypoints_2d[0] == [r.frame_index + 5.0] * 2 for h in r.hands] == [True] * (1 if r.frame_index == 20 * int(r.video) - 1 else 2) for r in got)
    frames.collect()
    after = frames._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in before and "Broadcast" not in before + after and "isFinalPlan=true" in after
