"""Headers of media files that a writer made, whole, in fragments and broken."""

import random
import struct

import pytest

from tessera.plans import fixtures
from tessera.sources import containers, media
from tessera.sources.ranged import Broken, Bytes


def facts(data):
    return containers.facts(Bytes.of(data))


@pytest.mark.parametrize("long", [False, True])
@pytest.mark.parametrize("last", [False, True])
@pytest.mark.parametrize("fragments", [0, 1, 7])
def test_movies(long, last, fragments):
    got = facts(fixtures.movie(90, 512, 15360, (1280, 720), sound=True, long=long, last=last, fragments=fragments))
    assert got == (3.0, True, 1280, 720, 30.0, 90)
    assert facts(fixtures.movie(25, 1001, 24000, (64, 48), sound=False, long=long, last=last, fragments=fragments)) == (1.043, False, 64, 48, 24000 / 1001, 25)


def test_sound_alone_and_empty_movies():
    assert facts(fixtures.movie(480, 1024, 48000, video=False)) == (10.24, True, None, None, None, None)
    assert facts(fixtures.movie(0, sound=False)) == (None, False, 640, 480, 0.0, 0)


def test_a_wave_file():
    head = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16)
    wave = b"RIFF" + struct.pack("<I", 999) + b"WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + head + b"data" + struct.pack("<I", 16000) + bytes(16000)
    assert facts(wave) == (0.5, True, None, None, None, None)
    with pytest.raises(Broken):
        facts(wave[:40])


def test_few_bytes_are_read_of_a_large_file():
    whole = fixtures.movie(90, data=50_000_000)
    read = []
    data = Bytes(len(whole), lambda at, n: read.append(n) or whole[at : at + n])
    assert containers.facts(data)[0] == 3.0 and sum(read) < 100_000


def test_broken_files_never_crash_and_never_lie_about_being_cut():
    whole, rng = fixtures.movie(30, last=False, data=0), random.Random(1)
    for end in range(len(whole)):
        try:
            facts(whole[:end])
        except (Broken, struct.error):
            continue
        assert end >= len(whole) - 16  # only the empty data box is missing
    for _ in range(500):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 4)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        try:
            facts(bytes(data))
        except (Broken, struct.error):
            pass


def test_headers_by_path_and_by_content(spark, tmp_path):
    files = {"a.mp4": fixtures.movie(90), "b.mp4": fixtures.movie(90)[:200], "c.mp4": b"", "d.mp4": fixtures.movie(30, sound=False, fragments=3)}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    paths = spark.createDataFrame([(str(tmp_path / n), n) for n in [*files, "none.mp4"]] + [(None, "null")], "path string, width string").withColumnRenamed("width", "label")
    for df in (containers.headers(listed, "content"), containers.headers(listed.select("path")), containers.headers(paths)):
        got = {(r.path or "null").rsplit("/", 1)[-1]: r for r in df.collect()}
        assert tuple(got["a.mp4"])[-7:] == (3.0, True, 640, 480, 30.0, 90, None) and got["d.mp4"].frame_count == 30 and not got["d.mp4"].audio_present
        assert all(got[n].error and got[n].duration_seconds is None and got[n].audio_present is None for n in got if n not in ("a.mp4", "d.mp4"))
    assert {r.label for r in containers.headers(paths).collect()} == {*files, "none.mp4", "null"}
    probed = containers.probed(paths)
    assert probed.schema.simpleString() == media.probed(paths, lambda p: {}).schema.simpleString()
    assert [r.frame_count for r in media.usable_videos(probed, 40).orderBy("source").collect()] == [40, 30]
