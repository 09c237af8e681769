"""Downloads that break off go on where they stopped, and fetch nothing twice."""

import hashlib
from pathlib import Path

import pytest

from tessera.sources import snapshot


def content(path, revision, size):
    block = hashlib.sha256(f"{path}@{revision}".encode()).digest()
    return (block * (size // 32 + 1))[:size]


SIZES = {"a.bin": 950, "sub/b.bin": 100, "sub/deep/c.txt": 0, "d": 1}


@pytest.fixture
def service(tmp_path):
    """Serves files and notes each part that it serves; fails for some places while ``down`` exists."""
    log, sizes = tmp_path / "log", SIZES
    log.mkdir()

    def serve(path, revision, offset, length):
        if (log / "down").exists() and offset >= 200:
            raise ConnectionError("the service is down")
        name = hashlib.sha256(repr((path, revision, offset)).encode()).hexdigest()
        with open(log / f"{name}.got", "a") as f:
            f.write("x")
        block = hashlib.sha256(f"{path}@{revision}".encode()).digest()
        return (block * (sizes[path] // 32 + 1))[: sizes[path]][offset : offset + length]

    return serve


def served(tmp_path):
    return {p.name: len(p.read_text()) for p in (tmp_path / "log").glob("*.got")}


def listing(spark):
    return spark.createDataFrame(list(SIZES.items()), "path string, size long")


def whole(root, revision):
    return {str(p.relative_to(root)): p.read_bytes() for p in Path(root).rglob("*") if p.is_file() and ".cache" not in p.parts} == {p: content(p, revision, n) for p, n in SIZES.items()}


def test_a_broken_run_goes_on(spark, tmp_path, service):
    root = tmp_path / "out"
    (tmp_path / "log/down").touch()
    with pytest.raises(Exception, match="down"):
        snapshot.download(listing(spark), str(root), "r1", service, workers=2, part_bytes=100)
    before = served(tmp_path)
    assert before and not [p for p in root.rglob("*") if p.is_file() and ".cache" not in p.parts]
    (tmp_path / "log/down").unlink()
    got = snapshot.download(listing(spark), str(root), "r1", service, workers=3, part_bytes=100)
    assert whole(root, "r1") and got["files"] == 4
    assert set(served(tmp_path).values()) == {1} and got["parts"] == 10 + 1 + 1 + 1 - len(before)
    assert not list((root / ".cache/parts").glob("*"))
    # nothing is left to do, for this revision
    assert snapshot.download(listing(spark), str(root), "r1", service, part_bytes=100) == {"parts": 0, "files": 0}
    assert set(served(tmp_path).values()) == {1}


def test_revisions_and_force(spark, tmp_path, service):
    root = tmp_path / "out"
    snapshot.download(listing(spark), str(root), "r1", service, part_bytes=400)
    got = snapshot.download(listing(spark), str(root), "r2", service, part_bytes=400)
    assert got == {"parts": 6, "files": 4} and whole(root, "r2")
    (root / "d").write_text("spoiled")
    assert snapshot.download(listing(spark), str(root), "r2", service, part_bytes=400, force=True)["files"] == 4 and whole(root, "r2")


def test_errors(spark, tmp_path, service):
    with pytest.raises(Exception, match="not a name"):
        snapshot.download(spark.createDataFrame([("../x", 1)], "path string, size long"), str(tmp_path / "o"), "r", service)
    with pytest.raises(ValueError, match="positive"):
        snapshot.download(listing(spark), str(tmp_path / "o"), "r", service, workers=0)
    with pytest.raises(Exception, match="bytes came"):
        snapshot.download(listing(spark), str(tmp_path / "o"), "r", lambda *a: b"short", part_bytes=100)
    assert snapshot.download(spark.createDataFrame([], "path string, size long"), str(tmp_path / "o"), "r", service) == {"parts": 0, "files": 0}
