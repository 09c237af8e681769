"""Tools, environments, jobs and commands."""

import json
import os
import subprocess
from pathlib import Path

import pytest

from tessera.operators import drawing, models, sinks
from tessera.plans import fixtures, programs
from tessera.sources import media, tools


def test_tools(tmp_path, monkeypatch):
    own = tmp_path / "mytool"
    own.write_text("#!/bin/sh\n")
    own.chmod(0o755)
    assert tools.tool("mytool", str(own)) == str(own) and tools.tool("nowhere", fallbacks=("/no", str(own))) == str(own)
    with pytest.raises(FileNotFoundError, match="is not at"):
        tools.tool("mytool", str(tmp_path / "other"))
    with pytest.raises(FileNotFoundError, match="neither"):
        tools.tool("no-such-tool-anywhere")
    monkeypatch.setenv("PATH", str(tmp_path))
    assert tools.tool("mytool") == str(own)
    with pytest.raises(FileNotFoundError):
        media.ffprobe("x", explicit=str(tmp_path / "none"))


def test_cache_and_config(tmp_path, monkeypatch):
    for k in tools.CACHE_VARIABLES:
        monkeypatch.setenv(k, "before")
    made = tools.cache_environment(str(tmp_path / "cache"))
    assert os.environ["HF_HUB_CACHE"] == made["HF_HUB_CACHE"] == str(tmp_path / "cache/hub") and (tmp_path / "cache/xet").is_dir() and os.environ["HF_HOME"] == str(tmp_path / "cache")
    vit, other = {"MODEL": {"BACKBONE": {"TYPE": "vit"}}}, {"MODEL": {"BACKBONE": {"TYPE": "resnet"}}}
    assert tools.fixed_config(vit)["MODEL"]["BBOX_SHAPE"] == [192, 256] and "BBOX_SHAPE" not in vit["MODEL"] and tools.fixed_config(other) == other
    kept = {"MODEL": {"BACKBONE": {"TYPE": "vit"}, "BBOX_SHAPE": [1, 2]}}
    assert tools.fixed_config(kept) == kept and tools.fixed_config({}) == {}
    (tmp_path / "config.json").write_text(json.dumps(vit))
    seen = []
    spec = models.ModelSpec("with a config", lambda name, config: seen.append((name, config)) or "handle", config=str(tmp_path / "config.json"), cache=str(tmp_path / "second"))
    assert models.handle(spec) == models.handle(spec) == "handle" and len(seen) == 1
    assert seen[0][1]["MODEL"]["BBOX_SHAPE"] == [192, 256] and os.environ["HF_HOME"] == str(tmp_path / "second")


def test_accelerators(spark):
    assert models.profile(models.ModelSpec("m", lambda n: None)) is None
    spec = models.ModelSpec("m", lambda n: None, accelerators=0.5)
    p = models.profile(spec)
    assert p.taskResources["gpu"].amount == 0.5 and p.executorResources["gpu"].amount == 1
    rows = spark.createDataFrame([("d", 1, "p")], "doc_id string, page int, image string")
    assert "Profile" in models.answered(rows, spec)._jdf.queryExecution().toString() and "Profile: id" not in models.answered(rows, models.ModelSpec("m", lambda n: None))._jdf.queryExecution().toString()


def test_jobs(spark, tmp_path):
    image = drawing.Canvas(4, 3).png()

    def job(folder, prompt):
        from pathlib import Path as P

        if "fail" in prompt:
            raise RuntimeError("exited with code 3")
        P(folder, "out.blend").write_bytes(b"scene")
        if "bare" not in prompt:
            P(folder, "render.png").write_bytes(image)

    rows = [("a", " a table ", "print()"), ("b", "fail", "x"), ("c", "bare", "x"), ("d/e", "deep", "x"), ("../f", "bad name", "x"), ("g", None, "x")]
    got = {r.name: r for r in sinks.run_jobs(spark.createDataFrame(rows, "name string, prompt string, script string"), str(tmp_path / "jobs"), job, "4.2").collect()}
    assert {n: r.status for n, r in got.items()} == {"a": "ok", "b": "error", "c": "error", "d/e": "ok", "../f": "error", "g": "error"}
    assert "code 3" in got["b"].error and "PNG" in got["c"].error and got["a"].files == 5
    names = {str(p.relative_to(tmp_path / "jobs")) for p in (tmp_path / "jobs").rglob("*") if p.is_file()}
    assert names == {f"{d}/{f}" for d in ("a", "d/e") for f in ("prompt.txt", "scene.py", "out.blend", "render.png", "manifest.json")}
    manifest = json.loads((tmp_path / "jobs/a/manifest.json").read_text())
    assert manifest["prompt"] == " a table " and manifest["version"] == "4.2" and manifest["files"]["out.blend"] == 5 and (tmp_path / "jobs/a/prompt.txt").read_text() == "a table\n"


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "films").mkdir()
    (tmp_path / "films/a.mp4").write_bytes(fixtures.movie(9))
    (tmp_path / "films/b.mp4").write_bytes(fixtures.movie(4, sound=False))
    factory = "tessera.operators.models:transcriber_factory"
    for argv, code in (
        (["transcribe", str(tmp_path / "films"), "--model", factory], 0), (["dataset-summary", str(tmp_path / "films")], 0), (["transcribe", str(tmp_path / "films"), "--model", "no.such:thing"], 1),
        (["estimate-hands", str(tmp_path / "films"), "--model", "tessera.operators.models:tracker_factory", "--pose-model", "tessera.operators.models:pose_factory", "--max-gap", "-1"], 2),
        (["estimate-hands", str(tmp_path / "films"), "--model", "tessera.operators.models:tracker_factory", "--pose-model", "tessera.operators.models:pose_factory"], 0),
        (["parse-pdf", str(tmp_path / "films"), "--model", factory, "--max-tokens", "0"], 2), (["dataset-summary", str(tmp_path / "none")], 1), (["dataset-summary", str(tmp_path / "films"), "--limit", "0"], 2),
    ):
        assert programs.main(argv) == code, argv
        out = capsys.readouterr()
        if argv[0] == "transcribe" and code == 0:
            rows = sorted((json.loads(line) for line in out.out.splitlines()), key=lambda r: r["source"])
            assert [r["text"] for r in rows] == [f"speech of {rows[0]['source']}", ""] and rows[0]["duration_seconds"] == 0.3
        assert bool(out.err) == (code > 0)
    with pytest.raises(SystemExit) as e:
        programs.main(["no-such-program"])
    assert e.value.code == 2


def test_module_runs():
    done = subprocess.run(["python", "-m", "tessera.plans.programs", "--help"], capture_output=True, text=True, cwd=Path(__file__).parent.parent, check=False)
    assert done.returncode == 0 and "estimate-hands" in done.stdout
