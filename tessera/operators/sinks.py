"""Sinks that are safe to repeat: documents and artifacts written aside and moved into place."""

from __future__ import annotations

import json
import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import document_sink, scans
from tessera.sources.catalog import BUNDLE_PARTS


def put(uri: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename: a reader never sees half a file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    ctx = TaskContext.get()
    tmp = f"{path}.{ctx.taskAttemptId() if ctx else 0}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, path)


def pretty(document: str) -> str:
    """JSON as documents are kept: indented by two, other scripts as they are, a last newline."""
    return json.dumps(json.loads(document), indent=2, ensure_ascii=False) + "\n"


def unique_names(rows: DataFrame, name: str) -> DataFrame:
    """The rows, or an error where two of them would write one file."""
    twice = rows.groupBy(name).count().where("count > 1").select(name).head(3)
    if twice:
        raise ValueError(f"several rows write to {[r[0] for r in twice]}")
    return rows


def rooted(spark: SparkSession, root: str) -> str:
    """A root as a URI; a bare path is one only where driver and executors are one machine."""
    if "://" in root:
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"a root that executors share needs a scheme, as in hdfs://... or file://...: {root}")
    return f"file://{root}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path of Spark's own settings as a URI: without a scheme it is in Spark's default file system."""
    if "://" in path:
        return path
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def write_files(rows: DataFrame, root: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write one file for each row, text or bytes, all or none; returns (name, bytes) (SNK1 to SNK4)."""
    return document_sink.write_documents(rows, rooted(rows.sparkSession, root), name, content)


def _pretty(documents: pd.Series) -> pd.Series:
    return documents.map(pretty)


def pretty_json(document: Column | str) -> Column:
    return F.pandas_udf(_pretty, "string")(document)


def write_json_documents(rows: DataFrame, root: str, name: str, document: Column) -> DataFrame:
    """A JSON file for each row; two rows of one name are an error before anything is written."""
    named = unique_names(rows.withColumn("_json", F.to_json(document, {"ignoreNullFields": "false"})), name)
    return write_files(named.withColumn("_json", pretty_json("_json")), root, name, "_json")


def rendered(rows: DataFrame, renderer: Callable[[dict], bytes], root: str, name: str = "name") -> DataFrame:
    """Files of an injected renderer, one row at a time: pages, overlays, frames, videos (SNK5 to SNK8)."""
    names = rows.columns
    root = rooted(rows.sparkSession, root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = []
            for r in b.to_dict("records"):
                data = renderer(r)
                put(f"{root.rstrip('/')}/{r[name]}", data)
                sizes.append(len(data))
            yield pd.DataFrame({"name": b[name], "bytes": sizes})

    return rows.select(*names).mapInPandas(run, "name string, bytes long")


def remove_workspace(uri: str) -> bool:
    """Remove a workspace; best effort, a failure is only reported (SNK9)."""
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    try:
        fs.delete_dir(path)
        return True
    except OSError:
        return False


def run_job(root: str, prompt: str, script: str, job: Callable[[str], None], validate: Callable[[str], None]) -> None:
    """Archive a prompt and its script, run an external job, validate what it left (SNK11, SNK12)."""
    base = root if "://" in root else f"file://{root}"
    put(f"{base}/prompt.txt", (prompt.strip() + "\n").encode())
    put(f"{base}/scene.py", script.encode())
    job(root)
    validate(root)


def run_jobs(jobs: DataFrame, root: str, command: Callable[[str, str], None], version: str = "") -> DataFrame:
    """Run an external job for each row (name, prompt, script) in the tasks (SNK11, SNK12).

    A job works in a folder of its own on its executor: prompt and script are archived there, ``command``
    gets the folder and the prompt, and what it left is validated (all parts of a bundle, see
    ``catalog``).  Then its files go to ``root/name``, the manifest last, so a bundle with a manifest is
    whole.  Returns (name, status, error, files); a failed job leaves nothing below the root, and a job
    that is run again replaces its files.
    """
    root = rooted(jobs.sparkSession, root).rstrip("/")

    def one(name: str, prompt: str, script: str) -> tuple[str, str | None, int]:
        with tempfile.TemporaryDirectory() as folder:
            try:
                document_sink.safe(name)
                for file, text in (("prompt.txt", (prompt or "").strip() + "\n"), ("scene.py", script or "")):
                    Path(folder, file).write_text(text, encoding="utf-8")
                command(folder, prompt)
                found = {str(p.relative_to(folder)): p.read_bytes() for p in sorted(Path(folder).rglob("*")) if p.is_file()}
                if lacking := lacking_parts(found):
                    raise RuntimeError(f"missing: {', '.join(lacking)}")
                for file, data in found.items():
                    put(f"{root}/{name}/{file}", data)
                manifest = {"prompt": prompt, "version": version, "files": {f: len(d) for f, d in found.items()}}
                put(f"{root}/{name}/manifest.json", (json.dumps(manifest, ensure_ascii=False, indent=2) + "\n").encode())
                return "ok", None, len(found) + 1
            except Exception as e:  # noqa: BLE001 - one job must not stop the others
                return "error", f"{type(e).__name__}: {e}", 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [one(*row) for row in b[["name", "prompt", "script"]].itertuples(index=False)]
            yield pd.DataFrame({"name": b["name"], "status": [d[0] for d in done], "error": [d[1] for d in done], "files": [d[2] for d in done]})

    todo = unique_names(jobs, "name").select("name", "prompt", "script").repartition(scans.ranges(jobs.sparkSession), "name")
    return scans.kept(todo.mapInPandas(run, "name string, status string, error string, files int"), "jobs")


def lacking_parts(found: dict[str, bytes]) -> list[str]:
    """What a bundle lacks: a prompt with words, its script, a scene, an image."""
    has = [bool(found.get("prompt.txt", b"").strip()), "scene.py" in found, any(f.endswith(".blend") for f in found), any(f.endswith(".png") and d[:8] == b"\x89PNG\r\n\x1a\n" for f, d in found.items())]
    return [part for part, ok in zip(BUNDLE_PARTS, has, strict=True) if not ok]


def workspace(spark: SparkSession, name: str = "workspace") -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``, which needs no scheme."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = qualified(spark, base) if base else rooted(spark, tempfile.mkdtemp(prefix="tessera-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
