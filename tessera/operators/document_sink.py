"""One file for each row, all of a job's or none: the data source ``tessera_documents`` (SNK1 to SNK4).

Beside the root, a folder ``_NAME.tessera`` holds what isn't a document yet, so that no reader lists it:

``staging/JOB/TASK/``   contents in the order of a task's rows, and its manifest (name and bytes)
``JOB.committed``       the tasks that count, written at once; from here on the job only goes forward
``jobs/JOB/``           the manifests of a finished job

A task stages its rows and tells the driver where; a task that is repeated stages them anew.  The
commit writes the record and moves each document to its name, in threads, for it only renames.  A
driver that dies in between leaves a record: the next job on that root, or ``recover``, ends the moves.
A job that fails leaves no record, and its staging goes.  A document of a name that exists replaces
it.  A job's id may be given; running it again changes nothing.  A stream's batches are jobs of their number.

Errors, before anything is visible: a null or unsafe name, a null content, a name twice in a task
(``sinks.unique_names`` looks over all tasks).
"""

from __future__ import annotations

import contextlib
import json
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

NAME = "tessera_documents"
THREADS = 16


def hidden_folder(base: str) -> str:
    """The folder beside a root where its jobs are."""
    above, name = posixpath.split(base.rstrip("/"))
    if not name:
        raise ValueError(f"documents need a folder that has a name: {base!r}")
    return f"{above}/_{name}.tessera"


def _exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _move(fs: pafs.FileSystem, source: str, target: str) -> None:
    """Rename; a repeated call finds the work done."""
    if not _exists(fs, source):
        if not _exists(fs, target):
            raise FileNotFoundError(source)
        return
    fs.create_dir(posixpath.dirname(target), recursive=True)
    try:
        fs.move(source, target)
    except OSError:  # stores that don't rename onto a file
        fs.delete_file(target)
        fs.move(source, target)


def _write(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    with fs.open_output_stream(path) as out:
        out.write(data)


def _read(fs: pafs.FileSystem, path: str) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read()


def safe(name: str | None) -> str:
    """A relative name that stays below the root, or an error."""
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") for p in parts) or "\x00" in name or "\\" in name:
        raise ValueError(f"not a name for a document: {name!r}")
    return name


def publish(root: str, job: str) -> None:
    """Move the documents of a committed job to their names, then forget its staging and record."""
    fs, base = pafs.FileSystem.from_uri(root)
    hidden = hidden_folder(base)
    record = f"{hidden}/{job}.committed"
    tasks = json.loads(_read(fs, record))
    kept = f"{hidden}/jobs/{job}"
    fs.create_dir(kept, recursive=True)
    with ThreadPoolExecutor(THREADS) as pool:
        for task in tasks:  # one manifest at a time, each moved when its documents are
            staged = f"{hidden}/staging/{job}/{task}"
            if _exists(fs, f"{staged}/manifest"):
                names = [json.loads(line)["name"] for line in _read(fs, f"{staged}/manifest").splitlines()]
                for _ in pool.map(lambda x: _move(fs, *x), [(f"{staged}/{k}", f"{base}/{n}") for k, n in enumerate(names)]):
                    pass
            _move(fs, f"{staged}/manifest", f"{kept}/{task}.json")
    with contextlib.suppress(FileNotFoundError):
        fs.delete_dir(f"{hidden}/staging/{job}")
    with contextlib.suppress(FileNotFoundError):
        fs.delete_file(record)


def recover(root: str) -> list[str]:
    """End the moves of jobs that were committed and not finished."""
    fs, base = pafs.FileSystem.from_uri(root)
    found = fs.get_file_info(pafs.FileSelector(hidden_folder(base), allow_not_found=True))
    jobs = sorted(posixpath.basename(x.path).removesuffix(".committed") for x in found if x.path.endswith(".committed"))
    for job in jobs:
        publish(root, job)
    return jobs


@dataclass
class Staged(WriterCommitMessage):
    task: str
    documents: int


class _Writer:
    """What batch and stream writers share."""

    def __init__(self, root: str, job: str):
        self.root, self.job = root.rstrip("/"), job

    def stage(self, job: str, batches: Iterator[pa.RecordBatch]) -> Staged:
        ctx = TaskContext.get()
        task = f"{ctx.partitionId() if ctx else 0:06d}-{ctx.taskAttemptId() if ctx else 0}"
        fs, base = pafs.FileSystem.from_uri(self.root)
        staged = f"{hidden_folder(base)}/staging/{job}/{task}"
        fs.create_dir(staged, recursive=True)
        k, seen = 0, set()
        with fs.open_output_stream(f"{staged}/manifest") as manifest:
            for batch in batches:
                names = batch.column(batch.schema.get_field_index("name"))
                contents = batch.column(batch.schema.get_field_index("content"))
                for name, content in zip(names.to_pylist(), contents, strict=True):
                    if safe(name) in seen:
                        raise ValueError(f"two documents of the name {name!r}")
                    seen.add(name)
                    data = content.as_py()
                    if data is None:
                        raise ValueError(f"a document without content: {name!r}")
                    data = data.encode() if isinstance(data, str) else bytes(data)
                    _write(fs, f"{staged}/{k}", data)
                    manifest.write(json.dumps({"name": name, "bytes": len(data)}).encode() + b"\n")
                    k += 1
        return Staged(task, k)

    def end(self, job: str, messages: list) -> None:
        fs, base = pafs.FileSystem.from_uri(self.root)
        hidden = hidden_folder(base)
        if _exists(fs, f"{hidden}/jobs/{job}") and not _exists(fs, f"{hidden}/{job}.committed"):
            self.drop(job)  # it was run before
            return
        fs.create_dir(hidden, recursive=True)
        part = f"{hidden}/{job}.{uuid.uuid4().hex}.part"
        _write(fs, part, json.dumps([m.task for m in messages if m is not None]).encode())
        fs.move(part, f"{hidden}/{job}.committed")
        publish(self.root, job)

    def drop(self, job: str) -> None:
        fs, base = pafs.FileSystem.from_uri(self.root)
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(f"{hidden_folder(base)}/staging/{job}")


class BatchWriter(_Writer, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.stage(self.job, iterator)

    def commit(self, messages: list) -> None:
        self.end(self.job, messages)

    def abort(self, messages: list) -> None:
        self.drop(self.job)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    """A batch's staging has an id of its own run; its job is its number."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.stage(f"{self.job}-open", iterator)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 - as the interface has it
        fs, base = pafs.FileSystem.from_uri(self.root)
        hidden, job = hidden_folder(base), f"{self.job}-{batchId}"
        for m in messages:
            if m is not None and not _exists(fs, f"{hidden}/jobs/{job}"):
                fs.create_dir(f"{hidden}/staging/{job}", recursive=True)
                _move(fs, f"{hidden}/staging/{self.job}-open/{m.task}", f"{hidden}/staging/{job}/{m.task}")
        self.end(job, messages)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.drop(f"{self.job}-open")


class DocumentSink(DataSource):
    """``df.write.format("tessera_documents").mode("append").save(root)`` of (name, content) rows."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _root(self) -> str:
        root = self.options.get("path")
        if not root:
            raise ValueError("a root is needed: save(root)")
        return root if "://" in root else f"file://{root}"

    def _checked(self, schema, overwrite: bool) -> None:
        kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        if set(kinds) != {"name", "content"} or kinds["name"] != "string" or kinds["content"] not in ("string", "binary"):
            raise ValueError(f"documents have the columns name (string) and content (string or binary), not {kinds}")
        if overwrite:
            raise ValueError("documents replace those of their names: use the mode append")

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        self._checked(schema, overwrite)
        recover(self._root())
        return BatchWriter(self._root(), self.options.get("job") or uuid.uuid4().hex)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:  # noqa: N802
        self._checked(schema, overwrite)
        recover(self._root())
        return StreamWriter(self._root(), self.options.get("job") or "stream")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentSink)


def write_documents(rows: DataFrame, root: str, name: str = "name", content: str = "content", job: str | None = None) -> DataFrame:
    """Write a document for each row, now; returns (name, bytes) as the job's manifests have them."""
    spark, job = rows.sparkSession, job or uuid.uuid4().hex
    register(spark)
    kind = rows.schema[content].dataType.simpleString()
    documents = rows.select(F.col(name).cast("string").alias("name"), (F.col(content) if kind == "binary" else F.col(content).cast("string")).alias("content"))
    documents.write.format(NAME).option("job", job).mode("append").save(root)
    return spark.read.schema("name string, bytes long").json(f"{hidden_folder(root)}/jobs/{job}")
