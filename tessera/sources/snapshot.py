"""Snapshots of remote datasets that go on where they stopped (SRC10).

A snapshot is files of a revision below a root.  Files are fetched in parts; below ``.cache`` of the root

``parts/KEY``        a fetched part, under a key of path, revision, place and length
``done/KEY.json``    path, revision and size of a file that is whole

A part is written aside and renamed, so it is there whole or not at all; a part or file that is there is
never fetched again unless forced.  Spark plans: files without their mark, their parts less those that
are there, dealt out to as many tasks as there are workers.  A file is put together by one task, part
after part, and renamed; its mark follows, and only then do its parts go.  So a run that broke off at
any point leaves a state that the next one goes on from, and readers see whole files only.

A file of another revision or size is fetched anew.  Two runs at once may fetch the same part twice,
with the same result.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import posixpath
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import document_sink, scans, sinks

#: Gets (path, revision, offset, length), gives the bytes.
Fetch = Callable[[str, str, int, int], bytes]
WORKERS, PART = 8, 8 << 20


def _key(*parts) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def part_key(path: str, revision: str, offset: int, length: int) -> str:
    return _key(path, revision, offset, length)


def _there(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """(key) of what a folder of the cache holds; a listing, nothing is read."""
    fs, base = pafs.FileSystem.from_uri(f"{root}/.cache/{folder}")
    fs.create_dir(base, recursive=True)
    found = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(f"{root}/.cache/{folder}")
    return found.select(F.regexp_extract("path", r"([0-9a-f]{64})(\.json)?$", 1).alias("key")).where("key <> ''")


def _each(rows: DataFrame, work: Callable[..., None], names: list[str]) -> int:
    """Work on every row in the tasks; how many there were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
                work(*row)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return rows.select(*names).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def download(files: DataFrame, root: str, revision: str, fetch: Fetch, workers: int = WORKERS, part_bytes: int = PART, force: bool = False) -> dict[str, int]:
    """Make a snapshot of ``files`` (path, size); returns how many parts were fetched and files put together."""
    if workers < 1 or part_bytes < 1:
        raise ValueError("workers and part_bytes must be positive")
    spark = files.sparkSession
    root = sinks.rooted(spark, root).rstrip("/")
    size = F.when(F.col("size") >= 0, F.col("size").cast("long")).otherwise(F.raise_error(F.concat(F.lit("a file without a size: "), F.coalesce("path", F.lit("?")))))
    listed = files.select(F.col("path").cast("string").alias("path"), size.alias("size"))
    mark = F.udf(lambda p, n: _key(document_sink.safe(p), revision, n), "string")  # fails on a path that leaves the root
    todo = listed.distinct().withColumn("done", mark("path", "size"))
    if not force:
        todo = todo.join(_there(spark, root, "done").withColumnRenamed("key", "done"), "done", "left_anti")
    todo = scans.kept(todo.select("path", "size"), "snapshot")  # what is done must not change while parts are joined

    key = F.udf(lambda p, a, n: part_key(p, revision, a, n), "string")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(part_bytes).cast("long")))
    parts = todo.select("path", "size", starts.alias("offset")).withColumn("length", F.least(F.lit(part_bytes), F.col("size") - F.col("offset"))).withColumn("key", key("path", "offset", "length"))
    missing = parts if force else parts.join(_there(spark, root, "parts"), "key", "left_anti")

    def bring(path: str, offset: int, length: int, name: str) -> None:
        data = fetch(path, revision, offset, length) if length else b""
        if len(data) != length:
            raise OSError(f"{path}: {len(data)} of {length} bytes came at {offset}")
        sinks.put(f"{root}/.cache/parts/{name}", data)

    fetched = _each(missing.repartition(workers, "key"), bring, ["path", "offset", "length", "key"])

    def join(path: str, size: int) -> None:
        fs, base = pafs.FileSystem.from_uri(root)
        names = [f"{base}/.cache/parts/{part_key(path, revision, a, min(part_bytes, size - a))}" for a in range(0, max(size, 1), part_bytes)]
        target = f"{base}/{path}"
        fs.create_dir(posixpath.dirname(target), recursive=True)
        with fs.open_output_stream(f"{base}/.cache/{_key(path)}.tmp") as out:
            for name in names:
                with fs.open_input_file(name) as f:
                    out.write(f.read())
        fs.move(f"{base}/.cache/{_key(path)}.tmp", target)
        sinks.put(f"{root}/.cache/done/{_key(path, revision, size)}.json", json.dumps({"path": path, "revision": revision, "size": size}).encode())
        for name in names:
            with contextlib.suppress(FileNotFoundError):
                fs.delete_file(name)

    return {"parts": fetched, "files": _each(todo.repartition(workers, "path"), join, ["path", "size"])}
