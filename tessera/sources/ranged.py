"""Reads of parts of files, so that a header costs a few kilobytes of a file of any size."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

#: A read brings that many bytes at least; files of a task are read so many at a time.
AHEAD, THREADS = 1 << 14, 16


class Broken(ValueError):
    """A file that isn't what its format says."""


class Bytes:
    """Bytes by offset, of a file or of a value in memory."""

    def __init__(self, size: int, fetch: Callable[[int, int], bytes]):
        self.size, self.fetch = size, fetch
        self.begin, self.held, self.reads = 0, b"", 0

    @classmethod
    def of(cls, data: bytes) -> Bytes:
        return cls(len(data), lambda at, n: data[at : at + n])

    def at(self, offset: int, n: int) -> bytes:
        """Exactly ``n`` bytes, or an error."""
        if offset < 0 or n < 0 or offset + n > self.size:
            raise Broken(f"{n} bytes at {offset} are outside a file of {self.size}")
        if not (self.begin <= offset and offset + n <= self.begin + len(self.held)):
            self.begin, self.held = offset, self.fetch(offset, min(max(n, AHEAD), self.size - offset))
            self.reads += 1
            if len(self.held) < n:
                raise Broken(f"only {len(self.held)} of {n} bytes could be read at {offset}")
        return self.held[offset - self.begin : offset - self.begin + n]


def uri(path: str) -> str:
    """The path of a Spark listing as Arrow takes it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else f"file://{path}"


def opened(path: str):
    """(file, Bytes) of a path; close the file."""
    fs, name = pafs.FileSystem.from_uri(uri(path))
    f = fs.open_input_file(name)
    return f, Bytes(f.size(), lambda at, n: f.read_at(n, at))


def each_file(files: DataFrame, column: str, look: Callable[[Bytes], tuple], schema: str, names: list[str], missing: tuple) -> DataFrame:
    """``look`` at every file of ``column``, paths or contents, many at a time; (column, *schema, error).

    A file that is broken or can't be read has ``missing`` and its error.
    """
    content = files.schema[column].dataType.simpleString() == "binary"
    others = [c for c in files.columns if c != column]

    def told(value) -> tuple:
        f = None
        try:
            if value is None:
                raise Broken("no file")
            f, data = (None, Bytes.of(value)) if content else opened(value)
            return (*look(data), None)
        except (Broken, OSError, struct.error) as e:
            return (*missing, f"{type(e).__name__}: {e}")
        finally:
            if f is not None:
                f.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(1 if content else THREADS) as pool:
            for batch in batches:
                values = batch.column(batch.schema.get_field_index(column)).to_pylist()
                found = list(pool.map(told, values)) or [()] * 0
                columns = list(zip(*found, strict=True)) if found else [()] * (len(names) + 1)
                kept = [batch.column(batch.schema.get_field_index(c)) for c in (others if content else [column, *others])]
                kinds = [_KINDS[k] for k in schema.split(",")]
                made = [pa.array(list(c), t) for c, t in zip(columns, [*kinds, pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*(others if content else [column, *others]), *names, "error"])

    kept = others if content else [column, *others]
    told_schema = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in kept)
    told_schema += "".join(f", {n} {k}" for n, k in zip([*names, "error"], [*schema.split(","), "string"], strict=True))
    return files.select(column, *others).mapInArrow(run, told_schema.removeprefix(", "))


_KINDS = {"double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
