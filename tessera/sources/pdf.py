"""Page counts and page geometry of PDFs by their cross references, and pages as a data source (SRC13 to SRC15).

A file is read backwards: the last ``startxref`` names the newest section of cross references, a
table or a stream, each section names the one before it, and the first mention of an object counts.
From the catalogue the page tree is walked; a page is a node without children.  Objects may stand in
compressed object streams.  Pages outside a wanted range are passed over by the counts of their nodes.

Pages as rows: ``spark.read.format("tessera_pdf_pages")`` has a partition for every few pages of a
document, and takes comparisons of ``page`` and equality of ``doc_id`` as filters, so that only pages
that are selected are planned and read.  Errors of one file (encrypted object streams, cut or
looping trees, missing objects) are rows of ``page_counts``, and fail a read of that file's pages.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tessera.sources.ranged import THREADS, Broken, Bytes, each_file, opened, uri

NAME = "tessera_pdf_pages"
#: An object may have that many bytes; the tree that many levels.
LARGEST, DEEPEST = 1 << 27, 200
TOKEN = re.compile(rb"(?:[\x00\t\n\f\r ]|%[^\r\n]*)*(<<|>>|\[|\]|/[^\x00\t\n\f\r ()<>\[\]{}/%]*|\((?=.)|<[0-9A-Fa-f\s]*>|[^\x00\t\n\f\r ()<>\[\]{}/%]+)", re.DOTALL)


@dataclass(frozen=True)
class Ref:
    number: int


class Cut(Broken):
    """The bytes at hand end before the object does."""


def _string(data: bytes, at: int) -> int:
    """The end of a string whose bracket stands before ``at``; brackets nest, a backslash hides one."""
    depth = 1
    while depth:
        m = re.compile(rb"[()\\]").search(data, at)
        if not m:
            raise Cut("a string without an end")
        depth += {b"(": 1, b")": -1}.get(m[0], 0)
        at = m.end() + (m[0] == b"\\")
    return at


def parse(data: bytes, at: int = 0):
    """(value, end) of the object at ``at``: dict, list, Ref, number, name or string as bytes, or None."""
    stack: list[list] = [[]]
    opened_at = []
    while True:
        m = TOKEN.match(data, at)
        if not m or (m.end() == len(data) and m[1] not in (b">>", b"]")):
            raise Cut("an object without an end")
        token, at = m[1], m.end()
        if token in (b"<<", b"["):
            stack.append([])
            opened_at.append(token)
            continue
        if token in (b">>", b"]"):
            if not opened_at or (opened_at.pop() == b"<<") != (token == b">>"):
                raise Broken("brackets that don't match")
            items = stack.pop()
            value = items if token == b"]" else dict(zip(items[::2], items[1::2], strict=False))
        elif token[:1] == b"(":
            end = _string(data, at)
            value, at = data[at : end - 1], end
        elif token == b"R" and len(stack[-1]) > 1 and type(stack[-1][-2]) is int:
            stack[-1].pop()
            value = Ref(stack[-1].pop())
        elif token in (b"true", b"false", b"null"):
            value = {b"true": True, b"false": False}.get(token)
        else:
            value = token
            if re.fullmatch(rb"[+-]?\d+", token):
                value = int(token)
            elif re.fullmatch(rb"[+-]?\d*\.\d*", token) and len(token) > 1:
                value = float(token)
        stack[-1].append(value)
        if len(stack) == 1:
            if type(value) is int and re.match(rb"\s*\d+\s+R\b", data[at : at + 20]):
                continue
            return value, at


def unpredicted(data: bytes, columns: int) -> bytes:
    """Rows of a stream whose bytes are differences to their neighbours (PNG predictors)."""
    out, above = bytearray(), bytes(columns)
    for k in range(0, len(data) - columns, columns + 1):
        kind, row = data[k], bytearray(data[k + 1 : k + 1 + columns])
        for i in range(columns):
            left, up, corner = row[i - 1] if i else 0, above[i], above[i - 1] if i else 0
            near = min((abs(up - corner), 0, left), (abs(left - corner), 1, up), (abs(left + up - 2 * corner), 2, corner))[2]
            row[i] = (row[i] + (0, left, up, (left + up) // 2, near)[kind if kind < 5 else 0]) % 256
        out += row
        above = bytes(row)
    return bytes(out)


class Document:
    def __init__(self, data: Bytes):
        self.data, self.places, self.streams, self.trailer = data, {}, {}, {}
        tail = data.at(max(0, data.size - 2048), min(2048, data.size))
        found = re.findall(rb"startxref\s+(\d+)", tail)
        if not found:
            raise Broken("no cross references")
        todo, seen = [int(found[-1])], set()
        while todo:
            at = todo.pop(0)
            if at in seen:
                continue
            seen.add(at)
            trailer = self._section(at)
            self.trailer = {**trailer, **self.trailer}
            todo += [trailer[k] for k in (b"/XRefStm", b"/Prev") if type(trailer.get(k)) is int]

    def _parsed(self, at: int):
        """(value, bytes that follow it, their offset) of the object there, read in growing parts."""
        size = 512
        while True:
            size = min(size * 4, self.data.size - at)
            if size <= 0:
                raise Broken(f"nothing at {at}")
            part = self.data.at(at, size)
            try:
                value, end = parse(part)
                if len(part) - end < 20 and at + size < self.data.size:
                    raise Cut("what follows isn't at hand")
                return value, part[end:], at + end
            except Cut:
                if at + size >= self.data.size or size >= LARGEST:
                    raise

    def _section(self, at: int) -> dict:
        begun = self.data.at(at, min(64, self.data.size - at)).lstrip()
        if begun.startswith(b"xref"):
            return self._table(at)
        what, stream = self._indirect(at)
        widths, n = what[b"/W"], what[b"/Size"]
        rows, step = self._inflated(what, stream), sum(widths)
        index = what.get(b"/Index") or [0, n]
        k = 0
        for first, many in zip(index[::2], index[1::2], strict=True):
            for number in range(first, first + many):
                row, k = rows[k * step : (k + 1) * step], k + 1
                if len(row) < step:
                    raise Broken("a stream of cross references that is cut off")
                a, b = widths[0], widths[0] + widths[1]
                kind = int.from_bytes(row[:a], "big") if a else 1
                self.places.setdefault(number, (kind, int.from_bytes(row[a:b], "big"), int.from_bytes(row[b:], "big")))
        return what

    def _table(self, at: int) -> dict:
        size = 4096
        while True:
            part = self.data.at(at, min(size, self.data.size - at))
            end = part.find(b"trailer")
            if end >= 0:
                break
            if at + size >= self.data.size or size >= LARGEST:
                raise Broken("a table of cross references without a trailer")
            size *= 4
        lines = part[:end].split()[1:]
        k = 0
        while k + 1 < len(lines):
            first, many = int(lines[k]), int(lines[k + 1])
            k += 2
            for number in range(first, first + many):
                offset, _, kind = lines[k : k + 3]
                self.places.setdefault(number, (int(kind == b"n"), int(offset), 0))
                k += 3
        value, _, _ = self._parsed(at + end + len(b"trailer"))
        if not isinstance(value, dict):
            raise Broken("a trailer that is no dictionary")
        return value

    def _indirect(self, at: int):
        """(value, where its stream begins or None) of ``n g obj ...`` there."""
        head = re.match(rb"\s*\d+\s+\d+\s+obj", self.data.at(at, min(64, self.data.size - at)))
        if not head:
            raise Broken(f"no object at {at}")
        value, rest, end = self._parsed(at + head.end())
        m = re.match(rb"\s*stream\r?\n", rest)
        return value, end + m.end() if m else None

    def _inflated(self, what: dict, begin: int | None) -> bytes:
        length = self.value(what.get(b"/Length"))
        if begin is None or type(length) is not int or length > LARGEST:
            raise Broken("an object that should be a stream")
        data = self.data.at(begin, length)
        filters = self.value(what.get(b"/Filter"))
        filters = filters if isinstance(filters, list) else [filters] if filters else []
        if filters not in ([], [b"/FlateDecode"]):
            raise Broken(f"a stream coded by {filters}")
        try:
            data = zlib.decompress(data) if filters else data
        except zlib.error as e:
            raise Broken(f"a stream that can't be unpacked: {e}") from None
        how = self.value(what.get(b"/DecodeParms"))
        how = how[0] if isinstance(how, list) and how else how
        return unpredicted(data, how.get(b"/Columns", 1)) if isinstance(how, dict) and how.get(b"/Predictor", 1) >= 10 else data

    def value(self, x):
        """What a reference stands for; anything else itself."""
        for _ in range(DEEPEST):
            if not isinstance(x, Ref):
                return x
            kind, a, b = self.places.get(x.number, (0, 0, 0))
            if kind == 1:
                x = self._indirect(a)[0]
            elif kind == 2:
                if a not in self.streams:
                    kind, at, _ = self.places.get(a, (0, 0, 0))
                    if kind != 1:
                        raise Broken(f"no object stream {a}")
                    what, begin = self._indirect(at)
                    data = self._inflated(what, begin)
                    numbers = [int(n) for n in data[: what[b"/First"]].split()]
                    self.streams[a] = {n: what[b"/First"] + o for n, o in zip(numbers[::2], numbers[1::2], strict=True)}, data + b" "
                places, data = self.streams[a]
                x = parse(data, places[x.number])[0] if x.number in places else None
            else:
                x = None
        raise Broken("references that run in a circle")

    def pages(self, first: int = 1, last: int | None = None) -> Iterator[tuple[int, dict]]:
        """(number, node with what it inherits) of the pages of a range; numbers begin at 1."""
        catalogue = self.value(self.trailer.get(b"/Root"))
        root = catalogue.get(b"/Pages") if isinstance(catalogue, dict) else None
        number, todo, seen = 0, [(root, {}, 0)], set()
        while todo:
            ref, given, depth = todo.pop()
            if isinstance(ref, Ref):
                if ref in seen or depth > DEEPEST:
                    raise Broken("a page tree that runs in a circle")
                seen.add(ref)
            node = self.value(ref)
            if not isinstance(node, dict):
                raise Broken("a page that isn't there")
            given = {**given, **{k: node[k] for k in (b"/MediaBox", b"/Rotate") if k in node}}
            kids = self.value(node.get(b"/Kids"))
            if kids is None:
                number += 1
                if number >= first:
                    yield number, given
            else:
                many = self.value(node.get(b"/Count"))
                if type(many) is int and 0 <= many < first - number:
                    number += many  # all before the range
                else:
                    todo += [(k, given, depth + 1) for k in reversed(kids)]
            if last is not None and number >= last:
                return

    def size(self, node: dict) -> tuple[float, float, int]:
        """(width, height, rotation) of a page in points, as it is shown."""
        box = [self.value(x) for x in self.value(node.get(b"/MediaBox")) or [0, 0, 612, 792]]
        if len(box) != 4 or not all(isinstance(x, (int, float)) for x in box):
            raise Broken(f"a page of the size {box}")
        turn = self.value(node.get(b"/Rotate")) or 0
        width, height = abs(float(box[2]) - box[0]), abs(float(box[3]) - box[1])
        return (height, width, turn % 360) if turn % 180 else (width, height, turn % 360)


def _checked(look):
    """Errors of values that aren't of their kind are the file's."""

    def checked(data: Bytes):
        try:
            return look(data)
        except (KeyError, TypeError, ValueError, IndexError, AttributeError, RecursionError) as e:
            raise e if isinstance(e, Broken) else Broken(f"{type(e).__name__}: {e}") from None

    return checked


@_checked
def count(data: Bytes) -> int:
    """Pages by walking the whole tree, whatever its counts say."""
    return sum(1 for _ in Document(data).pages())


def page_counts(files: DataFrame, column: str = "path") -> DataFrame:
    """Files, by path or content, with their number of pages, or null and the error."""
    return each_file(files, column, lambda data: (count(data),), "int", ["pages"], (None,))


@dataclass
class PageRange(InputPartition):
    path: str
    first: int
    last: int


class PagesReader(DataSourceReader):
    SCHEMA = "doc_id string, page int, width_pt double, height_pt double, rotation int, pixel_width int, pixel_height int"

    def __init__(self, options: dict):
        self.root, self.dpi = options["path"], int(options.get("dpi", 150))
        self.side, self.many = int(options.get("max_side", 0)), int(options.get("pages_per_task", 64))
        if min(self.dpi, self.many) < 1:
            raise ValueError("dpi and pages_per_task must be positive")
        self.first, self.last, self.only, self.docs = 1, None, None, None

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802 - as the interface has it
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if name == "page" and isinstance(f, (EqualTo, In)):
                wanted = set(f.value if isinstance(f, In) else [f.value])
                self.only = wanted if self.only is None else self.only & wanted
            elif name == "page" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            elif name == "page" and isinstance(f, (LessThan, LessThanOrEqual)):
                last = f.value - isinstance(f, LessThan)
                self.last = last if self.last is None else min(self.last, last)
            elif name == "doc_id" and isinstance(f, (EqualTo, In)):
                wanted = set(f.value if isinstance(f, In) else [f.value])
                self.docs = wanted if self.docs is None else self.docs & wanted
            else:
                yield f  # Spark looks at it

    def _files(self) -> list[str]:
        fs, base = pafs.FileSystem.from_uri(uri(self.root))
        info = fs.get_file_info(base)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True))
        scheme = uri(self.root)[: -len(base)] if uri(self.root).endswith(base) else "file://"
        return sorted(scheme + x.path for x in found if x.type == pafs.FileType.File and x.path.lower().endswith(".pdf"))

    def _pages(self, path: str) -> list[PageRange]:
        f, data = opened(path)
        with f:
            n = count(data)
        last = n if self.last is None else min(n, self.last)
        if self.only is not None:
            wanted = sorted(p for p in self.only if p is not None and self.first <= p <= last)
        else:
            wanted = range(self.first, last + 1)
        parts = [wanted[k : k + self.many] for k in range(0, len(wanted), self.many)]
        return [PageRange(path, a, b) for part in parts for a, b in _runs(part)]

    def partitions(self) -> list[PageRange]:
        paths = [p for p in self._files() if self.docs is None or p in self.docs]
        with ThreadPoolExecutor(THREADS) as pool:
            return [r for found in pool.map(self._pages, paths) for r in found]

    def read(self, partition: PageRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        f, data = opened(partition.path)
        with f:
            document, rows = Document(data), []
            for page, node in document.pages(partition.first, partition.last):
                width, height, turn = document.size(node)
                w, h = (max(1, round(x * self.dpi / 72)) for x in (width, height))
                if self.side and max(w, h) > self.side:
                    scale = self.side / max(w, h)
                    w, h = (max(1, round(x * scale)) for x in (w, h))
                rows.append((partition.path, page, width, height, turn, w, h))
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        names = [c.split()[0] for c in self.SCHEMA.split(", ")]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _runs(pages) -> list[tuple[int, int]]:
    """Consecutive pages as ranges."""
    out = []
    for p in pages:
        if out and out[-1][1] == p - 1:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


class PdfPages(DataSource):
    """Pages of the PDFs of a folder, or of one, with their size in points and in pixels of an image.

    Options: ``dpi`` (150), ``max_side`` (0: as large as it is), ``pages_per_task`` (64).
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PagesReader.SCHEMA

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))


def read_pages(spark: SparkSession, root: str, **options) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PdfPages)
    return spark.read.format(NAME).options(**options).load(root)
