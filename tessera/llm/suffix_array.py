"""Suffix-array deduplication of documents by column-wise construction (operator 7).

Each byte covered by a string of 50 bytes that also starts in a document with a smaller key goes.

1. Nomination.  From each window of 50 bytes a shorter gram is chosen by its least hash; equal
   windows choose alike.  Grams go to buckets by hash; those of two documents or more come back.
2. Construction.  Around each such gram the windows that chose it form one string of bytes.  The
   strings of a bucket are a collection whose Burrows-Wheeler transform is built column by
   column: each round inserts one symbol of every string, from their ends, by one sequential pass
   over the transform so far, read from one external file and written to another.  Walking the
   finished transform gives the sorted order of all suffixes, and one pass over neighbours in
   that order the common prefixes, up to the window.
3. Removal.  In an interval of suffixes with 50 bytes in common, every window of a document that
   isn't the least of the interval is marked, and the marks meet the texts again.

Where it is large: one exchange of about a sixteenth of the places of the texts, one of the texts
that is used twice, one of the compressed strings.  Equal strings of one chunk of text go to their
bucket once, for the least document, and a gram that a task has often met is settled there, so a
frequent passage reaches a bucket a few times a task.  A collection has a bounded number of strings
(more only where one gram alone has more), so its files are small.

Defined results: a null text is empty; a row with a null key is returned unjudged; rows that
repeat a key and a text are one document, each of them returned; rows that share a key only are
documents of their own, in the order of a hash of their texts; a string that repeats only within
its own document stays; a text of any length is one document, worked on alone where it is longer
than a piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, kernels
from tessera.llm.substring import ENTRY_SQL, HIT, HIT_SQL, REMEMBERED, _keys, by_document, doc_bucket, hit_rows, packed, unpacked

WINDOW = 50
GRAM = 20
#: Bytes of text that one pass works on: repeats within them are settled before any shuffle.
PIECE_BYTES = 3 << 20
#: Strings that one collection has at most, and so the bytes that its files hold.
COLLECTION = 3200

STRINGS = pa.schema([("bucket", pa.int32()), ("h", pa.binary()), ("d", pa.binary()), ("p", pa.binary()), ("size", pa.binary()), ("data", pa.binary()), ("settled", pa.bool_())])
STRINGS_SQL = "bucket int, h binary, d binary, p binary, size binary, data binary, settled boolean"

# ---- the transform ---------------------------------------------------------------------------


class Columns:
    """Two external files that take turns: one is read front to back, the other written.

    They lie in a shared folder, under a name of this attempt, and go when it ends.  Where that
    folder is mounted they stay open and are overwritten from their beginnings.
    """

    def __init__(self, uri: str):
        self.fs, folder = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(folder, recursive=True)
        name = uuid4().hex
        self.files = [f"{folder}/{name}-{k}" for k in range(2)]
        self.size = 0
        self.opened = [open(f, "w+b", buffering=0) for f in self.files] if self.fs.type_name == "local" else []

    def put(self, data: np.ndarray) -> None:
        self.files.reverse()
        self.opened.reverse()
        self.size = len(data)
        if not self.opened:
            with self.fs.open_output_stream(self.files[0], buffer_size=None) as out:
                out.write(data)
            return
        self.opened[0].seek(0)
        left = memoryview(data)
        while len(left):
            left = left[self.opened[0].write(left) :]

    def get(self) -> np.ndarray:
        if not self.opened:
            with self.fs.open_input_stream(self.files[0], buffer_size=None) as f:
                return np.frombuffer(f.read(), np.uint8)
        data = np.empty(self.size, np.uint8)
        self.opened[0].seek(0)
        left = memoryview(data)
        while len(left):
            got = self.opened[0].readinto(left)
            if not got:
                raise EOFError(f"{self.files[0]} ends early")
            left = left[got:]
        return data

    def close(self) -> None:
        for f in self.opened:
            f.close()
        for name in self.files:
            if self.fs.get_file_info(name).type == pafs.FileType.File:
                self.fs.delete_file(name)


def column_bwt(data: np.ndarray, off: np.ndarray, files: Columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, start and string of each suffix in sorted order) of a collection of byte strings.

    Symbols are the bytes plus 1; 0 ends each string, and ends sort by the number of the string.
    Round r inserts the suffix of length r of every string that has one.  Its place follows from
    the transform alone: suffixes that begin with one symbol stand in the order of that symbol in
    the transform.  A string's end stands where its whole suffix is, so nothing follows it.
    """
    n = np.diff(off)
    m, ends, rounds = len(n), off[1:], int(n.max(initial=0))
    rank = np.zeros(256, np.uint8)
    used = np.unique(data)
    if len(used) == 256:
        raise ValueError("a collection must leave one byte value free")
    rank[used] = np.arange(1, len(used) + 1)
    text = rank[data]
    numbers = np.arange(len(data) + m, dtype=np.int32)
    place = np.empty(len(data) + m, np.int32)
    # round 0: the empty suffixes, preceded by the last symbol of each string
    last = np.zeros(m, np.uint8)
    last[n > 0] = text[ends[n > 0] - 1]
    files.put(last)
    at = np.arange(m)  # where the newest suffix of each string stands
    live = np.flatnonzero(n > 0)
    for r in range(1, rounds + 1):
        bwt = files.get()
        size = len(bwt)
        # place of c S: the ends come first, then suffixes by first symbol, then as in the transform
        place[np.argsort(bwt, kind="stable")] = numbers[:size]
        spot = place[at[live]] + (m - size + np.count_nonzero(bwt))
        following = np.zeros(len(live), np.uint8)
        more = n[live] > r
        following[more] = text[ends[live[more]] - r - 1]
        grown = np.empty(size + len(live), np.uint8)
        old = np.ones(len(grown), bool)
        old[spot] = False
        grown[old] = bwt
        grown[spot] = following
        files.put(grown)
        at[live] = spot
        live = live[more]
    bwt = files.get()
    # walk every string back from its end: the place of each of its suffixes
    place[np.argsort(bwt, kind="stable")] = numbers[: len(bwt)]
    place += m - len(bwt) + np.count_nonzero(bwt)
    start, string = np.empty(len(bwt), np.int64), np.empty(len(bwt), np.int64)
    at, live = np.arange(m), np.arange(m)
    start[at], string[at] = ends, live
    for r in range(1, rounds + 1):
        live = live[n[live] >= r]
        at[live] = place[at[live]]
        start[at[live]], string[at[live]] = ends[live] - r, live
    return bwt, start, string


def shared_prefix(data: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Whether each suffix has its first ``width`` bytes in common with the one before it."""
    out = np.zeros(len(start), bool)
    for at in range(1, len(start), 1 << 14):
        a, b = start[at - 1 : at - 1 + (1 << 14)], start[at : at + (1 << 14)]
        a = a[: len(b)]
        same = np.ones(len(b), bool)
        live = np.arange(len(b))
        for k in range(0, width, 10):
            cols = np.arange(k, min(k + 10, width))
            ok = (data[a[live][:, None] + cols] == data[b[live][:, None] + cols]).all(axis=1)
            same[live[~ok]] = False
            live = live[ok]
        out[at : at + len(b)] = same
    return out


def marked_windows(data: np.ndarray, off: np.ndarray, doc: np.ndarray, width: int, files: Columns) -> tuple[np.ndarray, np.ndarray]:
    """(start in ``data``, string) of windows inside the strings that a smaller document has as well."""
    _, start, row = column_bwt(data, off, files)
    whole = start + width <= off[row + 1]
    start, row = start[whole], row[whole]
    if not len(start):
        return start, row
    new = ~shared_prefix(data, start, width)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[row], np.flatnonzero(new))
    hit = doc[row] > least[group]
    return start[hit], row[hit]


# ---- nomination ------------------------------------------------------------------------------


def _grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, seen = kernels.Rolling(71), np.zeros(0, np.uint64)
        for batch in batches:
            keys, valid = _keys(batch)
            for i, j, off, raw in kernels.pieces(batch.column(1), PIECE_BYTES):
                g = roll.windows(roll.prefix(raw), GRAM)
                at, _, _ = kernels.anchors(g, off, WINDOW, GRAM)
                row = np.searchsorted(off, at, side="right") - 1
                ok = valid[i:j][row]
                at, row = at[ok], row[ok]
                if not len(at):
                    continue
                h, d, p = g[at], keys[i:j][row], at - off[row]
                # a gram of two documents of this chunk is settled here; one of it goes on
                order = np.lexsort((d, h))
                pair = (h[order][1:] == h[order][:-1]) & (d[order][1:] != d[order][:-1])
                both = np.unique(h[order][1:][pair])
                again, known = np.zeros(len(h), bool), np.zeros(len(h), bool)
                for values, flag in ((both, again), (seen, known)):
                    if len(values):
                        place = np.minimum(np.searchsorted(values, h), len(values) - 1)
                        flag |= values[place] == h
                settled = again | known
                none = np.zeros(settled.sum(), np.uint8)
                if settled.any():
                    yield packed(doc_bucket(d[settled], n), none, none, d[settled], p[settled], True)
                send = ~settled
                send[np.flatnonzero(again & ~known)[np.unique(h[again & ~known], return_index=True)[1]]] = True
                if send.any():
                    short = (h[send] >> np.uint64(32)).astype(np.uint32)  # with the bucket enough to nominate
                    yield packed((h[send] % np.uint64(n)).astype(np.int32), short, np.zeros(send.sum(), np.uint8), d[send], p[send], False)
                if len(both) and len(seen) < REMEMBERED:
                    seen = np.union1d(seen, both)

    return run


def _nominate(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                if one.column(6)[0].as_py():
                    _, _, d, p = unpacked([one], np.uint8, np.uint8)
                    yield from hit_rows(d, p, n)
                else:
                    have.setdefault(one.column(0)[0].as_py(), []).append(one)
        for parts in have.values():
            h, _, d, p = unpacked(parts, np.uint32, np.uint8)
            order = np.lexsort((d, h))
            h, d, p = h[order], d[order], p[order]
            group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
            several = np.zeros(group[-1] + 1, bool)
            several[group[1:][(h[1:] == h[:-1]) & (d[1:] != d[:-1])]] = True
            hit = several[group]
            yield from hit_rows(d[hit], p[hit], n)

    return run


# ---- construction ----------------------------------------------------------------------------


def _strings(n: int):
    """From (doc_id, text, hits) to the strings around the hits, compressed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, check = kernels.Rolling(71), kernels.Rolling(72)
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            keys, _ = _keys(batch)
            hits = batch.column(2)
            for i, j, off, raw in kernels.pieces(batch.column(1), PIECE_BYTES):
                marked = np.zeros(len(raw) + 1, bool)
                for k, own in enumerate(hits.slice(i, j - i).to_pylist()):
                    if own:
                        at = off[k] + np.frombuffer(own, np.int32)
                        marked[at[at < off[k + 1]]] = True
                prefix = roll.prefix(raw)
                g = roll.windows(prefix, GRAM)
                at, a, b = kernels.anchors(g, off, WINDOW, GRAM)
                take = marked[at]
                at, a, b = at[take], a[take], b[take]
                if not len(at):
                    continue
                row = np.searchsorted(off, at, side="right") - 1
                h, d, p, e = g[at], keys[i:j][row], a - off[row], b + WINDOW
                # equal strings of this chunk: the least document's goes on, all windows of the others are repeats
                own = roll.spans(prefix, a, e)
                again = check.spans(check.prefix(raw), a, e)
                order = np.lexsort((p, d, again, own))
                new = np.concatenate([[True], (own[order][1:] != own[order][:-1]) | (again[order][1:] != again[order][:-1])])
                lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                done = np.zeros(len(at), bool)
                done[order] = d[order] > d[lead]
                if done.any():
                    for cut in hit_rows(d[done], p[done], n, p[done] + (e - a)[done]):
                        k = cut.num_rows
                        yield common.rows(STRINGS, cut.column(0), [b""] * k, cut.column(1), cut.column(3), cut.column(2), cut.column(4), [True] * k)
                send = np.flatnonzero(~done)
                bucket = (h[send] % np.uint64(n)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                send, bucket = send[by], bucket[by]
                edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                cols: list[list] = [[] for _ in range(6)]
                for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    s = send[x:y]
                    size = (e - a)[s]
                    for c, v in zip(cols, (int(bucket[x]), (h[s] >> np.uint64(32)).astype(np.uint32).tobytes(), d[s].tobytes(), kernels.planes(p[s].astype(np.int32)), size.astype(np.uint8).tobytes(), press.compress(raw[kernels.ragged(a[s], size)].tobytes())), strict=True):
                        c.append(v)
                yield common.rows(STRINGS, *cols, [False] * len(cols[0]))

    return run


def _construct(n: int, uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with contextlib.closing(Columns(uri)) as files:  # they go when the task fails, too
            yield from work(batches, files)

    def work(batches: Iterator[pa.RecordBatch], files: Columns) -> Iterator[pa.RecordBatch]:
        have: dict[int, list[pa.RecordBatch]] = {}
        open_, rolls = zstandard.ZstdDecompressor(), (kernels.Rolling(73), kernels.Rolling(74))
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                if one.column(6)[0].as_py():  # (bucket, -, documents, starts, counts, ends)
                    yield common.rows(HIT, one.column(0), one.column(2), one.column(4), one.column(3), one.column(5))
                else:
                    have.setdefault(one.column(0)[0].as_py(), []).append(one)
        for parts in have.values():
            col = lambda k, t: common.joined([v for b in parts for v in b.column(k).to_pylist()], t)  # noqa: B023, E731
            h, d, size = col(1, np.uint32), col(2, np.int64), col(4, np.uint8).astype(np.int64)
            p = np.concatenate([kernels.unplanes(v, np.int32) for b in parts for v in b.column(3).to_pylist()])
            raw = np.frombuffer(b"".join(open_.decompress(v) for b in parts for v in b.column(5).to_pylist()), np.uint8)
            begin = np.cumsum(size) - size
            # equal strings are one string of the collection, that of the least document: all windows of the others repeat
            same = [np.empty(len(size), np.uint64) for _ in rolls]
            for x in range(0, len(size), 20_000):  # as many bytes at a time as a chunk has
                part = slice(x, x + 20_000)
                low, high = begin[part][0], begin[part][-1] + size[part][-1]
                for roll, out in zip(rolls, same, strict=True):
                    out[part] = roll.spans(roll.prefix(raw[low:high]), begin[part] - low, begin[part] - low + size[part])
            order = np.lexsort((d, *same, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (same[0][order][1:] != same[0][order][:-1]) | (same[1][order][1:] != same[1][order][:-1])])
            lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            later = d[order] > d[lead]
            rest = order[later]
            yield from hit_rows(d[rest], p[rest], n, p[rest] + size[rest].astype(np.int32))
            head = order[new]
            members = order[~later]  # more than one where a document has a string twice
            of = (np.cumsum(new) - 1)[~later]
            # strings of one gram stay together; a collection is a run of grams
            ends = np.append(np.flatnonzero(np.diff(h[head])) + 1, len(head))
            at = 0
            while at < len(head):
                full, next_ = np.searchsorted(ends, [at + COLLECTION, at], side="right")
                stop = int(ends[max(full - 1, next_)])
                s = head[at:stop]
                off = np.concatenate([[0], np.cumsum(size[s])])
                hit, row = marked_windows(raw[kernels.ragged(begin[s], size[s])], off, d[s], WINDOW, files)
                own = slice(*np.searchsorted(of, [at, stop]))
                first = np.searchsorted(of[own], row + at)
                count = np.searchsorted(of[own], row + at, side="right") - first
                m = members[own][kernels.ragged(first, count)]
                yield from _runs(d[m], p[m] + np.repeat(hit - off[row], count), n)
                at = stop

    return run


def _runs(d: np.ndarray, start: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Windows by document as intervals, overlapping ones joined."""
    if not len(d):
        return
    order = np.lexsort((start, d))
    d, start = d[order], start[order]
    a = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (start[1:] > start[:-1] + WINDOW)]))
    b = np.append(a[1:], len(d)) - 1
    yield from hit_rows(d[a], start[a], n, start[b] + WINDOW)


# ---- removal ---------------------------------------------------------------------------------

CLEANED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
CLEANED_SQL = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, off, raw in kernels.pieces(batch.column(1), PIECE_BYTES):
            spans, kept = [], []
            starts, ends = batch.column(2).slice(i, j - i).to_pylist(), batch.column(3).slice(i, j - i).to_pylist()
            for k in range(j - i):
                own = raw[off[k] : off[k + 1]]
                if starts[k]:
                    drop = kernels.cover(len(own), np.minimum(np.frombuffer(starts[k], np.int32), len(own)), np.minimum(np.frombuffer(ends[k], np.int32), len(own)))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8))).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                    own = own[~drop]
                else:
                    spans.append([])
                kept.append(own.tobytes())
            yield common.rows(CLEANED, batch.column(0).slice(i, j - i), np.diff(off), spans, kept)


def remove_shared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) of every document of (doc_id, text)."""
    n = common.partitions(docs.sparkSession)
    docs, back = common.apart(docs.select("doc_id", "text"), "doc_id", "text")
    keyed = docs.where(F.col("doc_id").isNotNull())
    hits = common.exchange(keyed.mapInArrow(_grams(n), ENTRY_SQL), n).mapInArrow(_nominate(n), HIT_SQL)
    around = keyed.join(by_document(hits, n).hint("merge"), "doc_id").select("doc_id", "text", "at")
    spans = common.exchange(around.mapInArrow(_strings(n), STRINGS_SQL), n).mapInArrow(_construct(n, common.shared_dir(docs.sparkSession, "columns")), HIT_SQL)
    judged = keyed.join(by_document(spans, n).hint("merge"), "doc_id", "left").select("doc_id", "text", "at", "ends")
    none = F.lit(None).cast("binary")
    free = docs.where(F.col("doc_id").isNull()).select("doc_id", "text", none.alias("at"), none.alias("ends"))
    return back(judged.mapInArrow(_clean, CLEANED_SQL).unionByName(free.mapInArrow(_clean, CLEANED_SQL)), "doc_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_shared(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), bytes AS (
  SELECT doc_id, i, substr(part, CAST(2 * j - 1 AS INT), 2) AS b FROM (
    SELECT doc_id, part, 500 * k + j AS i, j FROM (
      SELECT doc_id, k, part, unnest(range(1, length(part) // 2 + 1)) AS j FROM (
        SELECT doc_id, k, substr(h, CAST(1000 * k + 1 AS INT), 1000) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1000 + 1)) AS k FROM texts))))
), windows AS (
  SELECT doc_id, i, b, CASE WHEN count(*) OVER w = 50 THEN string_agg(b, '') OVER w END AS s FROM bytes WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), judged AS (
  SELECT doc_id, i, b, s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id AS again FROM windows
), covered AS (
  SELECT doc_id, i, b, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone FROM judged
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM covered
), kept AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept FROM edged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM documents d LEFT JOIN kept USING (doc_id)
"""
