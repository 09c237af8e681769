"""Substring deduplication with a log-structured fingerprint index (operator 1).

A window is a fixed number of consecutive words.  Hashes of short windows, chosen from each long
window by their least value (so equal long windows choose alike), go to an index of sorted
immutable runs.  Documents come in batches of ascending key; each bucket of a batch is sorted and
merge-joined with the runs before it, which gives the candidates, and its unseen hashes become a
new run; runs of a level are compacted into one of the next.  The candidates are then verified:
all long windows around them are compared by 96 bits of two independent fingerprints, and each
that also starts earlier marks its words.

Where it is large: per batch one exchange of about an eighth of the windows, and for the
verification one exchange of the texts, used twice, and one of the windows of repeated passages.
Repeats inside a chunk of text are settled there, so a frequent passage reaches its bucket a few
times a task and no task holds it whole.

Defined results: null text is no words; a row with a null key is returned unjudged; rows that
repeat a key and a text are one document, each of them returned, and none is a repeat of another;
rows that share a key only are documents of their own, in the order of a hash of their texts; equal
windows of one document keep the first; a text of any length is one document, worked on alone where
it is longer than a piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import compress
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, kernels

WINDOW = 20
#: Words of the short windows whose hashes the index holds.
GRAM = 8
BATCHES = 4
#: Runs of one level that are compacted into one of the next.
FANOUT = 3
#: Frequent hashes that a task remembers to settle their repeats itself.
REMEMBERED = 1 << 20

ENTRY = pa.schema([("bucket", pa.int32()), ("h", pa.binary()), ("f", pa.binary()), ("d", pa.binary()), ("n", pa.binary()), ("p", pa.binary()), ("settled", pa.bool_())])
ENTRY_SQL = "bucket int, h binary, f binary, d binary, n binary, p binary, settled boolean"
#: Places of documents on their way to them: a row for each task and bucket of documents.
HIT = pa.schema([("bucket", pa.int32()), ("d", pa.binary()), ("n", pa.binary()), ("p", pa.binary()), ("e", pa.binary())])
HIT_SQL = "bucket int, d binary, n binary, p binary, e binary"
PLACES = pa.schema([("doc_id", pa.int64()), ("at", pa.binary()), ("ends", pa.binary())])
PLACES_SQL = "doc_id long, at binary, ends binary"


def doc_bucket(d: np.ndarray, n: int) -> np.ndarray:
    return (kernels.mix(d.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int32)


def packed(bucket: np.ndarray, h: np.ndarray, f: np.ndarray, d: np.ndarray, p: np.ndarray, settled: bool) -> pa.RecordBatch:
    """One row for each bucket: its entries in order, documents with counts."""
    order = np.argsort(bucket, kind="stable")
    bucket, h, f, d, p = bucket[order], h[order], f[order], d[order], p[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    edge = np.concatenate([[0], cuts, [len(bucket)]])
    cols: list[list] = [[] for _ in range(6)]
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        new = np.flatnonzero(np.concatenate([[True], d[a + 1 : b] != d[a : b - 1]]))
        cols[0].append(int(bucket[a]))
        for c, x in zip(cols[1:], (h[a:b].tobytes(), f[a:b].tobytes(), d[a:b][new].tobytes(), np.diff(np.append(new, b - a)).astype(np.uint32).tobytes(), kernels.planes(p[a:b].astype(np.int32))), strict=True):
            c.append(x)
    return common.rows(ENTRY, *cols, [settled] * len(cols[0]))


def unpacked(batches: list[pa.RecordBatch], kind_h, kind_f) -> tuple[np.ndarray, ...]:
    """(h, f, d, p) of all entries of the rows."""
    col = lambda k, t: common.joined([v for b in batches for v in b.column(k).to_pylist()], t)
    places = [kernels.unplanes(v, np.int32) for b in batches for v in b.column(5).to_pylist()]
    return col(1, kind_h), col(2, kind_f), np.repeat(col(3, np.int64), col(4, np.uint32)), np.concatenate(places)


def hit_rows(d: np.ndarray, p: np.ndarray, n: int, e: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Places (or starts and ends) of documents for the ``n`` buckets of documents."""
    if not len(d):
        return
    bucket = doc_bucket(d, n)
    e = np.zeros(len(d), np.int32) if e is None else e
    order = np.lexsort((p, d, bucket))
    bucket, d, p, e = bucket[order], d[order], p[order].astype(np.int32), e[order].astype(np.int32)
    edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(d)]])
    cols: list[list] = [[] for _ in range(5)]
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        new = np.flatnonzero(np.concatenate([[True], d[a + 1 : b] != d[a : b - 1]]))
        for c, x in zip(cols, (int(bucket[a]), d[a:b][new].tobytes(), np.diff(np.append(new, b - a)).astype(np.uint32).tobytes(), kernels.planes(p[a:b]), kernels.planes(e[a:b])), strict=True):
            c.append(x)
    yield common.rows(HIT, *cols)


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            have.setdefault(r["bucket"], []).append(r)
    for parts in have.values():
        col = lambda k, t: common.joined([r[k] for r in parts], t)  # noqa: B023, E731
        d, p, e = np.repeat(col("d", np.int64), col("n", np.uint32)), *(np.concatenate([kernels.unplanes(r[k], np.int32) for r in parts]) for k in "pe")
        order = np.lexsort((p, d))
        d, p, e = d[order], p[order], e[order]
        edge = np.concatenate([[0], np.flatnonzero(np.diff(d)) + 1, [len(d)]])
        pairs = list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
        yield common.rows(PLACES, d[edge[:-1]], [p[a:b].tobytes() for a, b in pairs], [e[a:b].tobytes() for a, b in pairs])


def by_document(hits: DataFrame, n: int) -> DataFrame:
    """(doc_id, at, ends): a row for each document that has hits."""
    return common.exchange(hits, n).mapInArrow(_by_document, PLACES_SQL)


def repeated(h: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


class _Words:
    """Word hashes of two independent families, and hashes of runs of words."""

    def __init__(self):
        self.letters = kernels.Rolling(11), kernels.Rolling(12)
        self.runs = kernels.Rolling(13), kernels.Rolling(14)

    def hashes(self, raw, start, end, family=0):
        return self.letters[family].spans(self.letters[family].prefix(raw), start, end)

    def windows(self, word_hashes, width, family=0):
        return self.runs[family].windows(self.runs[family].prefix(word_hashes), width)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    k = batch.column(0)
    return k.fill_null(0).to_numpy(zero_copy_only=False), k.is_valid().to_numpy(zero_copy_only=False)


def _grams(n: int):
    """From (doc_id, text) to entries of chosen short windows for their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = _Words(), np.zeros(0, np.uint64)
        for batch in batches:
            keys, valid = _keys(batch)
            for i, j, off, raw in kernels.pieces(batch.column(1)):
                start, end, row = kernels.words(off, raw)
                if not len(start):
                    continue
                first = kernels.bounds(row, j - i)
                at, _, _ = kernels.anchors(g := w.windows(w.hashes(raw, start, end), GRAM), first, WINDOW, GRAM)
                at = at[valid[i:j][row[at]]]
                if not len(at):
                    continue
                h, d, p = g[at], keys[i:j][row[at]], at - first[row[at]]
                again = repeated(h)
                known = np.zeros(len(h), bool)
                if len(seen):
                    place = np.minimum(np.searchsorted(seen, h), len(seen) - 1)
                    known = seen[place] == h
                settled = again | known
                if settled.any():
                    yield packed(doc_bucket(d[settled], n), np.zeros(settled.sum(), np.uint8), np.zeros(settled.sum(), np.uint8), d[settled], p[settled], True)
                send = np.flatnonzero(~known)
                send = send[np.unique(h[send], return_index=True)[1]]
                send.sort()
                if len(send):
                    yield packed((h[send] % np.uint64(n)).astype(np.int32), h[send], np.zeros(len(send), np.uint8), d[send], p[send], False)
                if again.any() and len(seen) < REMEMBERED:
                    seen = np.union1d(seen, h[again])

    return run


class FingerprintIndex:
    """Sorted immutable runs of hashes by bucket, in a folder that all executors share.

    A folder with a manifest is an index of an earlier session: it is opened as it was left, and
    runs that its manifest doesn't name, of a batch that didn't end, don't count.
    """

    def __init__(self, spark: SparkSession, uri: str, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.uri, self.fanout = spark, uri, fanout
        self.buckets = buckets or common.partitions(spark)
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path, recursive=True)
        #: (level, name) of the runs that count, oldest first; what the manifest says.
        self.runs: list[tuple[int, str]] = []
        if fs.get_file_info(f"{path}/manifest.json").type == pafs.FileType.File:
            with fs.open_input_stream(f"{path}/manifest.json") as f:
                said = json.loads(f.read())
            if buckets not in (None, said["buckets"]):
                raise ValueError(f"the index at {uri} has {said['buckets']} buckets")
            self.buckets, self.runs = said["buckets"], [tuple(r) for r in said["runs"]]

    def _commit(self) -> None:
        fs, path = pafs.FileSystem.from_uri(self.uri)
        with fs.open_output_stream(f"{path}/manifest.json.tmp") as out:
            out.write(json.dumps({"buckets": self.buckets, "runs": self.runs}).encode())
        fs.move(f"{path}/manifest.json.tmp", f"{path}/manifest.json")

    @staticmethod
    def _read(fs, path: str, run: str, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        name = f"{path}/{run}/{bucket}.parquet"
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        t = pq.read_table(name, filesystem=fs)
        return tuple(t.column(k).to_numpy() for k in range(3))

    @staticmethod
    def _write(fs, path: str, run: str, bucket: int, h: np.ndarray, d: np.ndarray, p: np.ndarray) -> None:
        if not len(h):
            return
        fs.create_dir(f"{path}/{run}", recursive=True)
        name = f"{path}/{run}/{bucket}.parquet"
        tmp = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
        t = pa.table({"h": h, "d": d, "p": p.astype(np.int32)})
        pq.write_table(t, tmp, filesystem=fs, compression="zstd", use_dictionary=False, column_encoding={"h": "DELTA_BINARY_PACKED", "d": "DELTA_BINARY_PACKED", "p": "DELTA_BINARY_PACKED"}, write_statistics=False)
        fs.move(tmp, name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Join a batch of (doc_id, text) with the runs, make its own run; returns the hits."""
        uri, n, old, new, read, write = self.uri, self.buckets, [r for _, r in self.runs], f"run-{uuid4().hex}", self._read, self._write

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
            fs, path = pafs.FileSystem.from_uri(uri)
            for bucket, parts in have.items():
                h, _, d, p = unpacked(parts, np.uint64, np.uint8)
                order = np.lexsort((p, d, h))
                h, d, p = h[order], d[order], p[order]
                first = np.concatenate([[True], h[1:] != h[:-1]])
                hit = ~first
                hit[:-1] |= ~first[1:]
                fresh = first.copy()
                for name in old:  # each run is sorted: a merge join
                    rh, rd, rp = read(fs, path, name, bucket)
                    if not len(rh):
                        continue
                    at = np.minimum(np.searchsorted(rh, h), len(rh) - 1)
                    found = rh[at] == h
                    hit |= found
                    fresh &= ~found
                    back = np.unique(at[found])
                    yield from hit_rows(rd[back], rp[back], n)
                yield from hit_rows(d[hit], p[hit], n)
                write(fs, path, new, bucket, h[fresh], d[fresh], p[fresh])

        hits = common.exchange(docs.mapInArrow(_grams(self.buckets), ENTRY_SQL), self.buckets).mapInArrow(run, HIT_SQL)
        hits = common.stored(hits, "hits")
        self.runs.append((0, new))
        self._commit()
        self._compact()
        return hits

    def _compact(self) -> None:
        for level in range(64):
            old = [r for k, r in self.runs if k == level]
            if len(old) < self.fanout:
                return
            uri, new, read, write = self.uri, f"run-{uuid4().hex}", self._read, self._write

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                fs, path = pafs.FileSystem.from_uri(uri)
                for batch in batches:
                    for bucket in batch.column(0).to_pylist():
                        h, d, p = (np.concatenate(x) for x in zip(*[read(fs, path, r, bucket) for r in old], strict=True))
                        order = np.argsort(h, kind="stable")
                        write(fs, path, new, bucket, h[order], d[order], p[order])
                        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64())], ["id"])

            self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(run, "id long").count()
            self.runs = [x for x in self.runs if x[1] not in old] + [(level + 1, new)]
            self._commit()
            fs, path = pafs.FileSystem.from_uri(uri)
            for r in old:
                if fs.get_file_info(f"{path}/{r}").type == pafs.FileType.Directory:
                    fs.delete_dir(f"{path}/{r}")


def _windows(n: int):
    """From (doc_id, text, hits) to entries of the long windows around the hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Words()
        for batch in batches:
            keys, _ = _keys(batch)
            hits = batch.column(2)
            for i, j, off, raw in kernels.pieces(batch.column(1)):
                start, end, row = kernels.words(off, raw)
                if not len(start):
                    continue
                first = kernels.bounds(row, j - i)
                marked = np.zeros(len(start) + 1, bool)
                for k, own in enumerate(hits.slice(i, j - i).to_pylist()):
                    if own:
                        at = first[k] + np.frombuffer(own, np.int32)
                        marked[at[at < first[k + 1]]] = True
                wh = w.hashes(raw, start, end)
                at, a, b = kernels.anchors(w.windows(wh, GRAM), first, WINDOW, GRAM)
                take = marked[at]
                a, b = a[take], b[take]
                win = kernels.ragged(a, b - a + 1)
                if not len(win):
                    continue
                h = w.windows(wh, WINDOW)[win]
                f = (w.windows(w.hashes(raw, start, end, 1), WINDOW, 1)[win] >> np.uint64(32)).astype(np.uint32)
                d, p = keys[i:j][row[win]], (win - first[row[win]]).astype(np.int32)
                again = repeats(h, f, d, p)
                if again.any():
                    yield packed(doc_bucket(d[again], n), np.zeros(again.sum(), np.uint8), np.zeros(again.sum(), np.uint8), d[again], p[again], True)
                new = ~again
                yield packed((h[new] % np.uint64(n)).astype(np.int32), h[new], f[new], d[new], p[new], False)

    return run


def repeats(h: np.ndarray, f: np.ndarray, d: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which windows also start earlier: by document, then by place."""
    order = np.lexsort((p, d, f, h))
    hs, fs, ds, ps = h[order], f[order], d[order], p[order]
    new = np.concatenate([[True], (hs[1:] != hs[:-1]) | (fs[1:] != fs[:-1])])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(hs)), 0))
    out = np.zeros(len(h), bool)
    out[order] = (ds != ds[lead]) | (ps != ps[lead])
    return out


def _verified(n: int):
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
            h, f, d, p = unpacked(parts, np.uint64, np.uint32)
            again = repeats(h, f, d, p)
            yield from hit_rows(d[again], p[again], n)

    return run


CLEANED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
CLEANED_SQL = "doc_id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text, repeated windows) to the words that stay."""
    for batch in batches:
        for i, j, off, raw in kernels.pieces(batch.column(1)):
            data, own = raw.tobytes(), batch.column(2).slice(i, j - i).to_pylist()
            n, gone, spans, kept = [], [], [], []
            for k, hits in enumerate(own):
                ws = data[off[k] : off[k + 1]].split()
                n.append(len(ws))
                if hits:
                    at = np.frombuffer(hits, np.int32).astype(np.int64)
                    at = at[at + WINDOW <= len(ws)]
                    drop = kernels.cover(len(ws), at, at + WINDOW)
                    gone.append(int(drop.sum()))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8))).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                    ws = compress(ws, (~drop).tolist())
                else:
                    gone.append(0)
                    spans.append([])
                kept.append(b" ".join(ws))
            yield common.rows(CLEANED, batch.column(0).slice(i, j - i), n, gone, spans, pa.array(kept, pa.binary()).cast(pa.string()))


def remove_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept) of every document of (doc_id, text)."""
    spark = docs.sparkSession
    n = common.partitions(spark)
    docs, back = common.apart(docs.select("doc_id", "text"), "doc_id", "text")
    keyed = docs.where(F.col("doc_id").isNotNull())
    index = FingerprintIndex(spark, common.shared_dir(spark, "fingerprints"), n)
    cuts = sorted(set(keyed.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01)))
    hits = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = keyed
        if low is not None:
            part = part.where(F.col("doc_id") > int(low))
        if high is not None:
            part = part.where(F.col("doc_id") <= int(high))
        got = index.add(part)
        hits = got if hits is None else hits.unionByName(got)
    around = keyed.join(by_document(hits, n).hint("merge"), "doc_id").select("doc_id", "text", "at")
    found = common.exchange(around.mapInArrow(_windows(n), ENTRY_SQL), n).mapInArrow(_verified(n), HIT_SQL)
    judged = keyed.join(by_document(found, n).hint("merge"), "doc_id", "left").select("doc_id", "text", "at")
    free = docs.where(F.col("doc_id").isNull()).select("doc_id", "text", F.lit(None).cast("binary").alias("at"))
    return back(judged.mapInArrow(_clean, CLEANED_SQL).unionByName(free.mapInArrow(_clean, CLEANED_SQL)), "doc_id")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), placed AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words
), windows AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i : i + 19], ' ') END AS s FROM placed
), judged AS (
  SELECT doc_id, i, word, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, i, word, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone FROM judged
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN kept USING (doc_id)
"""
