"""SentencePiece encoding and decoding with N-best segmentation (operator 4).

A text is cut before spaces and around control characters, but not between two bytes that stand next
to each other in a piece (runs of spaces, ``;\\r``).  No piece of the vocabulary crosses such a cut, so
the lattice of a text is a chain of the lattices of its segments, and a forward Viterbi pass
scores each distinct segment once.  Those forward scores are the exact heuristic of a backward
A* search, which gives the n best segmentations of a segment one after another, best first.

The n best of a text differ from its best one in few segments: only those whose second best costs
least can take part.  A forward and a backward pass give every segment its cost exactly, A* runs
over the segments that can take part, and a heap merges their alternatives.

Scores are the public file's; a byte that no piece covers is encoded as its byte piece, below
every piece.  Decoding joins the pieces' bytes, so every text comes back.

Defined results: a null text has no ids and decodes to null; an empty one has no ids and decodes
to itself; of equally good segmentations the one with the longest last piece comes first; fewer
than n segmentations are returned where there are fewer; repeated rows are encoded again; other
columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, kernels
from tessera.llm.lattice import SPACE, Vocabulary, edges, rectangles

N_BEST = 3
REMEMBERED = 400_000
#: Bytes of text that are segmented at a time.
PIECE_BYTES = 1 << 19
#: Segments whose n best are remembered by a worker, some 400 bytes each.
SOLVED_KEPT = 50_000
#: Segments whose lattices are held at a time.
SOLVED = 20_000
NONE = -1e300


class Segmenter:
    """N-best segmentations of texts, the distinct segments of each worker solved once."""

    def __init__(self, path: str):
        self.v = Vocabulary(path, whole=True)
        self.roll = kernels.Rolling(431)
        self.table = {self.v.texts[i]: i for _, _, _, found in self.v.tables for i in found[found >= 0].tolist()}
        self.keys = np.zeros(0, np.uint64)
        self.score, self.cost = np.zeros(0), np.zeros(0)  # of the best, and how much less the second best has
        self.begin, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.solved: dict[bytes, list[tuple[float, list[int]]]] = {}

    # ---- many segments at once

    def _solve(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray):
        """(score, cost of the second best, ids, number of ids) of segments."""
        m = len(start)
        best, cost, count = np.zeros(m), np.full(m, np.inf), np.zeros(m, np.int32)
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        prefix = self.v.roll.prefix(raw)
        for size, part in rectangles(start, length):
            match = self.v.matches(prefix, raw, start[part], size)
            k = len(part)
            fwd = np.full((size + 1, k), NONE)
            fwd[0] = 0
            took = np.zeros((size + 1, k), np.int16)
            own, lattice = length[part], list(edges(match))
            for j, n, some, piece in lattice:
                got = fwd[j - n, some] + self.v.score[piece]
                up = got >= fwd[j, some]  # of equals the longest
                fwd[j, some[up]] = got[up]
                took[j, some[up]] = n
            bwd = np.full((size + 1, k), NONE)
            bwd[own, np.arange(k)] = 0
            on = np.zeros((size + 1, k), bool)  # ends of the pieces of the best path
            at, ids, live = own.copy(), [], np.arange(k)
            while len(live):
                n = took[at[live], live]
                on[at[live], live] = True
                ids.append((live, n, at[live]))
                at[live] -= n
                live = live[at[live] > 0]
            second = np.full(k, NONE)
            for j, n, some, piece in reversed(lattice):
                s = self.v.score[piece]
                bwd[j - n, some] = np.maximum(bwd[j - n, some], s + bwd[j, some])
                through = fwd[j - n, some] + s + bwd[j, some]
                other = ~(on[j, some] & (took[j, some] == n))
                w = some[other]
                second[w] = np.maximum(second[w], through[other])
            best[part] = fwd[own, np.arange(k)]
            cost[part] = np.where(second > NONE / 2, best[part] - second, np.inf)
            count[part] = 0
            for live, n, end in ids:
                count[part[live]] += 1
            rows.append((part, ids, match))
        begin = np.cumsum(count, dtype=np.int64) - count
        flat = np.zeros(int(count.sum()), np.int32)
        for part, ids, match in rows:
            where = begin[part] + count[part]
            for live, n, end in ids:
                where[live] -= 1
                for size in np.unique(n).tolist():
                    own = n == size
                    flat[where[live[own]]] = match[size - 1][live[own], end[own] - size]
        return best, cost, flat, begin, count

    # ---- one segment, best first

    def nbest(self, segment: bytes, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations by backward A* under forward Viterbi scores."""
        known = self.solved.get(segment)
        if known is not None and (len(known) >= n or (known and known[-1][0] == NONE)):
            return [x for x in known[:n] if x[0] != NONE]
        size, v = len(segment), self.v
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(size + 1)]
        fwd = [0.0] + [NONE] * size
        for j in range(1, size + 1):
            for k in range(max(0, j - v.longest), j):
                piece = self.table.get(segment[k:j], -1)
                if piece < 0 and j - k == 1:
                    piece = int(v.byte_ids[segment[k]])
                if piece >= 0:
                    s = float(v.score[piece])
                    into[j].append((k, piece, s))
                    fwd[j] = max(fwd[j], fwd[k] + s)
        out: list[tuple[float, list[int]]] = []
        heap = [(-fwd[size], 0, size, 0.0, None)]
        serial = 0
        while heap and len(out) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path is not None:
                    ids.append(path[0])
                    path = path[1]
                out.append((behind, ids))
                continue
            for k, piece, s in reversed(into[at]):  # of equals the one pushed last, with the longest piece, is gone on with
                serial -= 1
                heapq.heappush(heap, (-(fwd[k] + s + behind), serial, k, s + behind, (piece, path)))
        if len(self.solved) > SOLVED_KEPT:
            self.solved.clear()
        self.solved[segment] = out if len(out) == n else [*out, (NONE, [])]
        return out

    # ---- texts

    def segments(self, off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, row): cut before spaces and around control characters where no piece crosses."""
        if not len(raw):
            none = np.zeros(0, np.int64)
            return none, none, none
        control = raw < 0x20
        cut = (raw == SPACE) | control
        cut[1:] |= control[:-1]
        cut[1:] &= ~self.v.joins[raw[:-1], raw[1:]]
        cut[off[:-1][off[:-1] < len(raw)]] = True
        start = np.flatnonzero(cut)
        return start, np.append(start[1:], len(raw)), np.searchsorted(off, start, side="right") - 1

    def encode(self, off: np.ndarray, raw: np.ndarray, n_best: int = N_BEST, alternatives: bool = True):
        """By document: (offsets, ids of the best, scores of the n best, ids of the others)."""
        n = len(off) - 1
        start, end, row = self.segments(off, raw)
        if not len(start):
            return np.zeros(n + 1, np.int64), np.zeros(0, np.int32), [[0.0] for _ in range(n)], [[] for _ in range(n)]
        uniq, first, inv = np.unique(self.roll.spans(self.roll.prefix(raw), start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            if len(self.keys) > REMEMBERED:
                self.__dict__.update(keys=self.keys[:0], score=self.score[:0], cost=self.cost[:0], begin=self.begin[:0], length=self.length[:0], flat=self.flat[:0])
                known[:] = False
            new = np.flatnonzero(~known)
            got = []
            for x in range(0, len(new), SOLVED):
                s = start[first[new[x : x + SOLVED]]]
                got.append(self._solve(raw, s, end[first[new[x : x + SOLVED]]] - s))
            base = np.cumsum([0, *[len(g[2]) for g in got]])
            score, cost, flat, begin, count = (np.concatenate(x) for x in zip(*[(g[0], g[1], g[2], g[3] + o, g[4]) for g, o in zip(got, base, strict=False)], strict=True))
            where = np.searchsorted(self.keys, uniq[new])
            for name, x in (("keys", uniq[new]), ("score", score), ("cost", cost), ("begin", begin + len(self.flat)), ("length", count)):
                setattr(self, name, np.insert(getattr(self, name), where, x))
            self.flat = np.concatenate([self.flat, flat])
            at = np.searchsorted(self.keys, uniq)
        own = at[inv]
        length = self.length[own].astype(np.int64)
        ids = self.flat[kernels.ragged(self.begin[own], length)]
        seg_off = kernels.bounds(row, n)
        id_off = np.concatenate([[0], np.cumsum(length)])[seg_off]
        total = np.bincount(row, weights=self.score[own], minlength=n)
        # the segments of each document that cost least to change
        cost = self.cost[own]
        order = np.lexsort((np.arange(len(cost)), cost, row))
        data = raw.tobytes()
        scores, others = [], []
        for k in range(n):
            few = order[seg_off[k] : min(seg_off[k + 1], seg_off[k] + n_best - 1)]
            got = self._merge([(g, self.nbest(data[start[g] : end[g]], n_best)) for g in few.tolist() if cost[g] < np.inf], n_best)
            scores.append([float(total[k] - c) for c, _ in got])
            others.append([] if not alternatives else [self._changed(ids, id_off[k], id_off[k + 1], np.concatenate([[0], np.cumsum(length[seg_off[k] : seg_off[k + 1]])]) + id_off[k], seg_off[k], change) for _, change in got[1:]])
        return id_off, ids, scores, others

    @staticmethod
    def _merge(choices: list[tuple[int, list[tuple[float, list[int]]]]], n: int) -> list[tuple[float, list[tuple[int, list[int]]]]]:
        """The n least sums of costs over one alternative of each segment: (cost, changed segments)."""
        got: list[tuple[float, list]] = [(0.0, [])]
        for g, ways in choices:
            top = ways[0][0]
            got = heapq.nsmallest(n, ((c + top - s, [*ch, (g, w)] if k else ch) for c, ch in got for k, (s, w) in enumerate(ways)), key=lambda x: x[0])
        return got

    @staticmethod
    def _changed(ids, a, b, seg, base, change) -> np.ndarray:
        parts, at = [], a
        for g, w in sorted(change, key=lambda x: x[0]):
            parts += [ids[at : seg[g - base]], np.array(w, np.int32)]
            at = seg[g - base + 1]
        return np.concatenate([*parts, ids[at:b]])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.v.texts[i] for i in ids.tolist()])


def segmenter(path: str) -> Segmenter:
    return common.resident(("segmenter", path), lambda: Segmenter(path))


def _nested(parts: list[list[np.ndarray]]) -> pa.Array:
    """Lists of lists of ids."""
    flat = [x for p in parts for x in p]
    inner = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
    outer = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = pa.array(np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32))
    return pa.ListArray.from_arrays(pa.array(outer), pa.ListArray.from_arrays(pa.array(inner), values))


def encode(docs: DataFrame, path: str, n_best: int = N_BEST, alternatives: bool = True) -> DataFrame:
    """The documents with ``ids``, ``nbest_scores`` (best first) and, if wanted, ``nbest_ids``, the
    ids of the others."""
    kept = [c for c in docs.columns if c not in ("ids", "nbest_scores", "nbest_ids")]
    names = [*kept, "ids", "nbest_scores"] + ["nbest_ids"] * alternatives
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", ids array<int>, nbest_scores array<double>" + ", nbest_ids array<array<int>>" * alternatives

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(path)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for i, j, off, raw in kernels.pieces(text, PIECE_BYTES):
                ids, scores, others = _encoded(s, text.slice(i, j - i), off, raw, n_best, alternatives)
                part = batch.slice(i, j - i)
                cols = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, ids, scores] + [_nested(others)] * alternatives, names)
                common.release()
        common.trim()

    return docs.select(*kept).mapInArrow(run, schema)


def _encoded(s: Segmenter, text: pa.Array, off, raw, n_best: int, alternatives: bool) -> tuple[pa.ListArray, pa.Array, list]:
    id_off, ids, scores, others = s.encode(off, raw, n_best, alternatives)
    null = text.is_null().to_numpy(zero_copy_only=False)
    lists = pa.ListArray.from_arrays(pa.array(id_off.astype(np.int32), mask=np.append(null, False)), pa.array(ids))
    return lists, pa.array(scores, pa.list_(pa.float64())), others


def decoded(v: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The texts of lists of ids; null for null."""
    size = np.array([len(t) for t in v.texts], np.int64)
    table = np.frombuffer(b"".join(v.texts), np.uint8)
    off = np.asarray(ids.offsets)
    flat = np.asarray(ids.values)[off[0] : off[-1]]
    data = table[kernels.ragged((np.cumsum(size) - size)[flat], size[flat])]
    ends = np.concatenate([[0], np.cumsum(size[flat])])[off - off[0]].astype(np.int64)
    out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary()).cast(pa.string())
    return pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.string())) if ids.null_count else out


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of their ids."""
    names = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in names) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = segmenter(path).v
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, decoded(v, b.column(b.schema.get_field_index(ids)))], [*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, schema)


DIGEST_SQL = "doc_id long, n_ids long, ids_crc32 long, nbest_scores array<double>, n_best long, round_trip boolean, nbest_ids_crc32 array<long>"


def digest(docs: DataFrame, path: str, n_best: int = N_BEST) -> DataFrame:
    """Encode and decode in one pass, and return what a check needs: counts, a checksum of the ids
    (as little-endian unsigned 32-bit integers), the scores, whether the ids decode to the text, and
    the checksums of the others' ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(path)
        for b in batches:
            for i, j, off, raw in kernels.pieces(b.column(1), PIECE_BYTES):
                text = b.column(1).slice(i, j - i)
                ids, scores, others = _encoded(s, text, off, raw, n_best, True)
                back = decoded(s.v, ids)
                same = pc.or_(pc.fill_null(pc.equal(back, text), False), pc.and_(back.is_null(), text.is_null()))
                at, flat = np.asarray(ids.offsets), np.asarray(ids.values).astype("<u4")
                crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                more = pa.array([[zlib.crc32(x.astype("<u4").tobytes()) for x in ways] for ways in others], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()), scores, pc.cast(pc.list_value_length(scores), pa.int64()), same, more], ["doc_id", "n_ids", "ids_crc32", "nbest_scores", "n_best", "round_trip", "nbest_ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST_SQL)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
