"""N-gram Jaccard join by T-occurrence search over inverted lists (operator 8).

A document is the set of its distinct runs of four words.  Two link at 85 % of their union, so a
document of n shingles shares at least T = ceil(0.85 n) of them with any partner.

1. Active documents.  Buckets of hashes tell how many of a hashed part of a document's shingles no
   other document has.  Where these alone leave fewer than T, nothing can link; most go here.
   Equal sets are one class, of which the least document goes on.
2. Lists.  The active documents' shingles are merged into sorted inverted lists.  A document of n
   shingles and u of its own shares at most n - u, which bounds every pair: of a pair that links
   the smaller has u <= 8.1 % of n.  Lists are kept for each document's least T's complement plus
   l of its shingles, its own ones first, then in hash order: partners share at least the lesser
   of their two l there (the prefix principle).  Lists are short or, beyond ``SHORT``, long.
3. Collapse.  Each document is compared with the partner that leads most of its lists; sets that
   link already share a component and need not be compared again.
4. Search, as in DivideSkip.  Short lists are merged and pairs in different components counted;
   a pair that reaches the threshold less the long lists it could share is a candidate, and its
   long lists are probed by binary search when the whole sets are compared.  Only documents whose
   long lists alone could reach the threshold are paired from the long lists, again only over
   different components and within the bound of 2: that is the exact way for the rest.

No task holds a group: sets travel to their partner with a salt, the partner once per salt.  A
large group of near copies costs one comparison a copy.

Defined results: without words or text the set is empty and links with nothing; a null key links
with nothing and is its own component; rows that repeat a key and a text are one document, each
of them returned; rows that share a key only are documents of their own, in the order of a hash of
their texts; a text of any length is one set, made alone where it is longer than a piece; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, kernels
from tessera.llm.substring import ENTRY_SQL, HIT_SQL, by_document, doc_bucket, hit_rows, packed, unpacked

WORDS = 4
PERCENT = 85
#: l as a part of a set.
EXTRA = 0.04
#: The part of all hashes in which step 1 looks for shingles of one document.
SAMPLED = np.uint64(int(0.4 * 2**64))
#: Parts of all hashes, in order, in which a document's list ends.
LEVELS = 32
#: Documents of a short list.
SHORT = 24
#: Sets that one copy of a partner meets.
SALT_ROWS = 512
#: Bytes of text whose sets are made at a time.
PIECE_BYTES = 1 << 19

U64 = np.uint64


class Shingler:
    def __init__(self, width: int = WORDS):
        self.width = width
        self.letters, self.runs = kernels.Rolling(81), kernels.Rolling(82)

    def sets(self, off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets by row, sorted distinct shingle hashes of each row)."""
        n = len(off) - 1
        raw = kernels.ASCII_LOWER[raw]
        start, end, row = kernels.words(off, raw)
        if not len(start):
            return np.zeros(n + 1, np.int64), np.zeros(0, U64)
        h = self.letters.spans(self.letters.prefix(raw), start, end)
        first = kernels.bounds(row, n)
        prefix = self.runs.prefix(h)
        size = np.diff(first)
        count = np.where(size >= self.width, size - self.width + 1, np.minimum(size, 1))
        at = kernels.ragged(first[:-1], count)
        of = np.repeat(np.arange(n), count)
        g = self.runs.spans(prefix, at, np.minimum(at + self.width, first[of + 1]))
        order = np.lexsort((g, of))
        g, of = g[order], of[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (of[1:] != of[:-1])])
        g, of = g[new], of[new]
        return kernels.bounds(of, n), g


def required(n, percent: int = PERCENT):
    """Least overlap with any partner of a set of n."""
    return (percent * n + 99) // 100


def extra(n):
    return np.maximum(1, (np.asarray(n) * EXTRA).astype(np.int64))


_META = "doc_id long, n long, sampled long, k1 long, k2 long"


def _meta(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    s = Shingler(words)
    for b in batches:
        for i, j, off, raw in kernels.pieces(b.column(1), PIECE_BYTES):
            first, g = s.sets(off, raw)
            k = [np.concatenate([[U64(0)], np.cumsum(kernels.mix(g ^ U64(c)))]) for c in (0x51ED270B, 0x2545F491)]
            k = [(x[first[1:]] - x[first[:-1]]).view(np.int64) for x in k]
            part = np.concatenate([[0], np.cumsum(g < SAMPLED)])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(first)), pa.array(part[first[1:]] - part[first[:-1]]), pa.array(k[0]), pa.array(k[1])], ["doc_id", "n", "sampled", "k1", "k2"])
    common.trim()


def _sampled(n_buckets: int, words: int):
    """Entries of a hashed part of all shingles for their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(words)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, off, raw in kernels.pieces(b.column(1), PIECE_BYTES):
                first, g = s.sets(off, raw)
                own = np.flatnonzero(g < SAMPLED)
                if not len(own):
                    continue
                h, d = kernels.mix(g[own]), keys[i:j][np.searchsorted(first, own, side="right") - 1]
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                same = (h[1:] == h[:-1]) & (d[1:] != d[:-1])
                again = np.zeros(len(h), bool)  # shared by documents of this chunk: settled here, one goes on
                again[1:] |= same
                again[:-1] |= same
                new = np.concatenate([[True], h[1:] != h[:-1]])
                zero = np.zeros(len(h), np.int32)
                if again.any():
                    yield packed(doc_bucket(d[again], n_buckets), zero[again], zero[again], d[again], zero[again], True)
                yield packed((h[new] % U64(n_buckets)).astype(np.int32), (h[new] >> U64(32)).astype(np.uint32), again[new].astype(np.uint8), d[new], zero[new], False)

    return run


def _shared(n: int):
    """One hit for each entry whose shingle another document has as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list[pa.RecordBatch]] = {}
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                if one.column(6)[0].as_py():
                    _, _, d, p = unpacked([one], np.int32, np.int32)
                    yield from hit_rows(d, p, n)
                else:
                    have.setdefault(one.column(0)[0].as_py(), []).append(one)
        for parts in have.values():
            h, settled, d, p = unpacked(parts, np.uint32, np.uint8)
            order = np.lexsort((d, h))
            h, d, settled = h[order], d[order], settled[order].astype(bool)
            group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
            several = np.zeros(group[-1] + 1, bool)
            several[group[1:][(h[1:] == h[:-1]) & (d[1:] != d[:-1])]] = True
            hit = several[group] & ~settled
            yield from hit_rows(d[hit], np.zeros(hit.sum(), np.int32), n)

    return run


_POST = pa.schema([("bucket", pa.int32()), ("h", pa.binary()), ("d", pa.binary()), ("n", pa.binary())])


def _postings(n_buckets: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(words)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, off, raw in kernels.pieces(b.column(1), PIECE_BYTES):
                first, h = s.sets(off, raw)
                d = np.repeat(keys[i:j], np.diff(first))
                if not len(h):
                    continue
                bucket = (kernels.mix(h) % U64(n_buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, h, d = bucket[order], h[order], d[order]
                edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                cols: list[list] = [[], [], [], []]
                for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    new = np.flatnonzero(np.concatenate([[True], d[x + 1 : y] != d[x : y - 1]]))
                    for c, v in zip(cols, (int(bucket[x]), h[x:y].tobytes(), d[x:y][new].tobytes(), np.diff(np.append(new, y - x)).astype(np.uint32).tobytes()), strict=True):
                        c.append(v)
                yield common.rows(_POST, *cols)

    return run


#: kind 0: a bucket's lists, by document; kind 1: leaders of lists; kind 2: facts of documents.
#: Kinds 0 to 2 stand in buckets of documents; ``home`` is the bucket of hashes that a list is of.
_LISTS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("long", pa.binary()), ("home", pa.int32())])
_LISTS_SQL = "kind int, bucket int, docs binary, counts binary, tokens binary, long binary, home int"
_LED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hits", pa.int64())])
_FACTS = pa.schema([("doc_id", pa.int64()), ("shared", pa.binary()), ("long", pa.binary())])


def level(h: np.ndarray) -> np.ndarray:
    return (h >> U64(59)).astype(np.int64)


def _merge_lists(n_buckets: int):
    """The lists of two documents or more; what leads them; how many each document has by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list] = {}
        for b in batches:
            for r in b.to_pylist():
                have.setdefault(r["bucket"], []).append(r)
        for bucket, parts in have.items():
            h = common.joined([r["h"] for r in parts], U64)
            d = np.repeat(common.joined([r["d"] for r in parts], np.int64), common.joined([r["n"] for r in parts], np.uint32))
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            keep = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])  # rows that repeat a document
            h, d = h[keep], d[keep]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.append(new, len(h)))
            of = np.repeat(np.arange(len(new)), size)
            many = size[of] > 1
            lead = d[new][of]
            led = many & (d != lead) & (level(h) == 0)  # a part of the lists is enough to find a leader
            if led.any():
                yield from _by_bucket(1, n_buckets, d[led], lead[led], np.zeros(led.sum(), np.uint8))
            h, d, long = h[many], d[many], (size[of][many] > SHORT).astype(np.uint8)
            if len(h):
                yield from _by_bucket(2, n_buckets, d, level(h), long)
                yield from _by_bucket(0, n_buckets, d, h, long, bucket)

    return run


def _by_bucket(kind: int, n: int, d: np.ndarray, v: np.ndarray, f: np.ndarray, home: int = 0) -> Iterator[pa.RecordBatch]:
    """Values and flags of documents, a row for each bucket of documents."""
    bucket = doc_bucket(d, n)
    order = np.lexsort((v, d, bucket))
    bucket, d, v, f = bucket[order], d[order], v[order], f[order]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(d)]]).tolist()
    cols: list[list] = [[], [], [], [], []]
    for x, y in zip(edge[:-1], edge[1:], strict=True):
        at = np.flatnonzero(np.concatenate([[True], d[x + 1 : y] != d[x : y - 1]]))
        for c, w in zip(cols, (int(bucket[x]), d[x:y][at].tobytes(), np.diff(np.append(at, y - x)).astype(np.uint32).tobytes(), (v[x:y] if v.dtype == U64 else v[x:y].astype(np.int64)).tobytes(), f[x:y].tobytes()), strict=True):
            c.append(w)
    yield common.rows(_LISTS, [kind] * len(cols[0]), *cols, [home] * len(cols[0]))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    have: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            have.setdefault(r["bucket"], []).append(r)
    for parts in have.values():
        d = np.repeat(common.joined([r["docs"] for r in parts], np.int64), common.joined([r["counts"] for r in parts], np.uint32))
        yield d, common.joined([r["tokens"] for r in parts], np.int64), common.joined([r["long"] for r in parts], np.uint8)


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document the one that leads most of its lists."""
    for d, v, _ in _gathered(batches):
        order = np.lexsort((v, d))
        d, v = d[order], v[order]
        at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
        hits = np.diff(np.append(at, len(d)))
        d, v = d[at], v[at]
        order = np.lexsort((v, -hits, d))
        best = order[np.concatenate([[True], np.diff(d[order]) != 0])]
        yield common.rows(_LED, d[best], v[best], hits[best])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document how many shared shingles it has up to each level, and in long lists."""
    for d, v, f in _gathered(batches):
        ids, inv = np.unique(d, return_inverse=True)
        shared, long = np.zeros((len(ids), LEVELS), np.int64), np.zeros((len(ids), LEVELS), np.int64)
        np.add.at(shared, (inv, v), 1)
        np.add.at(long, (inv, v), f)
        yield common.rows(_FACTS, ids, [x.tobytes() for x in shared.cumsum(axis=1)], [x.tobytes() for x in long.cumsum(axis=1)])


_CUT_SQL = "doc_id long, n long, own long, cut int, n_long long"


def _cuts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Up to which level each document's lists are kept; documents that can't link go."""
    for b in batches:
        if not b.num_rows:
            continue
        n = b.column(1).to_numpy()
        shared = np.stack([np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()])
        long = np.stack([np.frombuffer(x, np.int64) for x in b.column(3).to_pylist()])
        own = n - shared[:, -1]
        need = n - required(n, percent) + extra(n) - own  # after the document's own shingles
        cut = np.minimum((shared < need[:, None]).sum(axis=1), LEVELS - 1)
        ok = np.flatnonzero(n - own >= required(n, percent))
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok)), pa.array(n[ok]), pa.array(own[ok]), pa.array(cut[ok].astype(np.int32)), pa.array(long[ok, cut[ok]])], ["doc_id", "n", "own", "cut", "n_long"])


#: Counts of pairs on their way to be summed: a row for each task and bucket of pairs.
_PAIRS = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("a", "b", "short", "long", "n_a", "n_b", "l_a", "l_b")])
_PAIRS_SQL = "bucket int, a binary, b binary, short binary, long binary, n_a binary, n_b binary, l_a binary, l_b binary"


def may_link(n_x, own_x, n_y, own_y, percent: int = PERCENT):
    """Whether what two sets don't have alone lets them link: at 85 %, 185 overlaps >= 85 sizes."""
    return (100 + percent) * np.minimum(n_x - own_x, n_y - own_y) >= percent * (n_x + n_y)


def _cross(token: np.ndarray, who: np.ndarray, n: np.ndarray, own: np.ndarray, comp: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one list whose components differ and that may link, each list's in turn."""
    order = np.lexsort((n[who], token))  # the smaller set first
    token, who = token[order], who[order]
    new = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.append(new, len(token)))
    mixed = np.maximum.reduceat(comp[who], new) != np.minimum.reduceat(comp[who], new)
    small = size <= SHORT
    live = np.repeat(mixed & small, size)
    for shift in range(1, int(size[mixed & small].max(initial=1))):
        i = np.flatnonzero(live[:-shift] & (token[:-shift] == token[shift:]))
        if not len(i):
            break
        yield who[i], who[i + shift]
    for k in np.flatnonzero(mixed & ~small).tolist():
        m = who[new[k] : new[k] + size[k]]
        tight = np.flatnonzero(may_link(n[m], own[m], n[m], 0, percent))  # of a pair the smaller shares almost all it has
        last = np.searchsorted(n[m] * percent, n[m][tight] * 100, side="right")
        names, count = np.unique(comp[m], return_counts=True)
        out = comp[m] != names[count.argmax()]  # members of the largest component only meet others
        for side, to in ((~out[tight], np.flatnonzero(out)), (out[tight], np.arange(len(m)))):
            first = np.searchsorted(to, tight[side], side="right")
            yield from _ranges(m, tight[side], to, first, np.maximum(first, np.searchsorted(to, last[side])))


def _ranges(m, left, to, first, stop) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each of ``left`` with its range of ``to``, a bounded number of pairs at a time."""
    count, at = stop - first, 0
    while at < len(left):
        end = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), 1 << 20, side="right")) + at)
        yield np.repeat(m[left[at:end]], count[at:end]), m[to[kernels.ragged(first[at:end], count[at:end])]]
        at = end


def _search(batches: Iterator[pa.RecordBatch], n_buckets: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate counts from the lists of each bucket, packed for the buckets of pairs."""
    have: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            have.setdefault(r["bucket"], []).append(r)
    for parts in have.values():
        ids = common.joined([r["docs"] for r in parts], np.int64)
        n, own, _, n_long, comp = np.concatenate([np.frombuffer(r["facts"], np.int64).reshape(len(_FACT_NAMES), -1) for r in parts], axis=1)
        heavy = n_long >= extra(n)
        who = np.repeat(np.arange(len(ids)), common.joined([r["counts"] for r in parts], np.uint32))
        token = common.joined([r["tokens"] for r in parts], U64)
        long = common.joined([r["long"] for r in parts], np.uint8).astype(bool)
        total: list[list] = [[], []]
        for kind, use in ((0, ~long), (1, long & heavy[who])):
            if not use.any():
                continue
            for x, y in _cross(token[use], who[use], n, own, comp, percent):
                ok = (comp[x] != comp[y]) & may_link(n[x], own[x], n[y], own[y], percent)
                x, y = x[ok], y[ok]
                x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
                if len(x):
                    total[kind].append(np.unique(x * np.int64(len(ids)) + y, return_counts=True))
        if not (total[0] or total[1]):
            continue
        pairs, inv = np.unique(np.concatenate([p for k in total for p, _ in k]), return_inverse=True)
        counts = [np.concatenate([c * (k == kind) for k in (0, 1) for _, c in total[k]]) for kind in (0, 1)]
        x, y = pairs // len(ids), pairs % len(ids)
        values = [ids[x], ids[y], *[np.bincount(inv, weights=c).astype(np.int32) for c in counts], *[v.astype(np.int32) for v in (n[x], n[y], n_long[x], n_long[y])]]
        bucket = (kernels.mix(ids[x].view(U64) * U64(0x9E3779B97F4A7C15) + ids[y].view(U64)) % U64(n_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]]).tolist()
        parts_ = [order[p:q] for p, q in zip(edge[:-1], edge[1:], strict=True)]
        yield common.rows(_PAIRS, [int(bucket[o[0]]) for o in parts_], *[[v[o].tobytes() for o in parts_] for v in values])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose counts over all buckets reach what theirs must."""
    have: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            have.setdefault(r["bucket"], []).append(r)
    for parts in have.values():
        a, b = (common.joined([r[k] for r in parts], np.int64) for k in "ab")
        short, long, n_a, n_b, l_a, l_b = (common.joined([r[k] for r in parts], np.int32).astype(np.int64) for k in ("short", "long", "n_a", "n_b", "l_a", "l_b"))
        order = np.lexsort((b, a))
        new = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]))
        short, long = np.add.reduceat(short[order], new), np.add.reduceat(long[order], new)
        first = order[new]
        l_x, l_y = extra(n_a[first]), extra(n_b[first])
        need, both = np.minimum(l_x, l_y), (l_a[first] >= l_x) & (l_b[first] >= l_y)
        ok = np.where(both, short + long >= need, short >= np.maximum(1, need - np.minimum(l_a[first], l_b[first])))
        if ok.any():
            yield common.rows(_LINK, b[first[ok]], a[first[ok]])


_FACT_NAMES = ("n", "own", "cut", "n_long", "comp")


def _packed_facts(n_buckets: int):
    """Facts of documents in their buckets (kind 3), next to their lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            facts = np.stack([b.column(k + 1).to_numpy().astype(np.int64) for k in range(len(_FACT_NAMES))])
            bucket = doc_bucket(ids, n_buckets)
            for k in np.unique(bucket).tolist():
                own = bucket == k
                yield common.rows(_LISTS, [3], [k], [ids[own].tobytes()], [b""], [facts[:, own].tobytes()], [b""], [0])

    return run


_TODO = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("long", pa.binary()), ("facts", pa.binary())])
_TODO_SQL = "bucket int, docs binary, counts binary, tokens binary, long binary, facts binary"


def _attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists with the facts of their documents, cut to what is kept, for their own buckets again."""
    facts: dict[int, list] = {}
    lists: dict[int, list] = {}
    for b in batches:
        for r in b.to_pylist():
            (facts if r["kind"] == 3 else lists).setdefault(r["bucket"], []).append(r)
    for k, parts in lists.items():
        if k not in facts:
            continue
        ids = common.joined([r["docs"] for r in facts[k]], np.int64)
        known = np.concatenate([np.frombuffer(r["tokens"], np.int64).reshape(len(_FACT_NAMES), -1) for r in facts[k]], axis=1)
        order = np.argsort(ids)
        ids, known = ids[order], known[:, order]
        for r in parts:
            d, count = np.frombuffer(r["docs"], np.int64), np.frombuffer(r["counts"], np.uint32).astype(np.int64)
            at = np.minimum(np.searchsorted(ids, d), len(ids) - 1)
            of = np.repeat(np.arange(len(d)), count)
            token, long = np.frombuffer(r["tokens"], U64), np.frombuffer(r["long"], np.uint8)
            keep = (ids[at] == d)[of] & (level(token) <= known[2][at][of])
            count = np.bincount(of[keep], minlength=len(d))
            some = count > 0
            if some.any():
                yield common.rows(_TODO, [r["home"]], [d[some].tobytes()], [count[some].astype(np.uint32).tobytes()], [token[keep].tobytes()], [long[keep].tobytes()], [known[:, at[some]].tobytes()])


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(partner, salt, doc_id, text), the partner first: pairs that link."""
    s, partner, own = Shingler(words), None, np.zeros(0, U64)
    for b in batches:
        ys, xs = b.column(0).to_pylist(), b.column(2).to_pylist()
        for i, j, off, raw in kernels.pieces(b.column(3), PIECE_BYTES):
            first, g = s.sets(off, raw)
            out: list[list] = [[], []]
            for k in range(j - i):
                x, y, mine = xs[i + k], ys[i + k], g[first[k] : first[k + 1]]
                if x == y:
                    partner, own = y, mine.copy()
                elif y == partner and len(mine) and len(own):
                    few, many = (mine, own) if len(mine) < len(own) else (own, mine)
                    at = np.minimum(np.searchsorted(many, few), len(many) - 1)  # binary probes
                    both = int((many[at] == few).sum())
                    if 100 * both >= percent * (len(mine) + len(own) - both):
                        out[0].append(x)
                        out[1].append(y)
            if out[0]:
                yield common.rows(_LINK, *out)


def compare(docs: DataFrame, pairs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose documents link: one exchange of texts to their partners b."""
    per = pairs.groupBy("b").count().select("b", F.ceil(F.col("count") / SALT_ROWS).cast("int").alias("salts"))
    to = pairs.join(per, "b").select(F.col("a").alias("doc_id"), "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"))
    to = to.unionByName(per.select(F.col("b").alias("doc_id"), "b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    to = common.stored(to, "jaccard-pairs")
    sent = docs.join(to, "doc_id").select("b", "salt", "doc_id", "text")
    sent = sent.repartition("b", "salt").sortWithinPartitions("b", "salt", (F.col("doc_id") != F.col("b")))
    return common.stored(sent.mapInArrow(partial(_compare, words=words, percent=percent), "a long, b long"), "jaccard-links").distinct()


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document of (doc_id, text).

    ``words`` and ``percent``: the width of a shingle and the similarity of a link.
    """
    docs, back = common.apart(docs.select("doc_id", "text"), "doc_id", "text")
    return back(_link_components(docs, words, percent), "doc_id", "component_id")


def _link_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The same for keys that no two texts share."""
    n = common.partitions(docs.sparkSession)
    keyed = docs.where(F.col("doc_id").isNotNull())
    meta = common.stored(docs.mapInArrow(partial(_meta, words=words), _META), "jaccard-sets")
    some = meta.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    reps = some.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"))
    classes = common.stored(some.join(reps, ["n", "k1", "k2"]).select("doc_id", "n", "sampled", "rep").distinct(), "jaccard-classes")
    # 1. documents that can link at all
    shared = by_document(common.exchange(keyed.mapInArrow(_sampled(n, words), ENTRY_SQL), n).mapInArrow(_shared(n), HIT_SQL), n).select("doc_id", (F.length("at") / 4).cast("long").alias("shared"))
    least = F.floor((percent * F.col("n") + 99) / 100)
    can = classes.where("doc_id = rep").join(shared.hint("merge"), "doc_id", "left").where(F.col("n") - F.col("sampled") + F.coalesce("shared", F.lit(0)) >= least).select("doc_id", "n")
    active = common.stored(keyed.join(can.hint("merge"), "doc_id").select("doc_id", "text", "n"), "jaccard-active")
    # 2. their lists
    lists = common.stored(common.exchange(active.mapInArrow(_postings(n, words), "bucket int, h binary, d binary, n binary"), n).mapInArrow(_merge_lists(n), _LISTS_SQL), "jaccard-lists")
    kind = lambda k: lists.where(F.col("kind") == k)
    facts = common.exchange(kind(2), n).mapInArrow(_facts, "doc_id long, shared binary, long binary")
    facts = common.stored(active.select("doc_id", "n").distinct().join(facts, "doc_id").select("doc_id", "n", "shared", "long").mapInArrow(partial(_cuts, percent=percent), _CUT_SQL), "jaccard-facts")
    # 3. collapse: each document meets the leader of most of its lists
    led = common.exchange(kind(1), n).mapInArrow(_leaders, "a long, b long, hits long")
    fact = lambda x: facts.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("own").alias(f"u_{x}"), F.col("n_long").alias(f"l_{x}"))
    close = (100 + percent) * F.least(F.col("n_a") - F.col("u_a"), F.col("n_b") - F.col("u_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    links = compare(active, led.join(fact("a"), "a").join(fact("b"), "b").where(close).select("a", "b"), words, percent)
    comp = common.components(links)
    # 4. search over what different components still share
    todo = facts.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    todo = kind(0).unionByName(todo.select("doc_id", *_FACT_NAMES).mapInArrow(_packed_facts(n), _LISTS_SQL))
    todo = common.exchange(todo, n).mapInArrow(_attach, _TODO_SQL)
    found = common.exchange(todo, n).mapInArrow(partial(_search, n_buckets=n, percent=percent), _PAIRS_SQL)
    found = common.exchange(found, n).mapInArrow(_decide, "a long, b long")
    more = compare(active, common.stored(found, "jaccard-candidates"), words, percent)
    every = links.unionByName(more).unionByName(classes.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    comp = common.components(every).withColumnRenamed("node", "doc_id")
    return meta.select("doc_id", "n").join(comp, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that are the least of their component, columns as they were."""
    kind = docs.schema["doc_id"].dataType
    told, back = common.apart(docs, "doc_id", "text")
    comp = _link_components(told.select("doc_id", "text"), words, percent).where("component_id <> doc_id").select("doc_id").distinct()
    left = back(told.join(comp, "doc_id", "left_anti").select(*docs.columns), "doc_id")
    return left.withColumn("doc_id", F.col("doc_id").cast(kind))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
