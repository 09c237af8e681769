"""Vectorised kernels over Arrow text: words, hashes, windows, minimizers and intervals.

Every hash is a polynomial modulo 2**64 over a random table with an odd base, taken as a
difference of prefix sums, so all windows of a batch cost a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that one pass of a kernel works on; one longer text is worked on alone.
CHUNK_BYTES = 3 << 19
#: Space and the control characters from tab to carriage return separate words.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters.
NO_LETTER = np.array([b < 0x80 and not chr(b).isalpha() for b in range(256)])
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Rolling:
    """Hashes of spans of a sequence of bytes or of 64-bit values."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 2**63, 256, dtype=np.int64).view(U64) * U64(2) + U64(1)
        self.base = (int(rng.integers(2**40, 2**62)) * 8 + 5) % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self._up = np.ones(1, U64)
        self._down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            n = max(n, 1 << 16)
            up, down = np.full(n, U64(self.base)), np.full(n, U64(self.inverse))
            up[0] = down[0] = 1
            self._up, self._down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums; bytes go through the random table, 64-bit values are taken as they are."""
        n = len(values)
        self._powers(n + 1)
        out = np.zeros(n + 1, U64)
        np.cumsum((self.table[values] if values.dtype == np.uint8 else values) * self._up[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self._down[start] + (end - start).astype(U64))

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all windows of that width, by start."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, U64)
        return mix((prefix[width:] - prefix[:n]) * self._down[:n] + U64(width))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_large_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1] if offs else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, raw


def pieces(column, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, offsets from 0, bytes) for runs of rows of about ``most`` bytes."""
    off, raw = buffers(column)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, off[i : j + 1] - off[i], raw[off[i] : off[j]]
        i = j


def words(off: np.ndarray, raw: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of other bytes than separators, within its row."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(raw)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def bounds(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets by row of items that are in row order."""
    return np.searchsorted(row, np.arange(n + 1))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each window of that width, by start, in a logarithmic number of passes."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n]) if have < width else x[:n]


#: Places that share a number with a hash have 28 bits; longer sequences are worked on in parts.
LIMIT = 1 << 28


def anchors(gram: np.ndarray, off: np.ndarray, window: int, gram_width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``anchors_of`` for sequences of any length; a run of windows may be cut between two parts."""
    if len(gram) <= LIMIT:
        return anchors_of(gram, off, window, gram_width)
    step, found = LIMIT - window, []
    for s in range(0, len(gram), step):  # the windows that start in a part, and all that they hold
        own = anchors_of(gram[s : s + step + window - gram_width], np.clip(off, s, s + step + window - 1) - s, window, gram_width)
        found.append([x + s for x in own])
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def anchors_of(gram: np.ndarray, off: np.ndarray, window: int, gram_width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizers: (anchor, first window, last window) where an anchor is the start of the least
    gram of each window from the first to the last.

    ``off`` are the offsets of the documents in the sequence; windows stay inside one document.
    Equal windows have their anchor at the same place in them, so two equal windows share it.
    """
    none = np.zeros(0, np.int64)
    if len(gram) < window - gram_width + 1:
        return none, none, none
    at = np.arange(len(gram), dtype=U64)
    key = sliding_min((gram & U64(0xFFFFFFFFF0000000)) | at, window - gram_width + 1)
    pos = (key & U64(0x0FFFFFFF)).astype(np.int64)
    good = np.zeros(len(pos) + 1, np.int32)
    first, last = off[:-1], off[1:] - window
    ok = last >= first
    np.add.at(good, first[ok], 1)
    np.add.at(good, last[ok] + 1, -1)
    win = np.flatnonzero(np.cumsum(good[:-1]) > 0)
    if not len(win):
        return none, none, none
    pos = pos[win]
    new = np.empty(len(win), bool)
    new[0] = True
    new[1:] = (pos[1:] != pos[:-1]) | (win[1:] != win[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(win)) - 1
    return pos[a], win[a], win[b]


def cover(length: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each of ``length`` places is in one of the intervals."""
    d = np.zeros(length + 1, np.int32)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, ... for each interval, one after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) - np.repeat(ends - length, length) + np.repeat(start, length)


def planes(x: np.ndarray) -> bytes:
    """Numbers by their first bytes, second bytes and so on: small ones then compress well."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()
