"""The lattice of vocabulary pieces over distinct words: lookups for operators 4 and 5.

A word is a run of bytes in which pieces are looked up by the hash of every span of at most the
longest piece.  Words of like length make one rectangle, all aligned at their starts, so a dynamic
programme over a lattice is a few array operations for all of them together.  What stands behind a
shorter word's end is looked up as well; no path that ends at the word's own end meets it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tessera.llm import kernels

#: How the file marks a space in a piece; here it is a space again, a single byte.
MARK = "▁".encode()
SPACE = 0x20


class Vocabulary:
    """Pieces of a public SentencePiece file: bytes, scores, and a hash table to find them.

    ``whole`` takes those that cross words (runs of spaces, control characters) as well.
    """

    def __init__(self, path: str, seed: int = 411, whole: bool = False):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int32)
        score = np.array([model.get_score(i) for i in range(model.get_piece_size())])
        plain: list[int] = []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(text[1:-1], 16)] = i
                self.texts.append(bytes([int(text[1:-1], 16)]))
            else:
                self.texts.append(text.encode().replace(MARK, b" "))
                # pieces with a space behind the first byte, or with a control character, cross words
                word = score[i] > -1e8 and b" " not in self.texts[-1][1:] and (len(self.texts[-1]) == 1 or min(self.texts[-1]) >= 0x20)
                if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and (whole or word):
                    plain.append(i)
        self.size = len(self.texts)
        self.score = score
        #: A byte stands for itself only where no piece covers it: it is scored below every piece.
        self.byte_score = float(score[plain].min()) - 10.0
        self.score = np.where(np.isin(np.arange(self.size), self.byte_ids), self.byte_score, self.score)
        self.longest = max(len(self.texts[i]) for i in plain)
        #: Whether a piece has a byte, of 256 rows, next before another.
        self.joins = np.zeros((256, 256), bool)
        for i in plain:
            own = np.frombuffer(self.texts[i], np.uint8)
            self.joins[own[:-1], own[1:]] = True
        self.roll = kernels.Rolling(seed)
        self._fill(plain)

    def _fill(self, plain: list[int]) -> None:
        joined = np.frombuffer(b"".join(self.texts[i] for i in plain), np.uint8)
        ends = np.cumsum([len(self.texts[i]) for i in plain])
        starts = ends - np.array([len(self.texts[i]) for i in plain])
        h = self.roll.spans(self.roll.prefix(joined), starts, ends)
        ids = np.array(plain, np.int32)
        self.tables = []
        bits = 20
        for k in range(64):  # those whose slot is taken go to the next table
            if not len(h):
                break
            slot = (kernels.mix(h ^ np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64)
            hashes, found = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            _, first = np.unique(slot, return_index=True)
            hashes[slot[first]], found[slot[first]] = h[first], ids[first]
            self.tables.append((k, bits, hashes, found))
            rest = np.ones(len(h), bool)
            rest[first] = False
            h, ids, bits = h[rest], ids[rest], 12
        assert not len(h)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 for none."""
        out = np.full(h.shape, -1, np.int32)
        for k, bits, hashes, found in self.tables:
            slot = (kernels.mix(h ^ np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64)
            out = np.where(hashes[slot] == h, found[slot], out)
        return out

    def matches(self, prefix: np.ndarray, raw: np.ndarray, start: np.ndarray, size: int) -> list[np.ndarray]:
        """For words of up to that size: by length n from 1, pieces (words x places) of n bytes, -1 for none."""
        out, last = [], len(prefix) - 1
        for n in range(1, min(size, self.longest) + 1):
            at = np.minimum(start[:, None] + np.arange(size - n + 1), last - n)
            ids = self.find(self.roll.spans(prefix, at, at + n))
            if n == 1:
                ids = np.where(ids < 0, self.byte_ids[raw[at]], ids)
            out.append(ids)
        return out


def edges(match: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(end, bytes, words, their pieces) of all places where some word has a piece, by end and then length."""
    at = [np.flatnonzero((ids >= 0).any(axis=0)) for ids in match]
    size = np.repeat(np.arange(1, len(match) + 1), [len(x) for x in at])
    end = np.concatenate(at) + size if at else size
    order = np.lexsort((size, end))
    for j, n in zip(end[order].tolist(), size[order].tolist(), strict=True):
        column = match[n - 1][:, j - n]
        some = np.flatnonzero(column >= 0)
        yield j, n, some, column[some]


#: Words up to that many bytes share a rectangle with their equals only; longer ones with those up to a fifth longer.
SHORT, GROWTH = 32, 1.2
#: Bytes of the words of a rectangle, where these are several: what is worked out for it is many times as large.
CELLS = 1 << 16


def rectangles(start: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(greatest length, words) of groups of words of like length, given by their start and length."""
    grade = np.where(length <= SHORT, length, SHORT + np.ceil(np.log(np.maximum(length, 1) / SHORT) / np.log(GROWTH))).astype(np.int64)
    order = np.argsort(grade, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(grade[order])) + 1):
        if len(part):
            size = int(length[part].max())
            step = max(1, CELLS // max(size, 1))
            for at in range(0, len(part), step):
                yield size, part[at : at + step]


def prefixed(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words copied one after another, each behind a space: (bytes, start, length)."""
    size = end - start
    length = size + 1
    begin = np.cumsum(length) - length
    out = np.empty(int(length.sum()), np.uint8)
    out[begin] = SPACE
    out[kernels.ragged(begin + 1, size)] = raw[kernels.ragged(start, size)]
    return out, begin, length
